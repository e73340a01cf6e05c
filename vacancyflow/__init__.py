"""Career-site links and job postings as Spark DataFrame work."""

from vacancyflow.profile import DEFAULT_PROFILE, WHOLE_PROFILE, SiteProfile

__all__ = ["DEFAULT_PROFILE", "WHOLE_PROFILE", "SiteProfile"]
