"""Boolean Columns: what a link is, and what counts as a job posting.

Parameters named `path` are lower-case paths; for the link classes they have no trailing slash.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancyflow.functions.text import contains_any
from vacancyflow.functions.urls import segment_count
from vacancyflow.profile import SiteProfile

# Lengths of the two sign-in texts.
SIGN_IN_SIZES = (600, 500)


def is_hub(path: Column, profile: SiteProfile) -> Column:
    inside = contains_any(path, [f"/{word}/" for word in profile.career_words])
    return path.isin("", *[f"/{word}" for word in profile.career_words]) | (inside & (segment_count(path) <= 2))


def is_job_page(path: Column, profile: SiteProfile) -> Column:
    return (path != "") & (contains_any(path, profile.blog_paths) | (segment_count(path) >= 2))


def is_listing(path: Column, profile: SiteProfile) -> Column:
    search = path.contains(profile.listing_word) & ~path.contains(f"/{profile.detail_word}")
    short = (segment_count(path) <= 2) & contains_any(path, profile.career_words)
    ending = path.rlike("/(?:" + "|".join(profile.career_words) + ")$")
    return (path != "") & (search | short | ending)


def is_marketing_title(title: Column, profile: SiteProfile) -> Column:
    return contains_any(F.lower(F.coalesce(title, F.lit(""))), profile.non_job_patterns)


def is_posting(host: Column, path: Column, title: Column, profile: SiteProfile) -> Column:
    """Host, lower-case path and title of a real posting, not of a blog or marketing item."""
    words, listing = profile.career_words, profile.listing_word
    apex = host.isin(*profile.vendor_apex_hosts)
    apex_content = contains_any(path, (*profile.blog_paths, *profile.marketing_words)) | ~contains_any(
        path, (*[f"/{word}/" for word in words], listing)
    )
    other_content = contains_any(path, profile.non_job_patterns) | is_marketing_title(title, profile)
    vendor_job = host.contains(f".{profile.vendor_suffix}") & ~apex & contains_any(path, (*words, listing))
    any_job = contains_any(path, (*[f"/{word}" for word in words], listing))
    return ~(apex & apex_content) & ~other_content & (vendor_job | any_job)


def is_login_wall(head: Column, size: Column) -> Column:
    """A sign-in form's text where a description should be.

    `size` is the length of the stripped text and `head` its lower-case start, at least as long as the
    limits: beyond them only the first words matter.
    """
    longest, longer = SIGN_IN_SIZES
    return (
        head.startswith("your password must")
        | (head.contains("forgot your password?") & head.contains("login") & (size < longest))
        | (
            head.startswith("already registered?")
            & head.contains("login")
            & head.contains("password")
            & (size < longer)
        )
    )


def has_barred_url(url: Column, profile: SiteProfile) -> Column:
    """Blog links (case kept) and sign-in links (any case)."""
    return contains_any(url, profile.blog_paths) | F.lower(url).contains(profile.login_path)
