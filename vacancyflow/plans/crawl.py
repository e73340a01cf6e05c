"""Discovery: from certificate records and search results to career sites and all known links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.text import contains_any, strip
from vacancyflow.functions.urls import normalise
from vacancyflow.operators.feeds import mined_links
from vacancyflow.profile import WHOLE_PROFILE, SiteProfile
from vacancyflow.sources.discovery import certificate_domains, search_bases
from vacancyflow.sources.wanted import Pages, answered_urls

LINK_ORDER = ("part", "site", "pos", "url")


def career_domains(domains: DataFrame, profile: SiteProfile) -> DataFrame:
    """Vendor domains without those whose name holds a word of technical hosts."""
    domain = F.lower(strip(F.col("domain")))
    return (
        domains.select(domain.alias("domain"))
        .where(F.col("domain").endswith(profile.vendor_suffix))
        .where(~contains_any(F.col("domain"), profile.skip_words))
    )


def career_urls(domain: Column, profile: SiteProfile) -> Column:
    return F.explode(F.array(*[F.concat(F.lit("https://"), domain, F.lit(path)) for path in profile.career_paths]))


def discovered_sites(certificates: DataFrame, results: DataFrame, profile: SiteProfile) -> DataFrame:
    """Distinct normalised URLs from both ways of discovery."""
    domains = career_domains(certificate_domains(certificates, profile), profile)
    from_domains = domains.select(career_urls(F.col("domain"), profile).alias("url"))
    from_search = search_bases(results, profile).select(F.col("base").alias("url"))
    return from_domains.unionByName(from_search).select(normalise(F.col("url")).alias("url")).distinct()


def validated(sites: DataFrame, pages: Pages) -> DataFrame:
    """Sites that answered; of the pages only the url column is read."""
    return sites.join(answered_urls(pages), "url", "left_semi")


def career_links(
    certificates: DataFrame,
    results: DataFrame,
    pages: Pages,
    profile: SiteProfile = WHOLE_PROFILE,
    validate: bool = True,
) -> DataFrame:
    """(url) of the career sites, distinct; `write_links` sorts them."""
    sites = discovered_sites(certificates, results, profile)
    return validated(sites, pages) if validate else sites


def all_links(
    sites: DataFrame, pages: Pages, profile: SiteProfile = WHOLE_PROFILE, include_job_links: bool = True
) -> DataFrame:
    """(part, site, pos, url): the sites, then the links their feeds name; LINK_ORDER sorts them."""
    first = sites.select(F.lit(0).alias("part"), F.lit("").alias("site"), F.lit(0).alias("pos"), "url")
    if not include_job_links:
        return first
    mined = mined_links(sites, pages, profile)
    return first.unionByName(mined.select(F.lit(1).alias("part"), "site", "pos", "url"))
