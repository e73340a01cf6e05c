"""The numbers a run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.urls import UrlParts, origin, split_url
from vacancyflow.operators.feeds import posting_items
from vacancyflow.operators.links import classify, hub_origins
from vacancyflow.profile import WHOLE_PROFILE, SiteProfile
from vacancyflow.sources.wanted import Pages


def link_counts(links: DataFrame, profile: SiteProfile = WHOLE_PROFILE) -> DataFrame:
    """(measure, n): links, hubs, job pages and listings, counted in one pass."""
    flags = classify(links, profile).agg(
        F.count("*").alias("links"),
        F.count_if("is_hub").alias("hubs"),
        F.count_if("is_job_page").alias("job_pages"),
        F.count_if("is_listing").alias("listings"),
    )
    return flags.unpivot([], ["links", "hubs", "job_pages", "listings"], "measure", "n")


def feed_counts(links: DataFrame, pages: Pages, profile: SiteProfile = WHOLE_PROFILE) -> DataFrame:
    """(url, n): items that the feed of each hub contributes; hubs without any are left out."""
    origins = hub_origins(classify(links, profile))
    per_feed = posting_items(pages, profile, origins).groupBy("origin", "feed_rank").agg(F.count("*").alias("n"))
    per_origin = per_feed.groupBy("origin").agg(F.min_by("n", "feed_rank").alias("n"))
    hubs = split_url(classify(links, profile).where("is_hub"), "url", "hub_").select(
        origin(UrlParts.columns("hub_")).alias("origin"), "url"
    )
    return hubs.join(per_origin, "origin").select("url", "n")
