"""What each link is, and which links each pass works on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.once import once
from vacancyflow.functions.predicates import is_hub, is_job_page, is_listing
from vacancyflow.functions.urls import UrlParts, bare_path, origin, split_url, tidy
from vacancyflow.profile import SiteProfile


def classify(links: DataFrame, profile: SiteProfile) -> DataFrame:
    """Adds three independent flags; a link may have several of them, or none."""
    path = F.col("path")
    return once(links, path=bare_path(UrlParts.split(tidy(F.col("url"))))).select(
        *links.columns,
        is_hub(path, profile).alias("is_hub"),
        is_job_page(path, profile).alias("is_job_page"),
        is_listing(path, profile).alias("is_listing"),
    )


def first_in_order(rows: DataFrame, order: str, limit: int | None) -> DataFrame:
    """The first `limit` rows; no limit means all rows and no sort."""
    return rows if limit is None else rows.orderBy(order).limit(limit)


def pages_to_read(classes: DataFrame, limit: int | None) -> DataFrame:
    """Job-page links within the limit, each once at its first place: (url, link_seq, is_listing)."""
    within = first_in_order(classes.where("is_job_page"), "link_seq", limit)
    return within.groupBy("url", "is_listing").agg(F.min("link_seq").alias("link_seq"))


def hub_origins(classes: DataFrame) -> DataFrame:
    """Feeds depend on a hub's origin only: (origin, link_seq of its first hub)."""
    hubs = split_url(classes.where("is_hub"), "url", "hub_")
    return hubs.groupBy(origin(UrlParts.columns("hub_")).alias("origin")).agg(F.min("link_seq").alias("link_seq"))
