"""The fetched-page table, fetched(url, status, body), read in one pass.

It has one row per URL, or a column fetched_at beside; then only the newest fetch of a URL counts.

Bodies are the bulk of the data. They are taken apart where they are scanned, so that no body ever enters
a shuffle: what leaves the scan is the found nodes of a page and the items and links of a feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.once import once
from vacancyflow.functions.predicates import is_job_page, is_listing
from vacancyflow.functions.urls import UrlParts, bare_path, feed_rank, split_url
from vacancyflow.profile import SiteProfile
from vacancyflow.sources.feeds import feed_links, with_feed_items
from vacancyflow.sources.html import page_nodes_udf


def newest_fetches(fetched: DataFrame) -> DataFrame:
    """(url, status), the newest fetch of each URL; as wide rows hold the bodies, only narrow ones are compared."""
    if "fetched_at" not in fetched.columns:
        return fetched.select("url", "status")
    return fetched.groupBy("url").agg(F.max_by("status", "fetched_at").alias("status"))


def answered(fetched: DataFrame) -> DataFrame:
    """Only pages that were fetched with status 200 exist for the rest of the work.

    A page fetched again counts as it was last. The newest times are found on narrow rows, and a body meets them
    by url and time.
    """
    rows = fetched.where(F.col("status") == 200)
    if "fetched_at" not in fetched.columns:
        return rows
    newest = fetched.groupBy("url").agg(F.max("fetched_at").alias("fetched_at"))
    return rows.join(newest, ["url", "fetched_at"], "left_semi").drop("fetched_at")


def page_nodes(fetched: DataFrame, profile: SiteProfile) -> DataFrame:
    """(url, nodes) of every answered page."""
    return with_nodes(split_bodies(answered(fetched)), profile).select("url", "nodes")


def read_pages(fetched: DataFrame, profile: SiteProfile) -> DataFrame:
    """(url, nodes, feed_items, feed_links) of every answered page, from one scan of the bodies.

    Feed columns are null for URLs that are no feed address.
    """
    paths = tuple(dict.fromkeys((*profile.job_feed_paths, *profile.crawl_feed_paths)))
    is_feed = feed_rank(F.col("url"), UrlParts.columns("url_"), paths) > 0
    bodies = once(split_bodies(answered(fetched)), feed_body=F.when(is_feed, F.col("body")))
    with_items = with_feed_items(bodies, F.col("feed_body"))
    with_links = once(with_items, feed_links=feed_links(F.col("feed_body"), profile)).drop("feed_body")
    return with_nodes(with_links, profile).select("url", "nodes", "feed_items", "feed_links")


def split_bodies(rows: DataFrame) -> DataFrame:
    """The rows with the parts of their url."""
    return split_url(rows, "url", "url_")


def with_nodes(rows: DataFrame, profile: SiteProfile) -> DataFrame:
    """Links are only listed for pages that may be read as listings."""
    path = bare_path(UrlParts.columns("url_"))
    want_links = is_job_page(path, profile) & is_listing(path, profile)
    return rows.select("*", page_nodes_udf(profile)(F.col("body"), want_links).alias("nodes"))
