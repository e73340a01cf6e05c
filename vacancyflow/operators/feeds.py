"""Feeds of a site: which one is used, and the job rows or links it gives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.once import once
from vacancyflow.functions.predicates import is_posting
from vacancyflow.functions.text import none_if_blank, or_default, strip
from vacancyflow.functions.urls import UrlParts, feed_rank, host, lower_path, origin, split_url
from vacancyflow.operators.schema import FEED_PASS, JOB_COLUMNS, metadata, seq
from vacancyflow.plans.staging import staged
from vacancyflow.profile import SiteProfile
from vacancyflow.sources.feeds import with_item_fields
from vacancyflow.sources.wanted import Pages, feeds_of


def feed_addresses(origins: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Every origin with every feed path: (…, feed_rank, feed_url)."""
    ranked = F.posexplode(F.array(*[F.lit(path) for path in paths])).alias("place", "path")
    return origins.select("*", ranked).select(
        *origins.columns,
        (F.col("place") + 1).alias("feed_rank"),
        F.concat("origin", "path").alias("feed_url"),
    )


def feeds_with(pages: Pages, column: str, paths: Sequence[str], origins: DataFrame) -> DataFrame:
    """Feed rows found by their own address: (origin, feed_rank, feed_url, site, scheme, column).

    Of pages that are yet to be read, only the addresses of `origins` are.
    """
    url, parts = F.col("url"), UrlParts.columns("feed_")
    split = split_url(feeds_of(pages, feed_addresses(origins, paths), column), "url", "feed_")
    ranked = split.withColumn("feed_rank", feed_rank(url, parts, paths)).where("feed_rank > 0")
    return ranked.select(
        origin(parts).alias("origin"),
        "feed_rank",
        url.alias("feed_url"),
        parts.netloc.alias("site"),
        parts.scheme.alias("scheme"),
        column,
    )


def item_link(link: Column, guid: Column, scheme: Column) -> Column:
    """The item's link, or its guid if that is one; empty if neither."""
    from_guid = F.when(guid.startswith("http"), guid).when(
        guid.startswith("//"), F.concat(scheme, F.lit(":"), guid)
    )
    return F.when(link != "", link).otherwise(F.coalesce(from_guid, F.lit("")))


def posting_items(pages: Pages, profile: SiteProfile, origins: DataFrame) -> DataFrame:
    """Items that have a link and look like postings, one row each with its place in the feed."""
    feeds = feeds_with(pages, "feed_items", profile.job_feed_paths, origins)
    items = feeds.select("*", F.posexplode("feed_items").alias("pos", "item")).select(
        "origin", "feed_rank", "feed_url", "site", "scheme", "pos", "item.*"
    )
    fields = with_item_fields(items)
    linked = once(fields, url=item_link(F.col("link"), F.col("guid"), F.col("scheme"))).where("url <> ''")
    parts = UrlParts.columns("link_")
    known = once(split_url(linked, "url", "link_"), host=host(parts), path=lower_path(parts))
    return known.where(is_posting(F.col("host"), F.col("path"), F.col("title"), profile)).select(
        "origin", "feed_rank", "feed_url", "site", "pos", "url", "title", "description", "pub_date", "guid"
    )


def first_feeds(candidates: DataFrame) -> DataFrame:
    """The first feed of each origin that has any candidate: a map-side minimum over two small columns."""
    return candidates.groupBy("origin").agg(F.min("feed_rank").alias("feed_rank"))


def feed_jobs(hubs: DataFrame, pages: Pages, profile: SiteProfile) -> DataFrame:
    """Job rows of the first productive feed of every hub origin.

    `hubs` is (origin, link_seq). Feeds are read and their items judged once, and stored: the choice of a feed
    reads two narrow columns of them. Items of one origin are never gathered in one task: they meet only the
    one-row-per-origin side of an equi-join, whose hot partitions can be split.
    """
    items = staged(posting_items(pages, profile, hubs))
    chosen = hubs.join(first_feeds(items), "origin")
    rows = items.join(chosen, ["origin", "feed_rank"])
    return rows.select(
        seq(FEED_PASS, F.col("link_seq"), F.col("pos")).alias("seq"),
        F.col("site").alias("source_site"),
        F.col("url").alias("application_url"),
        or_default(F.col("title"), "Untitled").alias("job_title"),
        F.col("description").alias("job_description"),
        metadata(
            date_posted=none_if_blank(F.col("pub_date")),
            job_id=none_if_blank(F.col("guid")),
            source_feed=F.col("feed_url"),
        ).alias("metadata"),
        F.col("feed_url").alias("source_url"),
    ).select(*JOB_COLUMNS)


def mined_links(sites: DataFrame, pages: Pages, profile: SiteProfile) -> DataFrame:
    """Vendor links in the first feed with any link of each site, without the sites themselves.

    Returns (url, site, pos), each link at its first place: by site in text order, then by place in the feed.
    """
    site_origin = origin(UrlParts.columns("site_")).alias("origin")
    by_origin = split_url(sites.select("url"), "url", "site_").groupBy(site_origin).agg(F.min("url").alias("site"))
    feeds = staged(feeds_with(pages, "feed_links", profile.crawl_feed_paths, by_origin).where(F.size("feed_links") > 0))
    chosen = by_origin.join(first_feeds(feeds), "origin")
    links = (
        feeds.drop("site").join(chosen, ["origin", "feed_rank"])
        .select("site", F.posexplode("feed_links").alias("pos", "link"))
        .select(strip(F.col("link")).alias("url"), F.struct("site", "pos").alias("place"))
        .where(F.lower("url").contains(profile.vendor_token))
    )
    first = links.groupBy("url").agg(F.min("place").alias("place"))
    return first.join(sites, "url", "left_anti").select("url", "place.site", "place.pos")
