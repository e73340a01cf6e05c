"""Job rows: acceptance, first-wins, and merging in what later page reads found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.once import once
from vacancyflow.functions.predicates import SIGN_IN_SIZES, has_barred_url, is_login_wall, is_posting
from vacancyflow.functions.text import strip
from vacancyflow.functions.urls import UrlParts, host, lower_path, split_url
from vacancyflow.operators.schema import JOB_COLUMNS, JOB_KEY, METADATA_FIELDS
from vacancyflow.profile import SiteProfile


def with_acceptance(rows: DataFrame, profile: SiteProfile) -> DataFrame:
    """Adds `acceptable`: whether the row may enter the result as a job of its own."""
    text = once(rows, link=F.coalesce("application_url", F.lit("")), plain=strip(F.coalesce("job_description", F.lit(""))))
    parts = UrlParts.columns("link_")
    known = once(
        split_url(text, "link", "link_"),
        host=host(parts),
        path=lower_path(parts),
        head=F.lower(F.left("plain", F.lit(max(SIGN_IN_SIZES)))),
        size=F.length("plain"),
    )
    vendor_page = F.col("host").isin(*profile.vendor_apex_hosts)
    rejected = (
        has_barred_url(F.col("link"), profile)
        | is_login_wall(F.col("head"), F.col("size"))
        | (vendor_page & ~is_posting(F.col("host"), F.col("path"), F.col("job_title"), profile))
    )
    return known.select(*rows.columns, (~rejected).alias("acceptable"))


def accepted(rows: DataFrame, profile: SiteProfile) -> DataFrame:
    return with_acceptance(rows, profile).where("acceptable").drop("acceptable")


def first_wins(rows: DataFrame) -> DataFrame:
    """The earliest row of each (source_site, application_url).

    An aggregate over keys and places, not a window: each task first reduces a hot key to one row. The texts
    are fetched by place afterwards, so only winners' texts meet anything, and a hot key's rows lie apart.
    The rows are read twice.
    """
    winners = rows.groupBy(*JOB_KEY).agg(F.min("seq").alias("seq")).select("seq")
    return rows.select(*JOB_COLUMNS).join(winners, "seq", "left_semi")


def merge_enrichment(jobs: DataFrame, enriched: DataFrame, profile: SiteProfile) -> DataFrame:
    """Add the rows of the enrichment pass to the jobs found before it.

    `jobs` holds accepted rows, one per key. For each key the first accepted row is the job. Enrichment
    rows after it are merged in whether acceptable or not: the longest description wins and the earlier one
    on a tie, and the latest known value of each metadata field wins. Enrichment rows before it are void.

    Only a rejected enrichment row has to be compared with its job's place, so only those are joined. What
    wins is found on keys, places and lengths, in an aggregate that reduces hot keys before the shuffle; titles
    and descriptions are fetched by place afterwards. Both inputs are read several times.
    """
    judged = _narrow(with_acceptance(enriched, profile), "acceptable")
    good = judged.where("acceptable").drop("acceptable")
    candidates = _narrow(jobs).unionByName(good)
    inserted = candidates.groupBy(*JOB_KEY).agg(F.min("seq").alias("job_seq"))
    # A barred URL bars every row of its key, so no such key has a job to merge into.
    rejected = judged.where("not acceptable").where(~has_barred_url(F.col("application_url"), profile))
    late = rejected.join(inserted, list(JOB_KEY)).where("seq > job_seq").select(*candidates.columns)
    return _merge(candidates.unionByName(late), jobs.select(*JOB_COLUMNS).unionByName(enriched.select(*JOB_COLUMNS)))


def _narrow(rows: DataFrame, *more: str) -> DataFrame:
    """Rows without their texts: places, keys, lengths and metadata. No description is one of no length."""
    size = F.coalesce(F.length("job_description"), F.lit(0)).alias("size")
    return rows.select("seq", *JOB_KEY, size, "metadata", *more)


def _merge(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """One row per key of the narrow `rows`; `texts` has the job rows of all their places."""
    order = F.col("seq")
    fields = [
        F.max_by(F.col(f"metadata.{name}"), F.when(F.col(f"metadata.{name}").isNotNull(), order)).alias(name)
        for name in METADATA_FIELDS
    ]
    winners = rows.groupBy(*JOB_KEY).agg(
        F.min("seq").alias("seq"), F.min_by(order, F.struct(-F.col("size"), order)).alias("longest"), *fields
    )
    firsts = texts.select("seq", "job_title", "source_url")
    longest = texts.select(F.col("seq").alias("longest"), "job_description")
    merged = winners.join(firsts, "seq").join(longest, "longest")
    return merged.select(
        "seq",
        *JOB_KEY,
        "job_title",
        "job_description",
        F.struct(*METADATA_FIELDS).alias("metadata"),
        "source_url",
    )


def with_timestamp(jobs: DataFrame) -> DataFrame:
    """Adds the extraction time as UTC text."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return jobs.withColumn("extracted_at", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
