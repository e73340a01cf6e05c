"""Extraction: from links and read pages to job rows, in three passes whose order is kept in `seq`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.predicates import is_marketing_title
from vacancyflow.operators.feeds import feed_jobs
from vacancyflow.operators.jobs import accepted, first_wins, merge_enrichment
from vacancyflow.operators.links import classify, first_in_order, hub_origins, pages_to_read
from vacancyflow.operators.listing import listing_links
from vacancyflow.operators.pages import page_jobs
from vacancyflow.operators.schema import ENRICH_PASS, JOB_COLUMNS, PAGE_PASS, seq
from vacancyflow.plans.staging import staged
from vacancyflow.profile import WHOLE_PROFILE, SiteProfile
from vacancyflow.sources.wanted import Pages, nodes_of


def detail_targets(classes: DataFrame, pages: Pages, profile: SiteProfile, limit: int | None) -> DataFrame:
    """(url, card_title, seq): the pages to take a job from.

    These are single job pages, the job links of listings, and listings without any. Any number of listings
    may name the same link. All its rows give the same job but for the title, which decides about acceptance
    only by being a marketing title or not. So the earliest row of either kind stands for all of them: a hot
    link is down to two rows per task before anything is joined, and its page is read twice at most.
    """
    to_read = pages_to_read(classes, limit)
    single = to_read.where("not is_listing").select(
        "url",
        F.lit(None).cast("string").alias("card_title"),
        seq(PAGE_PASS, F.col("link_seq"), F.lit(0)).alias("seq"),
    )
    listings = to_read.where("is_listing").drop("is_listing")
    listings = listings.join(nodes_of(pages, listings), "url")
    listed = listing_links(listings, profile, profile.jobs_per_listing, or_page_itself=True).select(
        F.col("job_url").alias("url"), "card_title", seq(PAGE_PASS, F.col("link_seq"), F.col("pos")).alias("seq")
    )
    kind = is_marketing_title(F.col("card_title"), profile).alias("is_marketing")
    return (
        single.unionByName(listed)
        .groupBy("url", kind)
        .agg(F.min("seq").alias("seq"), F.min_by("card_title", "seq").alias("card_title"))
        .drop("is_marketing")
    )


def detail_jobs(targets: DataFrame, pages: Pages, profile: SiteProfile) -> DataFrame:
    """Job rows of the target pages; a card title replaces a missing title."""
    rows = page_jobs(targets.join(nodes_of(pages, targets), "url"), profile)
    title = F.when(F.col("job_title") == "Untitled", F.coalesce("card_title", "job_title")).otherwise(
        F.col("job_title")
    )
    return rows.withColumn("job_title", title).select(*JOB_COLUMNS)


def enrichment_targets(jobs: DataFrame, classes: DataFrame, limit: int | None) -> DataFrame:
    """(url, seq): application links of jobs found so far that no job-page link has, in job order.

    There are none if no link is a hub.
    """
    read_before = classes.where("is_job_page").select(F.col("url").alias("application_url"))
    hubs = classes.where("is_hub").select("url")
    fresh = (
        jobs.where(F.col("application_url") != "")
        .join(read_before, "application_url", "left_anti")
        .where(hubs.exists())
        .select(F.col("application_url").alias("url"), "seq")
    )
    return first_in_order(fresh, "seq", limit).groupBy("url").agg(F.min("seq").alias("seq"))


def enrichment_rows(targets: DataFrame, pages: Pages, profile: SiteProfile) -> DataFrame:
    later = seq(ENRICH_PASS, F.col("seq.link"), F.col("seq.pos"), via=F.col("seq.pass")).alias("seq")
    rows = targets.select("url", later).join(nodes_of(pages, targets), "url")
    return page_jobs(rows, profile).select(*JOB_COLUMNS)


def found_jobs(
    classes: DataFrame,
    pages: Pages,
    profile: SiteProfile = WHOLE_PROFILE,
    fetch_rss: bool = True,
    fetch_job_pages: bool = True,
    max_job_pages: int | None = None,
) -> DataFrame:
    """Accepted jobs of the feed pass and the page pass, first one per key.

    The accepted rows are stored with their texts, once; the choice reads only their keys and places.
    """
    passes = []
    if fetch_rss:
        passes.append(feed_jobs(hub_origins(classes), pages, profile))
    if fetch_job_pages:
        # Stored, since a hop's targets name what is read and meet what was read.
        targets = staged(detail_targets(classes, pages, profile, max_job_pages))
        passes.append(detail_jobs(targets, pages, profile))
    if not passes:
        raise ValueError("at least one of fetch_rss and fetch_job_pages is needed")
    rows = passes[0] if len(passes) == 1 else passes[0].unionByName(passes[1])
    return first_wins(staged(accepted(rows, profile)))


def extract_jobs(
    links: DataFrame,
    pages: Pages,
    profile: SiteProfile = WHOLE_PROFILE,
    fetch_rss: bool = True,
    fetch_job_pages: bool = True,
    max_job_pages: int | None = None,
) -> DataFrame:
    """Job rows (JOB_COLUMNS) of `links` (link_seq, url) over `pages`.

    `pages` is a fetched-page table of which only wanted pages are read, hop by hop (`WantedPages`), or a table of
    pages that were all read before (`read_pages`, stored by `stage_pages`). `max_job_pages` limits the page
    links and, separately, the enriched links; without it all are read. The links are read several times.
    """
    classes = classify(links, profile)
    jobs = found_jobs(classes, pages, profile, fetch_rss, fetch_job_pages, max_job_pages)
    if not (fetch_rss and fetch_job_pages):
        return jobs
    jobs = staged(jobs)
    targets = staged(enrichment_targets(jobs, classes, max_job_pages))
    enriched = staged(enrichment_rows(targets, pages, profile))
    return merge_enrichment(jobs, enriched, profile)
