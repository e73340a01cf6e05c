"""Whole runs: crawl, extract, and both after another."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from vacancyflow.operators.jobs import with_timestamp
from vacancyflow.plans.crawl import LINK_ORDER, all_links, career_links
from vacancyflow.plans.extract import extract_jobs
from vacancyflow.plans.staging import staged
from vacancyflow.profile import WHOLE_PROFILE, SiteProfile
from vacancyflow.sinks.files import data_folder, write_job_array, write_jobs, write_links
from vacancyflow.sources.links import load_links
from vacancyflow.sources.wanted import Pages, WantedPages

log = logging.getLogger(__name__)


def default_links(output_dir: str = "data") -> list[str]:
    """Seed links, all links and career links of a data folder; one that does not exist counts as empty."""
    folder = data_folder(output_dir)
    return [f"{folder}/{name}" for name in ("initial_links.txt", "all_links", "career_links")]


def crawl(
    certificates: DataFrame,
    results: DataFrame,
    pages: Pages,
    output_dir: str = "data",
    profile: SiteProfile = WHOLE_PROFILE,
    validate: bool = True,
    include_job_links: bool = True,
) -> tuple[str, str]:
    """Write `career_links` and `all_links` below the data folder and return both paths."""
    folder = data_folder(output_dir)
    paths = f"{folder}/career_links", f"{folder}/all_links"
    sites = staged(career_links(certificates, results, pages, profile, validate))
    write_links(sites, paths[0])
    # Stored before the sort, which reads its input twice.
    links = staged(all_links(sites, pages, profile, include_job_links))
    write_links(links, paths[1], LINK_ORDER)
    log.info("career sites written: %d, links written: %d", sites.count(), links.count())
    return paths


def run_extraction(
    spark: SparkSession,
    link_files: Sequence[str] | None,
    pages: Pages,
    output: str = "data/jobs",
    profile: SiteProfile = WHOLE_PROFILE,
    fetch_rss: bool = True,
    fetch_job_pages: bool = True,
    max_job_pages: int | None = None,
    as_array: bool = False,
) -> str | None:
    """Load the link files, in order of preference, extract the jobs and write them; return the path.

    Without `link_files` those of the output's folder are taken. If they hold no link, nothing is written, an
    older output stays, and the path is None.
    """
    parent, _, name = output.rpartition("/")
    path = f"{data_folder(parent or '.')}/{name}"
    links = staged(load_links(spark, default_links(parent or ".") if link_files is None else link_files))
    count = links.count()
    log.info("links loaded: %d", count)
    if not count:
        return None
    jobs = staged(extract_jobs(links, pages, profile, fetch_rss, fetch_job_pages, max_job_pages))
    write = write_job_array if as_array else write_jobs
    write(with_timestamp(jobs), path)
    log.info("jobs written: %d", jobs.count())
    return path


def run_all(
    spark: SparkSession,
    certificates: DataFrame,
    results: DataFrame,
    fetched: DataFrame,
    output_dir: str = "data",
    seed_files: Sequence[str] | None = None,
    profile: SiteProfile = WHOLE_PROFILE,
    max_job_pages: int | None = None,
) -> str | None:
    """Crawl, then extract from the seed files, all links and career links; only wanted pages are taken apart.

    The seed links are the data folder's `initial_links.txt` unless files are given.
    """
    pages = WantedPages(fetched, profile)
    career, everything = crawl(certificates, results, pages, output_dir, profile)
    seeds = default_links(output_dir)[:1] if seed_files is None else seed_files
    link_files = [*seeds, everything, career]
    output = f"{data_folder(output_dir)}/jobs"
    return run_extraction(spark, link_files, pages, output, profile, max_job_pages=max_job_pages)
