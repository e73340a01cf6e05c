"""Command line for spark-submit: crawl, extract, or both."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from vacancyflow import WHOLE_PROFILE
from vacancyflow.plans.run import crawl, run_all, run_extraction
from vacancyflow.sources.discovery import read_certificate_records
from vacancyflow.sources.wanted import WantedPages


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("step", choices=("crawl", "extract", "all"))
    parser.add_argument("--fetched", required=True, help="parquet of url, status, body, and maybe fetched_at")
    parser.add_argument("--certificates", help="certificate records as JSON lines, or as one JSON array with --json-array")
    parser.add_argument("--json-array", action="store_true")
    parser.add_argument("--results", help="parquet of query, rank, href")
    parser.add_argument("--links", nargs="*", help="link files in order of preference; by default those of the output folder")
    parser.add_argument("--output-dir", default="data")
    parser.add_argument("--no-validate", action="store_true")
    parser.add_argument("--sites-only", action="store_true", help="no links from feeds")
    parser.add_argument("--no-rss", action="store_true")
    parser.add_argument("--no-pages", action="store_true")
    parser.add_argument("--max-pages", type=int, help="at most so many job pages; all without it")
    parser.add_argument("--as-array", action="store_true", help="one JSON array instead of JSON lines")
    return parser.parse_args()


def main() -> None:
    args = arguments()
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    spark = SparkSession.builder.appName("vacancyflow").getOrCreate()
    fetched = spark.read.parquet(args.fetched)
    limit = args.max_pages
    if args.step == "extract":
        pages = WantedPages(fetched, WHOLE_PROFILE)
        output = f"{args.output_dir.rstrip('/')}/jobs"
        switches = {"fetch_rss": not args.no_rss, "fetch_job_pages": not args.no_pages, "as_array": args.as_array}
        run_extraction(spark, args.links, pages, output, max_job_pages=limit, **switches)
        return
    certificates = read_certificate_records(spark, args.certificates, not args.json_array)
    results = spark.read.parquet(args.results)
    if args.step == "crawl":
        pages = WantedPages(fetched, WHOLE_PROFILE)
        switches = {"validate": not args.no_validate, "include_job_links": not args.sites_only}
        crawl(certificates, results, pages, args.output_dir, **switches)
    else:
        run_all(spark, certificates, results, fetched, args.output_dir, args.links, max_job_pages=limit)


if __name__ == "__main__":
    main()
