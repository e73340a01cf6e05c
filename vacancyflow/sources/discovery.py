"""Raw material for discovering sites: certificate-log records and search results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacancyflow.functions.text import strip
from vacancyflow.functions.urls import UrlParts, origin, split_url
from vacancyflow.profile import SiteProfile


def read_certificate_records(spark: SparkSession, path: str, json_lines: bool = True) -> DataFrame:
    """Only the names are read. JSON lines are read in splits; a file that is one JSON array is read by one task."""
    return spark.read.schema("name_value string").json(path, multiLine=not json_lines)


def certificate_domains(records: DataFrame, profile: SiteProfile) -> DataFrame:
    """Distinct lower-case vendor domains named in certificates."""
    name = F.explode(F.split(F.coalesce(F.col("name_value"), F.lit("")), "\n"))
    return (
        records.select(name.alias("name"))
        .select(F.lower(strip(F.replace(F.col("name"), F.lit("*."), F.lit("")))).alias("domain"))
        .where(F.col("domain").endswith(profile.vendor_suffix))
        .distinct()
    )


def search_bases(results: DataFrame, profile: SiteProfile) -> DataFrame:
    """Distinct origins of vendor sites among the first results of each query, or all without a limit.

    The row-number filter becomes a group limit before the shuffle, so each task sends at most the
    cap per query however many results a query has.
    """
    found = results.where(F.col("query").isin(*profile.search_queries))
    if profile.search_results_per_query is not None:
        by_rank = Window.partitionBy("query").orderBy("rank")
        ranked = found.withColumn("place", F.row_number().over(by_rank))
        found = ranked.where(F.col("place") <= profile.search_results_per_query)
    found = found.where("href <> ''")
    return (
        split_url(found, "href", "href_")
        .where("href_netloc <> ''")
        .select(origin(UrlParts.columns("href_")).alias("base"))
        .where(F.lower("base").contains(profile.vendor_token))
        .distinct()
    )
