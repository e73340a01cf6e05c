"""Intermediate tables that are read more than once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    """A new folder below the session's shared checkpoint folder, or below its warehouse where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/staging"
    return f"{shared.rstrip('/')}/vacancyflow-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def staged(rows: DataFrame) -> DataFrame:
    """`rows` written once as parquet and read back.

    Cuts the lineage at a table that outlives lost executors, and later reads load only the columns, down
    to single struct fields, that they use.
    """
    folder = staging_folder(rows.sparkSession)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def stage_pages(pages: DataFrame, table: str | None = None, buckets: int | None = None) -> DataFrame:
    """Pages written as a table bucketed by url, and read back.

    Listings, job pages and enrichment all join pages on url. Here the nodes are shuffled once, when the
    table is written with one file per bucket; the three joins then only shuffle their links. The table lies
    in the staging folder; the catalog gets its name only, under a new one unless `table` is given.
    Buckets default to the session's shuffle partitions.
    """
    spark = pages.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = table or f"vacancyflow_pages_{uuid.uuid4().hex}"
    writer = pages.repartition(count, "url").write.bucketBy(count, "url").sortBy("url")
    writer.option("path", staging_folder(spark)).saveAsTable(name)
    return spark.table(name)
