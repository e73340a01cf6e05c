"""Link files: scanning, keeping valid lines, ordered merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancyflow.functions.text import strip

LINE_SCHEMA = "link_seq struct<source:int,file:string,block:bigint,row:bigint>, value string"


def read_link_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of several link files, in order of preference, as (link_seq, value).

    Files are read in splits, so one huge file still spreads over the cluster. `link_seq` sorts by
    place in `paths`, then by file, by split offset and by row within the split, which is line order.
    A missing file counts as empty.
    """
    lines = spark.createDataFrame([], LINE_SCHEMA)
    for source, path in enumerate(paths):
        try:
            text = spark.read.text(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        place = F.struct(
            F.lit(source).alias("source"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        lines = lines.unionByName(text.select(place.alias("link_seq"), "value"))
    return lines


def valid_links(lines: DataFrame) -> DataFrame:
    """Lines that hold an http(s) link; comments and blanks go, repeats stay."""
    return (
        lines.withColumn("url", strip(F.col("value")))
        .where(F.col("url").rlike("^https?://"))
        .drop("value")
    )


def first_links(links: DataFrame) -> DataFrame:
    """Each link once, at its first place. Map-side minimum first, so a hot link costs a row per task."""
    return links.groupBy("url").agg(F.min("link_seq").alias("link_seq"))


def load_link_file(spark: SparkSession, path: str) -> DataFrame:
    """(link_seq, url) of one link file, with its repeats."""
    return valid_links(read_link_lines(spark, [path]))


def load_links(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(link_seq, url) of a list of link files, merged without repeats, however many there are."""
    return first_links(valid_links(read_link_lines(spark, paths)))
