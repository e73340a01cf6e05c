"""Output files. Every output is a folder of part files in order, written in parallel."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.operators.schema import FEED_FIELDS, FEED_PASS, METADATA_FIELDS

_OUTPUT_ORDER = ("job_title", "job_description", "application_url", "metadata", "source_site", "source_url")


def data_folder(folder: str) -> str:
    """Outputs always lie in a folder named `data`."""
    return folder.rstrip("/") if PurePosixPath(folder).name == "data" else f"{folder.rstrip('/')}/data"


def write_links(links: DataFrame, path: str, order: Sequence[str] = ("url",)) -> None:
    """One URL per line; the part files one after another are in `order`."""
    links.orderBy(*order).select("url").write.mode("overwrite").text(path)


def _records(jobs: DataFrame) -> DataFrame:
    """(seq, job), with metadata as a map of the fields that a job has.

    A job that a feed gave has all fields of a feed, known or not; of the others only known ones are there.
    """
    pairs = [part for name in METADATA_FIELDS for part in (F.lit(name), F.col(f"metadata.{name}"))]
    from_feed = F.col("seq.pass") == FEED_PASS
    fields = F.map_filter(
        F.create_map(*pairs), lambda name, value: value.isNotNull() | (from_feed & name.isin(*FEED_FIELDS))
    )
    jobs = jobs.withColumn("metadata", fields)
    return jobs.select("seq", F.struct(*[n for n in (*_OUTPUT_ORDER, "extracted_at") if n in jobs.columns]).alias("job"))


def write_jobs(jobs: DataFrame, path: str) -> None:
    """JSON lines in processing order, without absent fields; unknown ones of a feed are null."""
    _records(jobs).orderBy("seq").select("job.*").write.mode("overwrite").json(path, ignoreNullFields=True)


def job_array_lines(jobs: DataFrame) -> DataFrame:
    """(part, seq, value): lines that, in order of part and seq, are one indented JSON array.

    Each line is made on its own; the last one, which takes no comma, is known from an aggregate.
    """
    records = _records(jobs)
    last = jobs.agg(F.max("seq").alias("last")).select("last").scalar()
    text = F.to_json("job", {"pretty": "true", "ignoreNullFields": "true"})
    body = records.select(
        F.lit(1).alias("part"), "seq", F.concat(text, F.when(F.col("seq") == last, "").otherwise(",")).alias("value")
    )
    spark, schema = jobs.sparkSession, body.schema
    brackets = spark.createDataFrame([(0, None, "["), (2, None, "]")], schema)
    return brackets.unionByName(body)


def write_job_array(jobs: DataFrame, path: str) -> None:
    """The same jobs as one JSON array, spread over part files: concatenated in order they are the array."""
    job_array_lines(jobs).orderBy("part", "seq").select("value").write.mode("overwrite").text(path)
