"""Tables written to the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below `spark.checkpoint.dir`, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/staging"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


_SCOPES: list[list[str]] = []


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows of `make()`, stored; what it stored on the way is removed once they are."""
    _SCOPES.append([])
    try:
        rows = make()
        folder = shared_folder(spark)
        rows.write.parquet(folder)
    finally:
        passing = _SCOPES.pop()
    for name in passing:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if _SCOPES:
        _SCOPES[-1].append(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def staged(rows: DataFrame) -> DataFrame:
    """`rows` written once and read back: the lineage ends at files that outlive lost executors, and values
    that depend on a row's place, such as partition numbers, are fixed from here on."""
    folder = shared_folder(rows.sparkSession)
    rows.write.parquet(folder)
    if _SCOPES:
        _SCOPES[-1].append(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, most: int = 6 << 20) -> None:
    """Lowers the session's limit on the bytes of a batch sent to Python, where it is above `most`.

    A batch lies whole in a Python worker, and off the heap in the executor; at the default of 10,000 rows or
    64 MB long texts take most of the memory there. Batches of texts beyond the limit have one row.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    told = spark.conf.get(key)
    if not (told.isdigit() and 0 < int(told) <= most):
        spark.conf.set(key, most)
