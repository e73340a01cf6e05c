"""Global prefix sums without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancyflow.llm.shared import partitions, staged


def with_prefix_sums(rows: DataFrame, order: Sequence[Column], sums: Sequence[str], parts: int | None = None) -> DataFrame:
    """Adds `row_before` (number of rows ahead) and `<name>_before` (sum of `name` ahead) along `order`.

    The rows are range-partitioned on `order` and stored with their partition number. Partition totals, one
    row each, give every partition's offset; a window inside each partition gives the rest. `order` must be
    total up to rows that are equal in every column, else a hot key lies in one partition and ties are
    settled by chance. Null sums count as 0; an empty table stays empty.
    """
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(parts or partitions(spark), *order)
    ranged = staged(ranged.withColumn("_part", F.spark_partition_id()))
    names = ["row", *sums]
    counted = ranged.withColumn("row", F.lit(1).cast("long"))
    totals = counted.groupBy("_part").agg(*[F.sum(n).alias(f"_{n}_total") for n in names])
    # One row per range partition, so this window and the broadcast are bounded by their number.
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_{n}_total").over(ahead), F.lit(0)).alias(f"_{n}_offset") for n in names])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = counted.select("*", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"_{n}_local") for n in names])
    added = [(F.col(f"_{n}_offset") + F.col(f"_{n}_local")).cast("long").alias(f"{n}_before") for n in names]
    return local.join(F.broadcast(offsets), "_part").select(*rows.columns, *added)
