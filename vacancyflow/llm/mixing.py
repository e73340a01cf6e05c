"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancyflow.llm.prefix import with_prefix_sums
from vacancyflow.llm.shared import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, source_rank and target of every source in `sizes(source, size)`.

    Sources in code point order, null last, take the weights in turn and share all words by them. A target
    above `max_epochs` times its source stops there, and what is over is shared by weight among the others,
    again until none is above; each pass is one aggregate over the sources, so their number may grow.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_prefix_sums(sources, [F.col("source").asc_nulls_last()], [])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("row_before") % len(weights) + 1).cast("int"))
    table = ranked.select("source", "source_size", F.col("row_before").alias("source_rank"), weight.alias("weight"))
    table = staged(table.withColumn("ceiling", F.col("source_size") * float(max_epochs)).withColumn("stopped", F.lit(False)))
    while True:
        free = F.when(~F.col("stopped"), F.col("weight"))
        left = F.col("source_size") - F.when(F.col("stopped"), F.col("ceiling")).otherwise(0.0)
        # One row with two numbers; the loop ends after as many passes as there are rounds of resharing.
        room, weighed = table.agg(F.sum(left), F.sum(free)).first()
        level = F.col("weight") * F.lit((room or 0.0) / weighed if weighed else 0.0)
        above = ~F.col("stopped") & (level > F.col("ceiling"))
        if not table.filter(above).limit(1).count():
            break
        table = staged(table.withColumn("stopped", F.col("stopped") | above))
    target = F.when(F.col("stopped"), F.col("ceiling")).otherwise(level)
    return table.select("source", "source_size", "source_rank", target.cast("double").alias("target"))


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = "mix",
    whole: bool = False,
) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target and taken for every row of `docs(doc_id, text, source, ...)`.

    Each row gets a hash-random key from doc_id and text; the rows are range-sorted by source and key, and
    the words ahead of a row in its source come from global prefix sums. A source of size s and target t is
    taken t div s times in full; one more time, its rows are taken in the order of their keys until t is
    reached. `taken` counts the words: the row at the cut gives just what is missing, so a source takes
    floor(t) words exactly. With `whole` the row at the cut is taken in full or not at all, whichever is
    nearer, so a source misses t by at most half a row.

    The size is the number of words; null and empty texts have size 0 and are never taken. Null is a source
    of its own, the last one. Repeated rows are drawn each for itself. A source that holds most rows is
    split over many ranges. Empty tables give empty results; other columns are not read.
    """
    text_hash = F.xxhash64("text").alias("text_hash")
    narrow = docs.select("doc_id", text_hash, "source", word_count(F.col("text")).alias("size"))
    narrow = staged(narrow.withColumn("place", F.monotonically_increasing_id()))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    targets = staged(source_targets(narrow, weights, max_epochs))
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("text_hash"), F.col("place")]
    drawn = with_prefix_sums(narrow.withColumn("key", key), order, ["size"])
    start = with_prefix_sums(targets, [F.col("source").asc_nulls_last()], ["source_size"])
    start = start.withColumnRenamed("source", "of").withColumnRenamed("source_size_before", "start")
    rows = drawn.join(start, F.col("source").eqNullSafe(F.col("of")))
    ahead = F.col("size_before") - F.col("start")
    budget = F.floor("target").cast("long")
    rows = rows.withColumn("epochs", F.expr("case when source_size > 0 then floor(target) div source_size else 0 end"))
    rest = budget - F.col("epochs") * F.col("source_size") - ahead
    if whole:
        part = F.when(rest * 2 > F.col("size"), F.col("size")).otherwise(0)
    else:
        part = F.greatest(F.lit(0), F.least(rest, F.col("size")))
    taken = (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")
    return rows.select("doc_id", "text_hash", "source", "size", "source_size", "target", taken)
