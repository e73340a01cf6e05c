"""Contiguous shards of nearly equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.llm.prefix import with_prefix_sums
from vacancyflow.llm.shared import staged

RECORD_BYTES = 8


def byte_shards(docs: DataFrame, shards: int = 24, parts: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of `docs(doc_id, text, ...)`.

    Rows lie in the order of doc_id, null first. Their sizes, the UTF-8 bytes of the text plus 8, are summed
    along that order over the whole table; the line is cut at equal targets, and a row goes to the shard
    that holds its middle byte. A shard is therefore contiguous and differs from total/shards by at most
    one row at either end. Slots count from 0 inside a shard.

    A null text is as an empty one, with checksum 0. Rows with the same doc_id stay neighbours and each get
    a slot; among them size, checksum and place in the input decide. With fewer rows than shards, some
    shards stay empty; an empty table gives an empty result. Other columns are not read. Exact up to
    shards * total bytes of 4.6e18.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    # The place in the input splits a doc_id that many rows share; stored, it cannot change any more.
    narrow = staged(narrow.withColumn("place", F.monotonically_increasing_id()))
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32"), F.col("place")]
    placed = with_prefix_sums(narrow, order, ["size"], parts)
    total = narrow.agg(F.sum("size")).first()[0] or 1
    shard = F.expr(f"(2 * size_before + size) * {shards} div {2 * total}").cast("int")
    cut = staged(placed.withColumn("shard", shard).drop("size_before", "place"))
    first = cut.groupBy("shard").agg(F.min("row_before").alias("first"))
    slot = (F.col("row_before") - F.col("first")).alias("slot")
    return cut.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", slot)
