"""The registered queries of this subpackage: each runs one operator over its whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import vacancyflow.llm
from vacancyflow.functions.once import once
from vacancyflow.llm import fingerprints, jaccard, language, lines, mixing, negatives, periodic, pieces, sharding, substrings, topk, toxicity, warc

# The functions that run in Python workers travel with the query, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(vacancyflow.llm)

PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
SHARDS, NEIGHBOURS = 24, 10

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(column: str, folds: int) -> Column:
    return F.crc32(F.col(column).cast("string")) % folds


@query
def op1_sharding(spark, folder):
    shards = sharding.byte_shards(table(spark, folder, "documents"), SHARDS)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_warc(spark, folder):
    read = warc.round_trip(table(spark, folder, "pages"))
    number = lambda name: F.regexp_extract(name, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    kept = read.filter("kind = 'record'")
    return kept.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


@query
def op6_topk(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, NEIGHBOURS)


@query
def op7_language(spark, folder):
    docs = table(spark, folder, "documents")
    models = language.trained(docs, fold("doc_id", 4) != 2)
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return language.identified(docs, models).select("doc_id", held_out, "lang_pred", "score", "cross_entropy", "rejected")


@query
def op8_mixing(spark, folder):
    return mixing.mixed(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_pieces(spark, folder):
    rows = pieces.encoded(table(spark, folder, "documents"), PIECE_MODEL, with_ids=False)
    return rows.select("doc_id", "pieces.n_tokens", "pieces.ids_sha256", "pieces.round_trip", "pieces.parity")


@query
def op2_jaccard(spark, folder):
    found = jaccard.near_duplicates(table(spark, folder, "documents"), length=4, least=85)
    doc_id = F.when(F.col("id") != jaccard.NO_ID, F.col("id")).alias("doc_id")
    return found.select(doc_id, "n_shingles", F.col("component").alias("component_id"))


@query
def op5_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.trained(docs, table(spark, folder, "labels"), fold("doc_id", 5) != 0)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return toxicity.scored(docs, model).select("doc_id", held_out, "score", "predicted")


@query
def op10_fingerprints(spark, folder):
    rows = fingerprints.fingerprints(table(spark, folder, "documents"))
    return rows.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


@query
def op3_substrings(spark, folder):
    rows = substrings.without_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document (by crc32 of its id) repeats p of its words from word a on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    given = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.coalesce(h % 10 == 0, F.lit(False)).alias("chosen"))
    words = F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    split = once(given, words=words).withColumn("n", F.size("words")).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    split = split.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    # p is more than a tenth of the n - a words, so ten times are enough.
    again = F.expr("concat(slice(words, 1, int(a)), slice(flatten(array_repeat(slice(words, int(a + 1), int(p)), 10)), 1, int(n - a)))")
    return split.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, folder):
    rows = periodic.without_runs(looped(table(spark, folder, "documents")))
    # The longest run; of equal ones the first, then the one with the smallest period.
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    told = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    rows = once(rows, longest=longest)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(told, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_hard_negatives(spark, folder):
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query
def op13_lines(spark, folder):
    rows = lines.without_repeated_lines(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
