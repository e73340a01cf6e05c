"""A corpus from raw documents to token ids: five stages, each written as Parquet and read again by the next.

1. language: documents without letters, and those that no language's model fits, go.
2. near_duplicates: of documents linked by shingles of five words and a similarity of 0.8 one stays.
3. passages: words of passages that a document with a smaller doc_id has go; the rest is joined by spaces.
4. mixing: whole documents are left out or repeated, so that sources come near their target shares of words.
5. pieces: the texts become token ids.

Each stage takes what its predecessor kept. All but the last return the columns doc_id, text, lang, source
and n_chars, whatever else the input has; n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacancyflow.llm import jaccard, language, mixing, pieces, substrings
from vacancyflow.llm.queries import PIECE_MODEL, fold
from vacancyflow.llm.shared import settled, small_batches, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Executors keep memory of the stages before, so batches are smaller than the operators' own.
BATCH_BYTES = 3 << 20


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the models know; null texts and texts without letters go, in whatever `lang`."""
    small_batches(spark, BATCH_BYTES)
    models = language.trained(docs, fold("doc_id", 4) != 2)
    return language.identified(docs, models, COLUMNS).filter(~F.col("rejected")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, then hash of the text; null ids come last.

    Documents without words are in no group and all stay. Of rows equal in doc_id and text one stays.
    """
    small_batches(spark, BATCH_BYTES)
    found = settled(spark, lambda: jaccard.near_duplicates(docs))
    order = F.struct(F.col("id") == jaccard.NO_ID, F.col("id"), F.col("text_hash"))
    first = found.filter("label is not null").groupBy("label").agg(F.min(order).alias("f")).select("f.id", "f.text_hash")
    alone = found.filter("label is null").select("id", "text_hash").distinct()
    kept = first.union(alone).toDF("_id", "_hash")
    given = docs.select(*COLUMNS, F.coalesce("doc_id", F.lit(jaccard.NO_ID)).cast("long").alias("_id"), F.xxhash64("text").alias("_hash"))
    rows = given.join(kept, ["_id", "_hash"], "left_semi")
    # Rows without words are each their own; of the others equal ones count once.
    again = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("n_chars"))
    words = mixing.word_count(F.col("text")) > 0
    return rows.withColumn("_again", again).filter((F.col("_again") == 1) | ~words).select(*COLUMNS)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words of passages seen before; a text that loses nothing stays as it is."""
    small_batches(spark, BATCH_BYTES)
    rows = substrings.without_repeats(docs, COLUMNS, changed=True, chunk_bytes=BATCH_BYTES // 2)
    text = F.coalesce("kept", "text").alias("text")
    return rows.select("doc_id", text, "lang", "source", F.coalesce(F.length("kept").cast("long"), "n_chars").alias("n_chars"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix takes them; those without words, which count nothing, stay once."""
    taken = mixing.mixed(docs, whole=True)
    copies = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(1)
    keys = [F.coalesce("doc_id", F.lit(jaccard.NO_ID)).cast("long").alias("_id"), F.coalesce("source", F.lit("")).alias("_source"), F.col("source").isNull().alias("_none")]
    counts = taken.groupBy(*keys, F.col("text_hash").alias("_hash")).agg(F.sum(copies).alias("_copies")).filter("_copies > 0")
    rows = docs.select(*COLUMNS, *keys, F.xxhash64("text").alias("_hash")).join(counts, ["_id", "_source", "_none", "_hash"])
    # Rows equal in doc_id, source and text share what is taken of them.
    same = Window.partitionBy("_id", "_source", "_none", "_hash")
    rows = rows.withColumn("_rows", F.count(F.lit(1)).over(same)).withColumn("_row", F.row_number().over(same.orderBy("n_chars")))
    share = F.expr("cast(_copies div _rows + if(_row <= _copies % _rows, 1, 0) as int)")
    rows = rows.withColumn("_share", share).filter("_share > 0")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_share")))).select(*COLUMNS)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, ids_sha256, round_trip and parity of every document."""
    small_batches(spark, BATCH_BYTES)
    rows = pieces.encoded(docs, PIECE_MODEL, ("doc_id", "lang", "source"))
    return rows.select("doc_id", "lang", "source", "pieces.ids", "pieces.n_tokens", "pieces.ids_sha256", "pieces.round_trip", "pieces.parity")


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("mixing", mixing_stage),
    ("pieces", piece_stage),
]

# Language models and token merges are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; what each returns is stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
