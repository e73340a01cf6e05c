"""Document fingerprints: chains of content words behind common words."""

from __future__ import annotations

from collections.abc import Sequence
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancyflow.llm.prefix import with_prefix_sums
from vacancyflow.llm.shared import staged

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "of", "on", "or", "that", "the", "to", "was", "with",
    "auf", "das", "dem", "den", "der", "die", "ein", "für", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "avec", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "par", "pour", "que", "sur", "un", "une",
    "con", "el", "es", "las", "los", "para", "por", "se", "y",
)
CHAIN = 2
MARK = "\x01"
NO_ID = -(1 << 63)


def signatures(text: Column, anchors: Sequence[str] = ANCHORS, chain: int = CHAIN) -> Column:
    """The sorted hashes of all chains: `chain` content words in a row from the first one behind an anchor on.

    Words are runs of letters and digits, lower-cased. A chain keeps a mark where more anchors stand within
    it. A text without any chain has one signature, that of all its words; so empty texts are alike.
    """
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    marked = F.regexp_replace(words, f"(?<= )(?:{'|'.join(anchors)}) ", MARK)
    further = rf"(?: {MARK}*[^ {MARK}]+)" * (chain - 1)
    chains = F.regexp_extract_all(marked, F.lit(rf"{MARK}(?=([^ {MARK}]+{further}))"), F.lit(1))
    hashes = F.sort_array(F.array_distinct(F.transform(chains, lambda x: F.xxhash64(x))))
    return F.when(F.size(hashes) > 0, hashes).otherwise(F.array(F.xxhash64(F.trim(words))))


def fingerprint(hashes: Column) -> Column:
    return F.array_join(hashes.cast("array<string>"), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets."""
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def followers(docs: DataFrame) -> DataFrame:
    """id, text_hash, half and next_id, next_hash of every document of `docs(id, text_hash, text)`.

    Documents lie in the order of id, the null one, NO_ID, first, then of text_hash; after the last comes
    the first. Equal rows are one document. `half` is floor(characters / 2).
    """
    narrow = docs.groupBy("id", "text_hash").agg(F.first(F.length("text")).alias("n_chars"))
    placed = staged(with_prefix_sums(narrow, [F.col("id"), F.col("text_hash")], []))
    count = placed.count()
    after = placed.select(((F.col("row_before") - 1 + count) % max(count, 1)).alias("row_before"), F.col("id").alias("next_id"), F.col("text_hash").alias("next_hash"))
    half = (F.col("n_chars") / 2).cast("int").alias("half")
    return staged(placed.join(after, "row_before").select("id", "text_hash", half, "next_id", "next_hash"))


def fingerprints(docs: DataFrame, anchors: Sequence[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Fingerprints of every row of `docs(doc_id, text, ...)` and of its edited text.

    doc_id, n_chars, edited (the text whose last floor(n_chars / 2) characters are replaced by as many first
    ones of the next document), fingerprint, edited_fingerprint, near_edited and near_next. Null texts are
    empty ones. Rows equal in doc_id and text are one document and give equal rows; a null doc_id lies
    before all others. An empty table gives an empty result; other columns are not read.

    Texts are dealt out once, by doc_id and hash of the text; a narrow table says which document follows
    which, and only the part of the next text that is needed, with its signatures, is dealt out again.
    """
    text = F.coalesce("text", F.lit(""))
    given = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    links = followers(given)
    one = Window.partitionBy("id", "text_hash").orderBy("text_hash")
    single = given.withColumn("again", F.lag(F.lit(1)).over(one)).filter("again is null").drop("again")
    single = single.select(F.col("id").alias("next_id"), F.col("text_hash").alias("next_hash"), F.col("text").alias("next_text"))
    heads = links.join(single, ["next_id", "next_hash"]).select("id", "text_hash", "half", F.substring("next_text", F.lit(1), F.col("half")).alias("head"), signatures(F.col("next_text"), anchors, chain).alias("next_signatures"))
    rows = given.join(heads, ["id", "text_hash"])
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - F.col("half")), F.col("head"))
    rows = rows.select("id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), signatures(F.col("text"), anchors, chain).alias("own"), "next_signatures")
    rows = rows.withColumn("changed", signatures(F.col("edited"), anchors, chain))
    doc_id = F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id")
    return rows.select(
        doc_id,
        "n_chars",
        "edited",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_signatures")).alias("near_next"),
    )


def near_pairs(docs: DataFrame, least: float = 0.8, anchors: Sequence[str] = ANCHORS, chain: int = CHAIN) -> tuple[DataFrame, DataFrame]:
    """Pairs of different fingerprints with a likeness of `least` or more, and the membership of documents.

    Returns (first, second, likeness) between classes and (doc_id, class_id), where a class holds the
    documents of one fingerprint and is named by its hash. Sets are dealt out by the partition of their
    length, a power of 1/least, so partners lie in the same partition or the next; within, sets meet where
    their rarest signatures agree, as many as a partner cannot do without, and lengths are compared before
    the sets.
    """
    sets = docs.select("doc_id", signatures(F.coalesce("text", F.lit("")), anchors, chain).alias("set"))
    sets = staged(sets.withColumn("class_id", F.xxhash64("set")))
    classes = staged(sets.dropDuplicates(["class_id"]).select("class_id", "set", F.size("set").alias("n")))
    items = classes.select("class_id", "n", F.explode("set").alias("item"))
    counts = items.groupBy("item").agg(F.count(F.lit(1)).alias("docs"))
    ranked = items.join(counts.filter("docs > 1"), "item")
    by_rarity = Window.partitionBy("class_id").orderBy("docs", "item")
    single = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("class_id"))  # signatures of no other class, the rarest
    ranked = ranked.withColumn("place", F.row_number().over(by_rarity) + single)
    prefix = ranked.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * least) + 1)
    part = F.floor(F.log(F.col("n").cast("double")) / -log(least)).cast("int")
    prefix = prefix.withColumn("part", part).select("class_id", "n", "item", "part")
    right = prefix.select(F.col("class_id").alias("second"), F.col("n").alias("m"), "item", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    met = prefix.withColumnRenamed("class_id", "first").join(right, ["item", "part"]).filter("first <> second and m <= n")
    met = met.filter((F.col("m") >= F.col("n") * least) & ((F.col("m") < F.col("n")) | (F.col("first") < F.col("second"))))
    pairs = met.select("first", "second").distinct()
    a, b = (classes.select(F.col("class_id").alias(x), F.col("set").alias(f"{x}_set")) for x in ("first", "second"))
    value = likeness(F.col("first_set"), F.col("second_set")).alias("likeness")
    pairs = pairs.join(a, "first").join(b, "second").select("first", "second", value).filter(F.col("likeness") >= least)
    return pairs, sets.select("doc_id", "class_id")
