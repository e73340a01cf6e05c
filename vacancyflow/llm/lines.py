"""Line deduplication: two Bloom filters name the suspects, and only these are compared exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancyflow.llm.shared import partitions, staged
from vacancyflow.llm.words import chunks

LEAST_CHARS = 10
CELLS_PER_LINE, MOST_CELLS, SLICE = 16, 1 << 29, 1 << 16
STRIPPED = " \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1  # stands for a null doc_id


def split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All lines in one array, and each text's start (one more at the end); a null text is one empty line."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    return lists.flatten(), offsets - offsets[0]


def line_keys(lines: pa.Array, least: int) -> tuple[np.ndarray, list[bytes]]:
    """Places of the lines whose key has at least `least` code points, and the 128-bit hashes of their keys."""
    key = pc.ascii_lower(pc.ascii_trim(lines, characters=STRIPPED))
    at = np.flatnonzero(pc.greater_equal(pc.utf8_length(key), least).to_numpy(zero_copy_only=False))
    digest = xxhash.xxh3_128_digest
    return at, [digest(x) for x in key.take(pa.array(at)).cast(pa.binary()).to_pylist()]


def document_keys(texts: pa.Array, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and key hash (16 bytes) of the distinct keys of each text."""
    lines, starts = split_lines(texts)
    at, digests = line_keys(lines, least)
    owner = np.searchsorted(starts, at, side="right") - 1
    rows = np.empty(len(at), [("owner", np.int64), ("key", "V16")])
    rows["owner"], rows["key"] = owner, np.frombuffer(b"".join(digests), "V16")
    words = rows["key"].copy().view(np.uint64).reshape(-1, 2)
    order = np.lexsort((words[:, 0], words[:, 1], owner))
    words, owner = words[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (words[1:] != words[:-1]).any(axis=1)
    return owner[new], words[new]


def cells(words: np.ndarray, size: int) -> np.ndarray:
    """The two cells of each key hash, a column each; `size` is a power of two."""
    return (words & np.uint64(size - 1)).astype(np.uint32)


def seen(batches: Iterator[pa.RecordBatch], size: int, least: int) -> Iterator[pa.RecordBatch]:
    """slice, once and twice: cells hit by keys of one document and of more documents of the task."""
    hits = [cells(document_keys(batch.column(0), least)[1], size).ravel() for batch in chunks(batches, 0)]
    found, many = np.unique(np.concatenate([np.zeros(0, np.uint32), *hits]), return_counts=True)
    bounds = np.searchsorted(found, np.arange(0, size + SLICE, SLICE))
    for number in np.flatnonzero(np.diff(bounds)):
        part = slice(bounds[number], bounds[number + 1])
        inside, again = (found[part] & np.uint32(SLICE - 1)).astype(np.uint16), many[part] > 1
        told = [pa.array([x.tobytes()], pa.binary()) for x in (inside[~again], inside[again])]
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *told], ["slice", "once", "twice"])


def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """slice and the bits of its cells seen twice, from rows sorted by slice; two filters of one slice are held."""
    now, once, twice = None, np.zeros(SLICE, bool), np.zeros(SLICE, bool)

    def close() -> pa.RecordBatch:
        bits = np.packbits(twice, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bits], pa.binary())], ["slice", "bits"])

    for batch in batches:
        for number, single, double in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if number != now:
                if twice.any():
                    yield close()
                now, once[:], twice[:] = number, False, False
            single, double = np.frombuffer(single, np.uint16), np.frombuffer(double, np.uint16)
            twice[single[once[single]]] = True
            twice[double] = True
            once[single] = once[double] = True
    if twice.any():
        yield close()


def twice_seen(texts: DataFrame, least: int) -> tuple[np.ndarray, int]:
    """The filter of twice-seen keys as bytes, and its number of cells.

    A key may be in two documents only if all its cells are in the filter: a cell counts as seen twice if two
    documents hit it, wherever they are. Tasks send the cells they hit, 2 bytes each; the slices of the two
    filters are merged apart from one another. The filter has 16 cells or more for each line, but at most
    2^29 (64 MB); on larger inputs more lines are suspected, and the result is the same.
    """
    spark = texts.sparkSession
    breaks = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    lines = texts.agg(F.sum(breaks + 1)).first()[0] or 0
    size = min(MOST_CELLS, max(SLICE, 1 << (CELLS_PER_LINE * int(lines)).bit_length()))
    hit = texts.select("text").mapInArrow(lambda b: seen(b, size, least), "slice int, once binary, twice binary")
    merged = hit.repartition(partitions(spark), "slice").sortWithinPartitions("slice").mapInArrow(met, "slice int, bits binary")
    out = np.zeros(size // 8, np.uint8)
    for row in merged.toLocalIterator():  # at most 2^13 slices of 8 kB
        at = row.slice * (SLICE // 8)
        out[at : at + SLICE // 8] = np.frombuffer(row.bits, np.uint8)
    return out, size


SUSPECT = "key binary, least long, most long, ids array<long>, tags array<long>"


def suspected(batches: Iterator[pa.RecordBatch], bits: np.ndarray, size: int, least: int) -> Iterator[pa.RecordBatch]:
    """Suspect keys with the documents of a batch that hold them, from (id, tag, text): one row a key and batch."""
    for batch in chunks(batches, 2):
        owner, words = document_keys(batch.column(2), least)
        at = cells(words, size)
        hit = ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
        owner, words = owner[hit], words[hit]
        ids, tags = (batch.column(i).to_numpy()[owner] for i in (0, 1))
        order = np.lexsort((ids, words[:, 0], words[:, 1]))
        words, ids, tags = words[order], ids[order], tags[order]
        new = np.ones(len(order), bool)
        new[1:] = (words[1:] != words[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        offsets = pa.array(np.append(first, len(order)).astype(np.int32))
        last = np.append(first[1:], len(order)) - 1 if len(first) else first
        key = pa.array([x.tobytes() for x in words[first]], pa.binary())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (ids, tags)]
        yield pa.RecordBatch.from_arrays([key, pa.array(ids[first]), pa.array(ids[last]), *lists], ["key", "least", "most", "ids", "tags"])


def shortened(batches: Iterator[pa.RecordBatch], count: int, names: list[str], least: int) -> Iterator[pa.RecordBatch]:
    """n_lines, n_dropped and the kept lines of (kept columns, text, keys to drop)."""
    for batch in chunks(batches, count):
        lines, starts = split_lines(batch.column(count))
        keep = np.ones(len(lines), bool)
        for row, gone in enumerate(batch.column(count + 1)):
            if gone.is_valid:
                a, b = starts[row], starts[row + 1]
                wanted = set(gone.as_py())
                at, digests = line_keys(lines.slice(a, b - a), least)
                keep[a + at] = [x not in wanted for x in digests]
        before = np.concatenate([[0], np.cumsum(keep)])[starts]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), lines.filter(pa.array(keep))), "\n")
        n, kept = np.diff(starts), np.diff(before)
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(count)], pa.array(n), pa.array(n - kept), texts.cast(pa.string())], names)


def repeated_keys(spark: SparkSession, docs: DataFrame, least: int) -> DataFrame:
    """id, tag and the keys that each text of `docs(id, tag, text)` loses."""
    bits, size = twice_seen(docs, least)
    told = spark.sparkContext.broadcast(bits)  # 64 MB at most
    suspects = staged(docs.mapInArrow(lambda b: suspected(b, told.value, size, least), SUSPECT))
    # A key has one row for each batch of texts, not for each line.
    repeated = suspects.groupBy("key").agg(F.min("least").alias("first"), F.max("most").alias("last")).filter("first < last")
    losers = suspects.join(repeated.select("key", "first"), "key").filter("most > first")
    losers = losers.select("key", "first", F.inline(F.arrays_zip("ids", "tags"))).filter("ids > first")
    # At most a document's own number of lines.
    return losers.groupBy(F.col("ids").alias("id"), F.col("tags").alias("tag")).agg(F.collect_list("key").alias("gone"))


def without_repeated_lines(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), least: int = LEAST_CHARS) -> DataFrame:
    """The columns `keep` of every row of `docs(doc_id, text, ...)`, then n_lines, n_dropped and kept.

    Texts are split at \\n. A line's key is the line without space and \\t to \\r at both ends, A to Z
    lower-cased. A key of at least `least` code points that two documents hold stays only in the one with the
    smallest doc_id, there with all its lines; elsewhere all its lines go. `kept` joins the others by \\n.

    A null or empty text is one empty line. Rows of one doc_id are one document and do not clean each other;
    rows without doc_id are together one document, which comes last. Equal rows get equal results; a document
    that loses all lines keeps an empty text; an empty table gives no rows. Other columns are not read. Keys are
    compared by 128-bit hashes.
    """
    tag = F.xxhash64("text").alias("_tag")
    given = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_id"), tag, *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col("text").alias("_text"))
    gone = repeated_keys(docs.sparkSession, given.select(F.col("_id").alias("id"), F.col("_tag").alias("tag"), F.col("_text").alias("text")), least)
    joined = given.join(gone, (F.col("_id") == F.col("id")) & (F.col("_tag") == F.col("tag")), "left")
    count, names = len(keep), [*keep, "n_lines", "n_dropped", "kept"]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    rows = joined.select(*[f"_{i}" for i in range(count)], "_text", "gone")
    return rows.mapInArrow(lambda b: shortened(b, count, names, least), f"{kept}, n_lines long, n_dropped long, kept string")
