"""Hard negatives by a secondary sort: pair scores sorted inside each anchor and read as a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancyflow.llm.shared import partitions, shared_folder, staged

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
CANDIDATE_ROWS, ANCHOR_ROWS, PASS_BLOCKS = 2048, 1024, 8
# The order of the bytes of a key is the order wanted: scores are stored complemented, ids shifted to unsigned.
KEY = np.dtype([("anchor", ">u8"), ("row", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
SIGN = np.uint64(1 << 63)
NONE = np.iinfo(np.int64).min
ENTRY = "anchor long, key binary"
BLOCK = "dim int, ids binary, labels binary, matrix binary, top double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and the integer vector of rows that have them all, with finite components; equal rows once."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"))
    return rows.groupBy("vec_id", "label", "v").agg(F.max(F.lit(1))).select("vec_id", "label", "v")


def packed(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of at most `rows` vectors of one length, their numbers as bytes."""
    held: dict[int, list] = {}

    def block(dim: int) -> pa.RecordBatch:
        ids, labels, values = zip(*held.pop(dim), strict=True)
        matrix = np.array(values, dtype=np.int64).reshape(len(ids), dim)
        top = float(np.abs(matrix.astype(np.float64)).max()) if matrix.size else 0.0
        as_bytes = [np.array(x, dtype=np.int64).tobytes() for x in (ids, labels, matrix)]
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *[pa.array([x], pa.binary()) for x in as_bytes], pa.array([top])], ["dim", "ids", "labels", "matrix", "top"])

    for batch in batches:
        for vec_id, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            values = v.values.to_numpy(zero_copy_only=False)
            held.setdefault(len(values), []).append((vec_id, label, values))
            if len(held[len(values)]) >= rows:
                yield block(len(values))
    for dim in list(held):
        yield block(dim)


def scored(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor ids, candidate ids, whether the labels are equal, and the scores (anchor x candidate) of two blocks."""
    dim = row["dim"]
    ids, labels, anchors, own = (np.frombuffer(row[n], np.int64) for n in ("ids", "labels", "a_ids", "a_labels"))
    c = np.frombuffer(row["matrix"], np.int64).reshape(len(ids), dim)
    a = np.frombuffer(row["a_matrix"], np.int64).reshape(len(anchors), dim)
    reach = row["top"] * row["a_top"] * max(dim, 1)
    if 100 * reach >= 2.0**63:
        raise ValueError(f"inner products of up to {reach:g} can't be compared in 64 bits")
    exact = reach < 2.0**53  # then floating sums are exact integers
    s = (a.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64) if exact else a @ c.T
    return anchors, ids, own[:, None] == labels[None, :], s


def first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k entries of each group with the highest scores, ties by smaller id."""
    order = np.lexsort((ids, -score, group))
    begin = np.flatnonzero(np.diff(group[order], prepend=-1))
    size = np.diff(begin, append=len(order))
    return order[np.arange(len(order)) - np.repeat(begin, size) < k]


def best(score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's first k allowed candidates."""
    masked = np.where(allowed, score, NONE)
    if masked.shape[1] > k:
        least = np.partition(masked, masked.shape[1] - k, axis=1)[:, -k, None]
        allowed = allowed & (masked >= least)
    row, column = np.nonzero(allowed)
    take = first(row, score[row, column], ids[column], k)
    return row[take], column[take]


def keys(anchor: np.ndarray, row: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> pa.RecordBatch:
    out = np.empty(len(anchor), KEY)
    out["anchor"], out["row"], out["kind"] = anchor.astype(np.uint64) ^ SIGN, row.astype(np.uint64) ^ SIGN, kind
    out["score"], out["id"] = ~(score.astype(np.uint64) ^ SIGN), ids.astype(np.uint64) ^ SIGN
    blob = pa.Array.from_buffers(pa.binary(KEY.itemsize), len(out), [None, pa.py_buffer(out.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), blob.cast(pa.binary())], ["anchor", "key"])


def entries(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int, int]]:
    """(anchor, row, score, kind, id) of the keys of a batch."""
    blob = b"".join(batch.column(1).to_pylist())
    found = np.frombuffer(blob, KEY)
    numbers = lambda name: (found[name].astype(np.uint64) ^ SIGN).view(np.int64).tolist()
    score = (~found["score"].astype(np.uint64) ^ SIGN).view(np.int64).tolist()
    return zip(numbers("anchor"), numbers("row"), score, found["kind"].tolist(), numbers("id"), strict=True)


def combined(batches: Iterator[pa.RecordBatch], k: int, kind: int, candidates: Callable) -> Iterator[pa.RecordBatch]:
    """Keys of the task's first k candidates of every group of every anchor; `candidates` gives those of two blocks."""
    held: dict[int, tuple[np.ndarray, ...]] = {}
    anchors: dict[int, np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            grp = row["grp"]
            anchors[grp], *new = candidates(row)
            if grp in held:
                new = [np.concatenate(x) for x in zip(held[grp], new, strict=True)]
            take = first(new[0], new[1], new[2], k)
            held[grp] = tuple(x[take] for x in new)
    for grp, (group, score, ids, at) in held.items():
        # One entry is enough where several groups of an anchor want it.
        one = np.unique(np.stack([at, score, ids]), axis=1) if len(group) else np.zeros((3, 0), np.int64)
        yield keys(anchors[grp][one[0]], grp * ANCHOR_ROWS + one[0], one[1], kind, one[2])


def same_label(row: dict) -> tuple[np.ndarray, ...]:
    anchors, ids, same, s = scored(row)
    at, column = best(s, same & (anchors[:, None] != ids[None, :]), ids, POSITIVES)
    return anchors, at, s[at, column], ids[column], at


def inside_windows(row: dict) -> tuple[np.ndarray, ...]:
    """Candidates of another label that are first in the window of a positive; a group is an anchor's positive."""
    anchors, ids, same, s = scored(row)
    whose, which, bound = (np.array(row[n], dtype=np.int64) for n in ("at", "rank", "score"))
    out = [(np.zeros(0, np.int64),) * 4]
    for j in range(POSITIVES):
        rows, p = whose[which == j], bound[which == j][:, None]
        mine = s[rows]
        allowed = ~same[rows] & (100 * mine <= HIGH * p) & (100 * mine >= LOW * p)
        at, column = best(mine, allowed, ids, NEGATIVES)
        out.append((rows[at] * POSITIVES + j, mine[at, column], ids[column], rows[at]))
    return anchors, *[np.concatenate(x) for x in zip(*out, strict=True)]


def first_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """grp, at, rank, positive and score of the first entries of every anchor in a sorted stream."""
    now, rank = None, 0
    for batch in batches:
        out = []
        for anchor, row, score, _, found in entries(batch):
            now, rank = ((anchor, row), 0) if (anchor, row) != now else (now, rank + 1)
            if rank < POSITIVES:
                out.append((row // ANCHOR_ROWS, row % ANCHOR_ROWS, rank, anchor, found, score))
        yield pa.RecordBatch.from_pylist([dict(zip(("grp", "at", "rank", "anchor", "id", "score"), x, strict=True)) for x in out], POSITIVE_FIELDS)


POSITIVE = "grp long, at long, rank long, anchor long, id long, score long"
POSITIVE_FIELDS = pa.schema([(n.split()[0], pa.int64()) for n in POSITIVE.split(", ")])
TRIPLET = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
TRIPLET_FIELDS = pa.schema([(n.split()[0], pa.int32() if n.endswith("int") else pa.int64()) for n in TRIPLET.split(", ")])


def positive_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grp, at, _, anchor, found, score = (c.to_numpy() for c in batch.columns)
        yield keys(anchor, grp * ANCHOR_ROWS + at, score, 0, found)


def windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The triplets of a stream sorted by anchor and falling score: a positive opens a window, a negative is
    told to every open window that reaches it, and a window closes when it is full or the scores are below it."""
    now, open_windows = None, []
    for batch in batches:
        out = []
        for anchor, row, score, kind, found in entries(batch):
            if (anchor, row) != now:
                now, open_windows = (anchor, row), []
            if kind == 0:
                open_windows.append([found, score, 0])
                continue
            open_windows = [w for w in open_windows if w[2] < NEGATIVES and 100 * score >= LOW * w[1]]
            for w in open_windows:
                if 100 * score <= HIGH * w[1]:
                    w[2] += 1
                    out.append((anchor, w[0], w[2], found, w[1], score))
        yield pa.RecordBatch.from_pylist([dict(zip(TRIPLET_FIELDS.names, x, strict=True)) for x in out], TRIPLET_FIELDS)


def sorted_stream(rows: DataFrame, read: Callable, schema: str) -> DataFrame:
    """The secondary sort: an anchor's keys meet in one partition, which is sorted by key and read once."""
    parts = partitions(rows.sparkSession)
    return rows.repartition(parts, "anchor").sortWithinPartitions("key").mapInArrow(read, schema)


def hard_negatives(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for the anchor rows of
    `vectors(vec_id, embedding, label, ...)`.

    Components become floor(256 * x); a score is the integer inner product, higher ones first, ties by
    smaller vec_id. An anchor's positives are its first 5 rows of the same label and another vec_id; for each
    of them come the first 3 rows of another label that score from 50 to 95 percent of it. A positive of
    negative score has none. Fewer rows give fewer results; a positive without negatives gives no row.

    Rows without vec_id or label, with a null vector or a null or non-finite component take no part; vectors
    of different lengths do not meet, empty ones all score 0; equal rows count once; rows of one vec_id with
    different vectors or labels each count, as anchors as well. Scores beyond 2^63 / 100 end the run with an error.
    Other columns are not read, but for those that `is_anchor` names.

    Candidates lie in blocks that never move. Per pass a bounded number of anchors (8 blocks of 1024) goes to
    all of them, so memory and broadcasts stay fixed and passes grow with the anchors. A task keeps each
    anchor's first 5, then each window's first 3, over all its blocks; only these are shuffled, as keys packed
    from anchor, falling score and id, and an anchor's sorted keys are read as a stream. Packing stands for a
    pair partitioner: repartition and sortWithinPartitions are the table form of repartitionAndSortWithinPartitions,
    sorted and spilled by the JVM.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    candidates = staged(rows.mapInArrow(lambda b: packed(b, CANDIDATE_ROWS), BLOCK))
    chosen = usable(vectors.filter(is_anchor)).mapInArrow(lambda b: packed(b, ANCHOR_ROWS), BLOCK)
    anchors = staged(chosen.withColumn("grp", F.monotonically_increasing_id()))
    told = anchors.select("grp", "dim", *[F.col(n).alias(f"a_{n}") for n in ("ids", "labels", "matrix", "top")])
    # One number for each 1024 anchors.
    groups = sorted(row.grp for row in anchors.select("grp").collect())
    passes = [(groups[i], groups[i : i + PASS_BLOCKS][-1]) for i in range(0, len(groups), PASS_BLOCKS)]

    def pairs(side: DataFrame, k: int, kind: int, read: Callable) -> DataFrame:
        folder = shared_folder(spark)
        spark.createDataFrame([], ENTRY).write.parquet(folder)
        for low, high in passes:
            some = side.filter(F.col("grp").between(low, high))
            met = candidates.join(F.broadcast(some), "dim")  # at most PASS_BLOCKS rows
            met.mapInArrow(lambda b: combined(b, k, kind, read), ENTRY).write.mode("append").parquet(folder)
        return spark.read.schema(ENTRY).parquet(folder)

    found = sorted_stream(pairs(told, POSITIVES, 0, same_label), first_positives, POSITIVE)
    positives = staged(found)
    # At most 5 positives for each of the 1024 anchors of a block.
    windows = positives.groupBy("grp").agg(*[F.collect_list(n).alias(n) for n in ("at", "rank", "score")])
    bounded = staged(told.join(windows, "grp"))
    wanted = pairs(bounded, NEGATIVES, 1, inside_windows)
    opened = positives.mapInArrow(positive_keys, ENTRY)
    return sorted_stream(wanted.union(opened), windowed, TRIPLET)
