"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancyflow.llm.shared import partitions, staged

SCALE, BINS, BLOCK_ROWS = 1024, 4096, 4096


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and the integer vector of rows with a vec_id and finite components only; repeated rows once."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).filter(finite)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return kept.select("vec_id", whole.alias("v")).groupBy("vec_id", "v").agg(F.max(F.lit(1))).select("vec_id", "v")


def packed(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of at most `rows` vectors of one length: dim, ids and values as int64 bytes, largest absolute value."""
    held: dict[int, list] = {}

    def block(dim: int) -> pa.RecordBatch:
        ids, values = zip(*held.pop(dim), strict=True)
        matrix = np.array(values, dtype=np.int64).reshape(len(ids), dim)
        # A block's number only deals it out; it need not be the same in another run.
        number = int(ids[0]) & 0x7FFFFFFF
        top = int(np.abs(matrix).max()) if matrix.size else 0
        return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "block": pa.array([number], pa.int64()), "ids": [np.array(ids, dtype=np.int64).tobytes()], "matrix": [matrix.tobytes()], "top": pa.array([top], pa.int64())})

    for batch in batches:
        for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = v.values.to_numpy(zero_copy_only=False)
            held.setdefault(len(values), []).append((vec_id, values))
            if len(held[len(values)]) >= rows:
                yield block(len(values))
    for dim in list(held):
        yield block(dim)


def scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate ids, query ids and the integer inner products (query x candidate) of a joined pair of blocks."""
    dim = row["dim"]
    ids, queries = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
    c = np.frombuffer(row["matrix"], np.int64).reshape(len(ids), dim)
    q = np.frombuffer(row["q_matrix"], np.int64).reshape(len(queries), dim)
    if row["top"] * row["q_top"] * max(dim, 1) < 1 << 53:  # then floating sums are exact integers
        return ids, queries, (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return ids, queries, q @ c.T


def bin_width(width: int) -> int:
    return max(1, -(-int(width) // BINS))


def histograms(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Per query of a pair of blocks, counts of scores by bin of the query's present range: from the top bin
    down to the block's own k-th score, since the k-th score of all candidates can't lie lower."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, queries, s = scores(row)
            low, width = (np.frombuffer(row[n], np.int64) for n in ("low", "width"))
            out = []
            for i, query in enumerate(queries):
                b = s[i][(s[i] >= low[i]) & (ids != query)] - low[i]
                b = b[b < width[i]] // bin_width(width[i])
                if len(b) > k:
                    b = b[b >= np.partition(b, len(b) - k)[len(b) - k]]
                bins, counts = np.unique(b, return_counts=True)
                out.append((np.full(len(bins), i), bins, counts))
            at, bins, counts = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_pydict({"grp": pa.array(np.full(len(at), row["grp"]), pa.int64()), "dim": pa.array(np.full(len(at), row["dim"]), pa.int32()), "at": pa.array(at, pa.int32()), "bin": pa.array(bins, pa.int64()), "n": pa.array(counts, pa.int64())})


def selected(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Candidates above each query's k-th score, and of those at it the smallest vec_ids that may be needed."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, queries, s = scores(row)
            low = np.frombuffer(row["low"], np.int64)
            out = []
            for i, query in enumerate(queries):
                other = ids != query
                ties = np.flatnonzero((s[i] == low[i]) & other)
                ties = ties[np.argsort(ids[ties], kind="stable")][:k]
                take = np.concatenate([np.flatnonzero((s[i] > low[i]) & other), ties])
                out.append((np.full(len(take), i), np.full(len(take), query), ids[take], s[i][take]))
            at, query_id, vec_id, score = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_pydict({"grp": pa.array(np.full(len(at), row["grp"]), pa.int64()), "dim": pa.array(np.full(len(at), row["dim"]), pa.int32()), "at": pa.array(at, pa.int32()), "query_id": query_id, "vec_id": vec_id, "score": score})


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every query row of `vectors(vec_id, embedding, ...)`.

    Components become floor(1024 * x); the score is the integer inner product. Every row but those with the
    query's vec_id is a candidate; ties go to the smaller vec_id. Fewer candidates give fewer rows. Rows
    without vec_id, with a null or empty vector or a null or non-finite component take no part; vectors of different
    lengths do not meet; equal rows count once; rows of one vec_id with different vectors each count.

    Queries and candidates are packed in blocks, and every pair of blocks is scored. Each query has a range
    of scores that holds its k-th value; per pass the scores in it are counted in equal bins, the counts are
    added up over all blocks, and the range shrinks to the bin of the k-th value, until it is that value.
    One more pass keeps what lies above and the ties that may be needed, at most k per block and query.
    """
    spark = vectors.sparkSession
    rows = staged(usable(vectors))
    blocks = "dim int, block long, ids binary, matrix binary, top long"
    pack = lambda batches: packed(batches, BLOCK_ROWS)
    candidates = staged(rows.mapInArrow(pack, blocks))
    chosen = rows.filter(is_query)
    groups = max(1, math.ceil(chosen.count() / BLOCK_ROWS))
    dealt = chosen.repartition(groups, "vec_id").mapInArrow(pack, blocks)
    queries = staged(dealt.withColumn("grp", F.monotonically_increasing_id()))
    # Every group of queries meets every block; salts spread the blocks of one group over the tasks.
    salts = max(1, math.ceil(candidates.count() / 4))
    spread = candidates.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)))
    group_ids = [row.grp for row in queries.select("grp").collect()]  # a number for each 4096 queries
    spread = spread.withColumn("grp", F.explode(F.array(*[F.lit(g) for g in group_ids]))) if group_ids else spread.withColumn("grp", F.lit(0).cast("long")).limit(0)
    reach = candidates.agg(F.max("top")).first()[0] or 0

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = np.frombuffer(row["matrix"], np.int64).reshape(-1, row["dim"])
                bound = np.abs(matrix).sum(axis=1) * reach
                n = len(bound)
                yield pa.RecordBatch.from_pydict({"grp": pa.array(np.full(n, row["grp"]), pa.int64()), "dim": pa.array(np.full(n, row["dim"]), pa.int32()), "at": pa.array(np.arange(n), pa.int32()), "low": -bound, "width": 2 * bound + 1, "need": pa.array(np.full(n, k), pa.int64())})

    state = staged(queries.mapInArrow(begun, "grp long, dim int, at int, low long, width long, need long"))

    def paired(state: DataFrame) -> DataFrame:
        """Pairs of blocks with the present ranges of the queries, in the order of the block."""
        binary = lambda name: F.sort_array(F.collect_list(F.struct("at", name))).getField(name).alias(name)
        ranges = state.groupBy("grp", "dim").agg(binary("low"), binary("width"))

        def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                low, width = ([x.values.to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for x in batch.column(i)] for i in (2, 3))
                yield pa.RecordBatch.from_pydict({"grp": batch.column(0), "dim": batch.column(1), "low": pa.array(low, pa.binary()), "width": pa.array(width, pa.binary())})

        ranges = ranges.mapInArrow(as_bytes, "grp long, dim int, low binary, width binary")
        told = queries.select("grp", "dim", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), F.col("top").alias("q_top"))
        told = told.join(ranges, ["grp", "dim"]).withColumn("salt", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")))
        return spread.repartition(max(partitions(spark), 1), "grp", "dim", "salt").join(told, ["grp", "dim", "salt"])

    while state.filter("width > 1").limit(1).count():
        one = Window.partitionBy("grp", "dim", "at").orderBy(F.col("bin").desc())
        counted = paired(state).mapInArrow(lambda b: histograms(b, k), "grp long, dim int, at int, bin long, n long")
        counted = counted.groupBy("grp", "dim", "at", "bin").agg(F.sum("n").alias("n")).withColumn("above", F.sum("n").over(one) - F.col("n"))
        joined = state.join(counted, ["grp", "dim", "at"]).filter("above < need and above + n >= need")
        step = F.expr(f"greatest(1, (width + {BINS} - 1) div {BINS})")
        narrowed = joined.select("grp", "dim", "at", (F.col("low") + F.col("bin") * step).alias("low"), step.alias("width"), (F.col("need") - F.col("above")).alias("need"))
        # A query with fewer than k candidates keeps the lower end of its range: it takes them all.
        fewer = state.join(joined.select("grp", "dim", "at"), ["grp", "dim", "at"], "left_anti").withColumn("width", F.lit(1).cast("long"))
        state = staged(narrowed.unionByName(fewer))
    best = paired(state).mapInArrow(lambda b: selected(b, k), "grp long, dim int, at int, query_id long, vec_id long, score long")
    order = Window.partitionBy("grp", "dim", "at").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
