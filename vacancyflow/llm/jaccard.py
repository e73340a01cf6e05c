"""Similarity join on word n-grams: prefix filters under several global token orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancyflow.llm.components import components
from vacancyflow.llm.shared import partitions, small_batches, staged
from vacancyflow.llm.words import chunks, mixed, run_hashes, split_words, text_hashes, vocabulary, whole_runs

SHINGLE, LEAST = 5, 80  # words; percent
CELLS, BLOCK = 1 << 20, 1 << 12  # of the count sketch
BITS = 1 << 24  # of the filter of wanted texts
LEAST_BITS = 256  # of the parities of a set
NO_ID = -(1 << 63)


# Sets -------------------------------------------------------------------------
def token_sets(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts in turn, and each text's start. A to Z are lower-cased.

    With fewer words than `length`, the whole sequence is the one shingle; without words the set is empty.
    """
    values, starts = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    at, words = vocabulary(values)
    hashes = text_hashes(words)[at]
    n = np.diff(starts)
    inside = np.flatnonzero(whole_runs(starts, length))
    tokens = run_hashes(hashes, length)[inside]
    bounds = np.searchsorted(inside, starts)
    out, sizes = [], np.zeros(len(n), np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if b > a:
            own = np.sort(tokens[a:b])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n[i]:
            own = np.array([xxhash.xxh3_64_intdigest(hashes[starts[i] : starts[i + 1]].tobytes(), seed=1)], np.uint64)
        else:
            continue
        out.append(own)
        sizes[i] = len(own)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def set_names(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    return np.fromiter((xxhash.xxh3_64_intdigest(tokens[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)), np.uint64, len(starts) - 1).view(np.int64)


def parities(tokens: np.ndarray, starts: np.ndarray) -> list[bytes | None]:
    """Bits of each set: bit i tells whether an odd number of its tokens hashes to i. There are as many bits as
    tokens, rounded up to a power of two; an empty set has none.

    Two sets differ in at least as many tokens as their bits differ.
    """
    places = mixed(tokens)
    out: list[bytes | None] = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        size = max(LEAST_BITS, 1 << (b - a - 1).bit_length()) if b > a else 0
        place = (places[a:b] & np.uint64(max(size, 1) - 1)).astype(np.int64)
        out.append(np.packbits((np.bincount(place, minlength=size) & 1).astype(bool), bitorder="little").tobytes() if size else None)
    return out


def unlike(x: np.ndarray, y: np.ndarray) -> int:
    """In how many bits two parities differ; the longer ones are folded to the length of the others."""
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def hash_prefixes(tokens: np.ndarray, starts: np.ndarray, least: int) -> list[bytes | None]:
    """The prefix tokens of each set, sorted by hash, under the rising and the falling order: 16 bits of each."""
    short = (mixed(tokens) >> np.uint64(48)).astype(np.uint16)
    out: list[bytes | None] = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        p = prefix_length(b - a, least)
        out.append(short[a : a + p].tobytes() + short[b - p : b].tobytes() if b > a else None)
    return out


def share_prefixes(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets may share a prefix token under both hash orders; linked sets do."""
    a, b = x.reshape(2, -1), y.reshape(2, -1)
    return all(np.isin(a[i], b[i]).any() for i in (0, 1))


def cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(CELLS - 1)).astype(np.int64)


def sketched(batches: Iterator[pa.RecordBatch], length: int, least: int) -> Iterator[pa.RecordBatch]:
    """id, text_hash, n, node, parities and hash prefixes of every row of (id, text_hash, text), and after them the
    task's token counts by cell, in blocks."""
    counts = np.zeros(CELLS, np.int64)
    for batch in chunks(batches, 2):
        tokens, starts = token_sets(batch.column(2), length)
        counts += np.bincount(cells(tokens), minlength=CELLS)
        n = np.diff(starts)
        none = pa.nulls(len(n))
        yield pa.RecordBatch.from_pydict({"id": batch.column(0), "text_hash": batch.column(1), "n": n, "node": set_names(tokens, starts), "bits": pa.array(parities(tokens, starts), pa.binary()), "orders": pa.array(hash_prefixes(tokens, starts, least), pa.binary()), "block": none.cast(pa.int32()), "counts": none.cast(pa.binary())})
    if counts.any():
        blocks = [x.tobytes() for x in counts.reshape(-1, BLOCK)]
        none = pa.nulls(len(blocks), pa.int64())
        yield pa.RecordBatch.from_pydict({"id": none, "text_hash": none, "n": none, "node": none, "bits": pa.nulls(len(blocks), pa.binary()), "orders": pa.nulls(len(blocks), pa.binary()), "block": pa.array(range(len(blocks)), pa.int32()), "counts": pa.array(blocks, pa.binary())})


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the (block, counts) rows, block by block; a task holds the blocks that are dealt to it."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sums[block] = sums.get(block, 0) + np.frombuffer(counts.as_buffer(), np.int64)
    if sums:
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int32()), "counts": pa.array([x.tobytes() for x in sums.values()], pa.binary())})


# Candidates -------------------------------------------------------------------
def prefix_length(n: int, least: int) -> int:
    """Of a set of n, so many first tokens under any order hold one of every partner's, which shares `least` percent of n."""
    return n + (-n * least // 100) + 1


def postings(batches: Iterator[pa.RecordBatch], length: int, least: int, levels: np.ndarray) -> Iterator[pa.RecordBatch]:
    """token, node, n and place of the prefix tokens of each set of (text), rarest first; sets that a chunk repeats once."""
    for batch in chunks(batches, 0):
        tokens, starts = token_sets(batch.column(0), length)
        names = set_names(tokens, starts)
        keys = (levels[cells(tokens)].astype(np.uint64) << np.uint64(56)) | (mixed(tokens) >> np.uint64(8))
        out = []
        for i in np.unique(names, return_index=True)[1]:
            a, b = starts[i], starts[i + 1]
            if b > a:
                p = prefix_length(int(b - a), least)
                first = np.argpartition(keys[a:b], p - 1)[:p]
                first = first[np.argsort(keys[a:b][first])]
                out.append((tokens[a:b][first], np.full(p, names[i]), np.full(p, b - a), np.arange(p)))
        if out:
            token, node, n, place = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_pydict({"token": token.view(np.int64), "node": node, "n": n.astype(np.int32), "place": place.astype(np.int32)})


def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of postings sorted by token and place, each one behind the first of its token, with that first one.

    The first, which has the fewest rare tokens of its own, is the most like the others. One posting is
    carried from batch to batch, so a token of any number of postings passes through.
    """
    names = ["token", "node", "n", "place"]
    carry: list[np.ndarray] | None = None
    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(4)]
        if carry is not None:
            columns = [np.concatenate([c, x]) for c, x in zip(carry, columns, strict=True)]
        if not len(columns[0]):
            continue
        new = np.concatenate([[True], columns[0][1:] != columns[0][:-1]])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        other = columns[1] != columns[1][first]
        carry = [c[first[-1] : first[-1] + 1] for c in columns]
        rows = {name: c[other] for name, c in zip(names, columns, strict=True)}
        rows |= {f"l_{name}": c[first][other] for name, c in zip(names[1:], columns[1:], strict=True)}
        yield pa.RecordBatch.from_pydict(rows)


def reachable(n: str, place: str, m: str, other: str, least: int) -> Column:
    """Whether two sets, of n and m tokens, can be linked if the tokens at these places are their first common ones."""
    return F.expr(f"least({n} - {place}, {m} - {other}) * {100 + least}L >= {least}L * ({n} + {m})")


def alike(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The pairs of (a, b, n, m, a_bits, b_bits, a_orders, b_orders) whose parities leave room for a link of sets of n
    and m tokens, and which share a prefix token under both hash orders as well."""
    for batch in batches:
        room = (100 - least) * (batch.column(2).to_numpy() + batch.column(3).to_numpy())
        bits = ([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(i)] for i in (4, 5))
        apart = np.fromiter((unlike(x, y) for x, y in zip(*bits, strict=True)), np.int64, batch.num_rows)
        near = batch.filter(pa.array((100 + least) * apart <= room))
        orders = ([np.frombuffer(x.as_buffer(), np.uint16) for x in near.column(i)] for i in (6, 7))
        shared = [share_prefixes(x, y) for x, y in zip(*orders, strict=True)]
        yield near.select([0, 1]).filter(pa.array(shared, pa.bool_()))


# Verification -----------------------------------------------------------------
def bit_places(text_hashes: np.ndarray) -> np.ndarray:
    return (text_hashes.view(np.uint64) & np.uint64(BITS - 1)).astype(np.int64)


def bits_of(hashes: DataFrame) -> np.ndarray:
    """A filter of a fixed number of bits, set at the places of the column `text_hash`.

    It goes to the scan of the texts, so that texts need no shuffle; what it lets through besides is dropped
    by a later join.
    """
    place = F.expr(f"cast(text_hash & {BITS - 1} as int)")
    places = hashes.select(F.shiftright(place, 5).alias("word"), F.expr("shiftleft(1L, cast(text_hash & 31 as int))").alias("bit"))
    words = places.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    rows = words.toPandas()  # at most BITS / 32 rows
    packed = np.zeros(BITS // 32, np.uint32)
    packed[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    return packed


def stored_sets(batches: Iterator[pa.RecordBatch], length: int, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Name and tokens of the sets of the wanted ones of (text, text_hash), and of some others by chance."""
    bits = np.unpackbits(wanted.view(np.uint8), bitorder="little").view(bool)
    picked = (b.filter(pa.array(bits[bit_places(b.column(1).to_numpy())])) for b in batches)
    for batch in chunks(picked, 0):
        tokens, starts = token_sets(batch.column(0), length)
        sets = [tokens[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        yield pa.RecordBatch.from_pydict({"node": set_names(tokens, starts), "tokens": pa.array(sets, pa.binary())})


def verified(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, a_tokens, b_tokens) that are linked."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            a, b = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
            shared = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * shared >= least * (len(a) + len(b) - shared))
        yield pa.RecordBatch.from_pydict({"a": batch.column(0), "b": batch.column(1)}).filter(pa.array(keep, pa.bool_()))


def near_duplicates(docs: DataFrame, length: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """id, text_hash, n_shingles, label and component of every row of `docs(doc_id, text, ...)`.

    Two sets are linked when 100 * intersection >= `least` * union. `label` is the same for rows that links
    connect, `component` the smallest doc_id among them; `id` is the doc_id, NO_ID for a null one, which
    counts as no doc_id (a component of such rows only has a null name). Rows without words have an empty
    set, no label and their own doc_id as component. Rows with the same set share a label, however many;
    sets are compared once. Sets are told apart by 64-bit hashes of shingles and of sets.

    Orders: a first pass counts tokens in a sketch of fixed size, and tokens are ordered by rarity there;
    sets meet where they share a prefix token under that order and the places of that token leave room for
    enough common ones. First every set meets one other of each of its tokens; then, where a token's sets
    are not all connected, those of different components meet. The filters are intersected before any set is
    moved: candidates must also share a prefix token under the rising and under the falling order of hashes,
    and pairs whose parities differ in more bits than linked sets differ in tokens go.
    """
    spark = docs.sparkSession
    small_batches(spark)
    given = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    told = staged(given.mapInArrow(lambda b: sketched(b, length, least), "id long, text_hash long, n long, node long, bits binary, orders binary, block int, counts binary"))
    rows = told.filter("block is null").select("id", "text_hash", "n", "node")
    parts = told.filter("block is not null").select("block", "counts").repartition("block").mapInArrow(summed, "block int, counts binary")
    counts = np.zeros((CELLS // BLOCK, BLOCK), np.int64)
    for block, sums in parts.collect():  # a fixed number of cells
        counts[block] = np.frombuffer(sums, np.int64)
    levels = np.floor(2 * np.log2(np.maximum(counts.ravel(), 1))).astype(np.uint8)

    found = given.select("text").mapInArrow(lambda b: postings(b, length, least, levels), "token long, node long, n int, place int")
    found = found.repartition(partitions(spark), "token").sortWithinPartitions("token", "place", "node")
    pairs = staged(found.mapInArrow(met, "token long, node long, n int, place int, l_node long, l_n int, l_place int"))
    first = pairs.filter(reachable("n", "place", "l_n", "l_place", least)).select(F.least("node", "l_node").alias("a"), F.greatest("node", "l_node").alias("b"))

    # Rows of one node agree in all but the text.
    nodes = told.filter("block is null and n > 0").groupBy("node")
    chosen = staged(nodes.agg(*[F.min(x).alias(x) for x in ("text_hash", "n", "bits", "orders")]))

    def likely(candidates: DataFrame) -> DataFrame:
        left = chosen.select(F.col("node").alias("a"), "n", F.col("bits").alias("a_bits"), F.col("orders").alias("a_orders"))
        right = chosen.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("bits").alias("b_bits"), F.col("orders").alias("b_orders"))
        both = candidates.join(left, "a").join(right, "b").select("a", "b", "n", "m", "a_bits", "b_bits", "a_orders", "b_orders")
        return staged(both.mapInArrow(lambda x: alike(x, least), "a long, b long"))

    def linked(candidates: DataFrame) -> DataFrame:
        nodes = candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = bits_of(nodes.join(chosen.select("node", "text_hash"), "node").select("text_hash"))
        sets = given.select("text", "text_hash").mapInArrow(lambda b: stored_sets(b, length, wanted), "node long, tokens binary")
        # Sets are dealt out by node once; both joins read that shuffle.
        sets = sets.join(nodes, "node", "left_semi").dropDuplicates(["node"])
        a, b = (sets.select(F.col("node").alias(x), F.col("tokens").alias(f"{x}_tokens")) for x in ("a", "b"))
        both = candidates.join(a, "a").join(b, "b").select("a", "b", "a_tokens", "b_tokens")
        return staged(both.mapInArrow(lambda x: verified(x, least), "a long, b long"))

    tried = likely(first.distinct())
    links = linked(tried)
    named = components(links)
    seconds = pairs.select("token", "node", "n", "place")
    leaders = pairs.groupBy("token").agg(F.first(F.struct("l_node", "l_n", "l_place")).alias("l")).select("token", "l.*")
    members = seconds.union(leaders).join(named, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    members = staged(members)
    open_tokens = members.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("token")
    left = members.join(open_tokens, "token").distinct()
    right = left.toDF("token", "r_node", "r_n", "r_place", "r_label")
    across = left.join(right, (left["token"] == right["token"]) & (F.col("label") < F.col("r_label")) & reachable("n", "place", "r_n", "r_place", least))
    across = across.select(F.least("node", "r_node").alias("a"), F.greatest("node", "r_node").alias("b")).distinct()
    across = likely(across.join(tried, ["a", "b"], "left_anti"))
    links = links.union(linked(across))
    named = staged(components(links))
    labelled = rows.join(named, "node", "left").withColumn("label", F.when(F.col("n") > 0, F.coalesce("component", "node"))).drop("component")
    smallest = labelled.filter("label is not null").groupBy("label").agg(F.min(F.when(F.col("id") != NO_ID, F.col("id"))).alias("smallest"))
    own = F.when(F.col("id") != NO_ID, F.col("id"))
    joined = labelled.join(smallest, "label", "left")
    component = F.when(F.col("label").isNull(), own).otherwise(F.col("smallest")).alias("component")
    return joined.select("id", "text_hash", F.col("n").alias("n_shingles"), "label", component)
