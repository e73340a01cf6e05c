"""Removal of repeated passages: windows of words, dealt out by minimiser as packed super-k-mers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.llm.shared import partitions, small_batches
from vacancyflow.llm.words import chunks, give_back, mixed, run_hashes, split_words, text_hashes, vocabulary, whole_runs

WINDOW, SEED = 13, 3  # words in a window and in a minimiser
CHUNK_BYTES = 6 << 20  # a passage leaves each chunk once
NO_ID = -(1 << 63)
RUNS, PACKED = 0, 1
CLEANED = "n_words long, n_removed long, kept string"
CLEANED_TYPE = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
KINDS = (np.int64, np.int32, np.int32, np.int32)  # id, tag, start, and end or number of windows


def packed(columns: list[np.ndarray], text: str = "") -> bytes:
    """Columns of one length and a text, compressed."""
    head = np.array([len(columns[0])], np.int64).tobytes()
    body = b"".join(c.astype(k).tobytes() for c, k in zip(columns, KINDS, strict=True))
    return zstandard.compress(head + body + text.encode(), 3)


def unpacked(blob: bytes) -> tuple[list[np.ndarray], str]:
    data = zstandard.decompress(blob)
    n, at, columns = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for kind in KINDS:
        columns.append(np.frombuffer(data, kind, n, at))
        at += columns[-1].nbytes
    return columns, data[at:].decode()


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values."""
    out, have = values, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, .. of each of the ranges in turn."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def repeats(words: np.ndarray, at: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows at the places `at` of the word numbers occur under a smaller id.

    Windows are sorted by a hash of their word numbers; then each is compared word by word with the first
    of its hash, and if any differs, windows are sorted by the words themselves.
    """
    if not len(at):
        return np.zeros(0, bool)
    hashes = run_hashes(mixed(words.astype(np.uint64) + np.uint64(1)), length)[at]
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    again = np.flatnonzero(~new)
    here, head = at[order[again]], at[order[starts[group[again]]]]
    if any((words[here + i] != words[head + i]).any() for i in range(length)):
        rows = np.stack([words[at + i] for i in range(length)], axis=1)
        back = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(back, kind="stable")
        new = np.concatenate([[True], back[order][1:] != back[order][:-1]])
        group, starts = np.cumsum(new) - 1, np.flatnonzero(new)
    smallest = np.minimum.reduceat(ids[order], starts)
    out = np.empty(len(at), bool)
    out[order] = ids[order] > smallest[group]
    return out


def true_runs(flags: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true flags; a run does not go on across a place in `breaks`."""
    before = np.concatenate([[False], flags[:-1]])
    before[breaks[breaks < len(flags)]] = False
    after = np.concatenate([flags[1:], [False]])
    ends = breaks[(breaks > 0) & (breaks <= len(flags))] - 1
    after[ends] = False
    return np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after)


def dealt(batches: Iterator[pa.RecordBatch], buckets: int, length: int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Super-k-mers of (id, tag, text), packed by bucket, and the runs of windows that repeat inside the chunk.

    A window that a smaller id has in the same chunk is known to repeat and stays here, so a passage that
    many documents share leaves each chunk once. The others travel: consecutive ones that share a
    minimiser as one string of words.
    """
    for batch in chunks(batches, 2, most):
        # A frame of its own: nothing of a chunk is held while the next is packed.
        yield from dealt_chunk(batch, buckets, length)


def dealt_chunk(batch: pa.RecordBatch, buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    batch = batch.filter(pc.not_equal(batch.column(0), NO_ID))
    values, starts = split_words(batch.column(2))
    if len(values) < length:
        return
    at, words = vocabulary(values)
    ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    owner = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(starts))
    inside = whole_runs(starts, length)
    places = np.flatnonzero(inside).astype(np.int32)
    if not len(places):
        return
    known = np.zeros(len(inside), bool)
    known[places] = repeats(at, places, ids[owner[places]], length)
    del places
    first, last = true_runs(known, starts)
    if len(first):
        o = owner[first]
        blob = packed([ids[o], tags[o], first - starts[o], last + length - starts[o]])
        yield pa.RecordBatch.from_pydict({"bucket": pa.array([int(mixed(ids[:1].astype(np.uint64))[0] % np.uint64(buckets))], pa.int32()), "kind": pa.array([RUNS], pa.int32()), "blob": pa.array([blob], pa.binary())})
    key = sliding_least(run_hashes(text_hashes(words)[at], SEED), length - SEED + 1)
    send = inside & ~known
    change = np.flatnonzero(key[1:] != key[:-1]) + 1
    first, last = true_runs(send, np.union1d(change, starts))
    if not len(first):
        return
    to = (mixed(key[first]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    first, last, to = first[order], last[order], to[order]
    windows = last - first + 1
    taken = values.take(pa.array(ranges(first, windows + length - 1)))
    edges = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
    sizes = np.add.reduceat(windows + length - 1, edges)
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), taken), " ")
    o = owner[first]
    columns = [ids[o], tags[o], first - starts[o], windows]
    blobs = [packed([c[a:b] for c in columns], text.as_py()) for a, b, text in zip(edges, [*edges[1:], len(to)], texts, strict=True)]
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(to[edges], pa.int32()), "kind": pa.array(np.full(len(blobs), PACKED), pa.int32()), "blob": pa.array(blobs, pa.binary())})


def found_runs(columns: list[np.ndarray], texts: list[str], length: int) -> list[np.ndarray]:
    """id, tag, start and end of the runs of repeated windows in the super-k-mers of one bucket."""
    ids, tags, begin, windows = columns
    words = vocabulary(split_words(pa.array(texts, pa.large_string()))[0])[0]
    sizes = windows.astype(np.int64) + length - 1
    places = ranges(np.cumsum(sizes) - sizes, windows.astype(np.int64))
    flags = repeats(words, places, np.repeat(ids, windows), length)
    edges = np.cumsum(windows) - windows
    first, last = true_runs(flags, edges)
    of = np.searchsorted(edges, first, side="right") - 1
    start = begin[of] + (first - edges[of])
    return [ids[of], tags[of], start, start + (last - first) + length]


def matched(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """id, tag, start and end of repeated runs from (bucket, kind, blob) rows sorted by bucket, one bucket at a time."""

    def rows(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, KINDS, strict=True)], ["id", "tag", "start", "end"])

    def close() -> pa.RecordBatch:
        return rows(found_runs([np.concatenate(c) for c in zip(*[h[0] for h in held], strict=True)], [h[1] for h in held], length))

    held, now = [], None
    for batch in batches:
        for bucket, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            columns, text = unpacked(blob.as_buffer())
            if kind == RUNS:
                yield rows(columns)
                continue
            if bucket != now and held:
                yield close()
                held = []
                give_back()
            now = bucket
            held.append((columns, text))
    if held:
        yield close()
        held = []
    # The worker goes on to other tasks, and idles through stages without Python.
    give_back()


def cleaned(batches: Iterator[tuple[pa.Array, pa.Array]], changed: bool) -> Iterator[pa.Array]:
    """n_words, n_removed and the kept words of (text, runs); with `changed`, null where no word goes."""
    for texts, lists in batches:
        parts = []
        for batch in chunks(iter([pa.RecordBatch.from_arrays([texts, lists], ["text", "runs"])]), 0):
            values, starts = split_words(batch.column(0))
            runs = batch.column(1)
            n = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False)
            flat = runs.flatten()
            base = np.repeat(starts[:-1], n)
            change = np.zeros(len(values) + 1, np.int64)
            np.add.at(change, base + flat.field(0).to_numpy(), 1)
            np.add.at(change, base + flat.field(1).to_numpy(), -1)
            keep = np.cumsum(change)[:-1] == 0
            words = np.diff(starts)
            if changed:
                # Texts that lose nothing need not be joined.
                keep &= np.repeat(n > 0, words)
            before = np.concatenate([[0], np.cumsum(keep)])[starts]
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), values.filter(pa.array(keep))), " ").cast(pa.string())
            kept = np.where(n > 0, np.diff(before), words)
            if changed:
                joined = pc.if_else(pa.array(kept < words), joined, pa.scalar(None, pa.string()))
            parts.append(pa.StructArray.from_arrays([pa.array(words), pa.array(words - kept), joined], CLEANED_TYPE.names))
        yield pa.concat_arrays(parts) if parts else pa.array([], CLEANED_TYPE)


def repeated_runs(docs: DataFrame, length: int = WINDOW, buckets: int | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """id, tag, start and end (word places) of runs of repeated windows in `docs(id, tag, text)`."""
    small_batches(docs.sparkSession)
    parts = partitions(docs.sparkSession)
    many = buckets or 4 * parts
    sent = docs.mapInArrow(lambda b: dealt(b, many, length, chunk_bytes), "bucket int, kind int, blob binary")
    sent = sent.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return sent.mapInArrow(lambda b: matched(b, length), "id long, tag int, start int, end int")


def without_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), length: int = WINDOW, buckets: int | None = None, changed: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The columns `keep` of every row of `docs(doc_id, text, ...)`, then n_words, n_removed and kept.

    A window is `length` consecutive words of one document. A word goes if a window that covers it has the
    words of a window of a document with a smaller doc_id; windows are judged on the input. `kept` holds
    the words that stay, joined by one space. Null and empty texts have no words; rows without doc_id are
    neither smaller nor larger than others and stay whole, and rows of the same doc_id do not clean each
    other. A repeat inside one document stays. Copies of a text all go but for those of the smallest doc_id.
    Tasks pack `chunk_bytes` of texts at a time: more send shared passages fewer times, fewer take less memory.
    With `changed`, `kept` is null where no word goes. Only texts go to Python; the columns `keep` stay.
    """
    hashed = F.xxhash64("text")
    tag = hashed.bitwiseAND(0x7FFFFFFF).cast("int").alias("tag")
    given = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("_id"), tag.alias("_tag"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], *([] if "text" in keep else [F.col("text").alias("_text")]))
    whole = F.col(f"_{keep.index('text')}" if "text" in keep else "_text")  # a text travels once
    runs = repeated_runs(given.select(F.col("_id").alias("id"), F.col("_tag").alias("tag"), whole.alias("text")), length, buckets, chunk_bytes)
    # At most a document's own number of words.
    runs = runs.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    joined = given.join(runs, (F.col("_id") == F.col("id")) & (F.col("_tag") == F.col("tag")), "left")

    def clean(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return cleaned(batches, changed)

    found = F.arrow_udf(clean, CLEANED)(whole, F.col("runs"))
    rows = joined.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], found.alias("_clean"))
    return rows.select(*keep, "_clean.*")
