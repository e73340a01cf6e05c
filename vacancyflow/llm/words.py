"""Word arrays of Arrow text columns, and hashes over them."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 3 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on, and their memory would only grow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have about `most` bytes; a longer text is a slice of its own.

    What the worker's task before has left is returned first.
    """
    gc.collect()
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(size, dtype=np.int64) - size) // most
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, stop - start)
            give_back()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, runs of bytes other than space and \\t to \\r, in one array, and each text's start (one more at the end)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    full = np.asarray(pc.binary_length(values)) > 0
    before = np.concatenate([[0], np.cumsum(full)])
    return values.filter(pa.array(full)), before[offsets - offsets[0]]


def vocabulary(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's number, and the words by number."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def text_hashes(texts: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(x.encode()) for x in texts.to_pylist()), np.uint64, len(texts))


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit hashes spread evenly."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every `length` consecutive word hashes; the last length - 1 places are left out."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(length):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mixed(h)


def whole_runs(starts: np.ndarray, length: int) -> np.ndarray:
    """Of the places 0 .. n - length, those whose `length` words lie in one text."""
    n = int(starts[-1]) - length + 1
    inside = np.ones(max(n, 0), bool)
    for i in range(1, length):
        at = starts[1:-1] - i
        inside[at[(at >= 0) & (at < n)]] = False
    return inside
