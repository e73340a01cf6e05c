"""Periodic runs of words, found at the boundaries of a Re-Pair grammar of the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.llm.words import chunks, mixed, split_words, vocabulary

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def paired_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit name of every pair of symbols; equal pairs have equal names wherever they are."""
    return mixed(left * _LEFT + mixed(right * _RIGHT))


def occurrences(names: np.ndarray) -> np.ndarray:
    """How often each name occurs."""
    order = np.argsort(names)
    first = np.flatnonzero(np.diff(names[order], prepend=~names[order[:1]]))
    many = np.diff(first, append=len(names))
    counts = np.empty(len(names), np.int64)
    counts[order] = np.repeat(many, many)
    return counts


def most_frequent(names: np.ndarray, joined: np.ndarray) -> np.ndarray | None:
    """The pairs that one round of Re-Pair replaces, None if no pair occurs twice.

    A repeated pair goes where neither pair that shares a symbol with it is more frequent, so the replaced
    ones do not overlap; in aaaa every other pair goes. Ties go by name, which keeps the grammar shallow.
    """
    at = np.flatnonzero(joined)
    counts = occurrences(names[at])
    if not (counts > 1).any():
        return None
    rank = np.zeros(len(names) + 2, np.uint64)  # one place of rank 0 at either end
    rank[at + 1] = np.where(counts > 1, counts.astype(np.uint64) << np.uint64(40) | names[at] >> np.uint64(24), np.uint64(0))
    again = np.zeros(len(names) + 1, bool)  # the same pair as one place before
    again[1:-1] = (names[1:] == names[:-1]) & joined[1:] & joined[:-1]
    begin = np.maximum.accumulate(np.where(again[:-1], 0, np.arange(len(names))))
    own = rank[1:-1]
    chosen = (own > 0) & (again[:-1] | (own > rank[:-2])) & (again[1:] | (own >= rank[2:]))
    return chosen & ((np.arange(len(names)) - begin) % 2 == 0)


def grammar(symbols: np.ndarray, text: np.ndarray, least: int = LEAST_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Name, start, boundary and end of every occurrence of a nonterminal of at least `least` words.

    `symbols` are word names, `text` numbers the text of each. Re-Pair goes over all texts at once, in
    rounds with fresh counts, until no pair within a text occurs twice; what is left of each text is then
    paired as a balanced tree, so a text is one nonterminal in the end.
    """
    start = np.arange(len(symbols) + 1)
    found, repeats = [], True
    while True:
        joined = text[1:] == text[:-1]
        if not joined.any():
            break
        names = paired_names(symbols[:-1], symbols[1:])
        chosen = most_frequent(names, joined) if repeats else None
        if chosen is None:
            repeats = False
            first = np.maximum.accumulate(np.where(np.concatenate([[True], ~joined]), np.arange(len(text)), 0))
            chosen = joined & ((np.arange(len(text)) - first) % 2 == 0)[:-1]
        at = np.flatnonzero(chosen)
        far = at[start[at + 2] - start[at] >= least]
        found.append((names[far], start[far], start[far + 1], start[far + 2]))
        symbols = symbols.copy()
        symbols[at] = names[at]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, text, start = symbols[stay], text[stay], start[np.concatenate([stay, [True]])]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip((none.astype(np.uint64), none, none, none), *found, strict=True))


def stretched(words: np.ndarray, place: np.ndarray, period: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
    """Each place moved on (or back) to `limit` as long as the word there equals the one a period before (behind)."""
    place, width = place.copy(), 16
    alive = np.flatnonzero(place != limit)
    while len(alive):
        room = np.minimum(width, np.abs(limit[alive] - place[alive]))
        owner = np.repeat(np.arange(len(alive)), room)
        off = np.arange(len(owner)) - np.repeat(np.cumsum(room) - room, room)
        shift = period[alive][owner]
        at = place[alive][owner] + (-1 - off if back else off)
        bad = np.flatnonzero(words[at] != words[at + shift if back else at - shift])
        equal = room.copy()
        equal[owner[bad[::-1]]] = off[bad[::-1]]  # the first one is written last
        place[alive] += -equal if back else equal
        alive = alive[(equal == room) & (place[alive] != limit[alive])]
        width *= 2
    return place


def boundary_runs(words: np.ndarray, text: np.ndarray, ends: np.ndarray, nodes: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    """Node, start, end and period of the runs of exponent 4 or more inside a nonterminal across its boundary.

    `nodes` holds start, boundary and end of one occurrence of each. For periods q in (k/2, k] such a run
    has, at one of four places around the boundary, a stretch of k words that comes again exactly q words
    on (or before), with no nearer repeat, since q is the smallest period. So next and previous occurrences of
    words, pairs, fours and so on within each text tell the periods; they need only be known where the
    halves occur again. The stretch is then extended as far as the nonterminal goes.
    """
    begin, middle, end = nodes
    which = np.arange(len(begin))
    n, k, names = len(words), 1, words.copy()
    active, found = np.arange(n), []
    while True:
        keep = (end - begin)[which] >= max(LEAST_LENGTH, 2 * k + 1)
        which = which[keep]
        if not len(which) or not len(active):
            break
        order = active[np.argsort(names[active], kind="stable")]
        left, right = order[:-1], order[1:]
        same = (names[left] == names[right]) & (text[left] == text[right])
        left, right = left[same], right[same]
        ahead, before = np.zeros(n, np.int64), np.zeros(n, np.int64)
        ahead[left], before[right] = right - left, right - left
        low, mid, high = begin[which], middle[which], end[which]
        for back, distance, shift in ((False, ahead, 0), (False, ahead, k // 2), (True, before, k), (True, before, k // 2)):
            place = mid - shift
            some = np.flatnonzero((place >= low) & (place + k <= high))
            q = distance[place[some]]
            first, last = (place[some] - q, place[some] + k) if back else (place[some], place[some] + q + k)
            good = (2 * q > k) & (q <= k) & (first >= low[some]) & (last <= high[some])
            some, q, first, last = some[good], q[good], first[good], last[good]
            first, last = stretched(words, first, q, low[some], True), stretched(words, last, q, high[some], False)
            long = last - first >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * q)
            found.append((which[some][long], first[long], last[long], q[long]))
        again = np.zeros(n + k, bool)
        again[left] = again[right] = True
        active = np.flatnonzero(again[:n] & again[k:])
        active = active[active + 2 * k <= ends[active]]
        names[active], k = paired_names(names[active], names[active + k]), 2 * k
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
    return list(np.unique(np.stack(columns), axis=1))


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals, by start and period: those of one period that share at least a period are one."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    base = period * (n + 1)
    reach = np.maximum.accumulate(end + base)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] + base[1:] > reach[:-1] - period[1:]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1 if len(first) else first
    start, end, period = start[first], reach[last] - base[last], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def periodic_runs(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs in texts of word names; `starts` are the texts' starts and the end of all."""
    sizes = np.diff(starts)
    text = np.repeat(np.arange(len(sizes)), sizes)
    names, begin, middle, end = grammar(words, text)
    order = np.argsort(names, kind="stable")
    names, begin, middle, end = names[order], begin[order], middle[order], end[order]
    first = np.flatnonzero(np.diff(names, prepend=~names[:1])) if len(names) else np.zeros(0, np.int64)
    many = np.diff(first, append=len(names))
    node, low, high, period = boundary_runs(words, text, starts[1:][text], (begin[first], middle[first], end[first]))
    # From the one occurrence looked at to all of them.
    times = many[node]
    owner = np.repeat(np.arange(len(node)), times)
    place = begin[first[node][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)]
    offset = low - begin[first[node]]
    start = place + offset[owner]
    return merged(start, start + (high - low)[owner], period[owner], len(words))


def collapsed(batches: Iterator[pa.RecordBatch], count: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """n_words, runs and the collapsed text of (kept columns, text)."""
    for batch in chunks(batches, count):
        values, starts = split_words(batch.column(count))
        at, _ = vocabulary(values)
        start, end, period = periodic_runs(mixed(at.astype(np.uint64) + np.uint64(1)), starts)
        owner = np.searchsorted(starts, start, side="right") - 1
        change = np.zeros(len(values) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, end, -1)
        keep = np.cumsum(change)[:-1] == 0
        before = np.concatenate([[0], np.cumsum(keep)])[starts]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), values.filter(pa.array(keep))), " ")
        rows = pa.StructArray.from_arrays([pa.array(start - starts[owner]), pa.array(end - start), pa.array(period)], ["start", "length", "period"])
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        runs = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), rows)
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(count)], pa.array(np.diff(starts)), runs, texts.cast(pa.string())], names)


def without_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of every row of `docs(text, ...)`, then n_words, runs and collapsed.

    A run is a stretch of consecutive words with smallest period q, its length at least 6 and 4 * q, that no
    neighbouring word extends keeping the period. `runs` lists (start, length, period) by start, then
    period, words numbered from 0. `collapsed` joins by one space the words that no run contains after its
    first q words. Words are runs of bytes other than space and \\t to \\r, told apart exactly.

    Texts are worked on in batches, and equal parts of the texts of a batch are looked at once; a text never
    depends on others. The memory a task needs follows its longest text. Null and empty texts have no words,
    no runs and an empty collapsed text; repeated rows each give a row; an empty table gives none. Other
    columns are not read.
    """
    count, names = len(keep), [*keep, "n_words", "runs", "collapsed"]
    given = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col("text").alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    schema = f"{kept}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return given.mapInArrow(lambda b: collapsed(b, count, names), schema)
