"""Periodic runs, hard negatives and line deduplication against brute force on small tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacancyflow.llm import lines, negatives, periodic
from vacancyflow.llm.queries import QUERIES
from vacancyflow.llm.words import mixed

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, ids int, runs string, n_lines string, _0 int"


def documents(spark, rows):
    """Rows of (doc_id, text) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*row, "en", "s", 1, "k", 7, "r", "n", 3) for row in rows], SCHEMA)


# Periodic runs ----------------------------------------------------------------
def brute_runs(w):
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)  # the smallest period comes first
            i += 1
    return sorted((start, end - start, q) for (start, end), q in found.items())


def brute_collapse(w, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_of_random_texts_from_few_words():
    rng = random.Random(11)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 10)):
            text = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.choice([0, 1, 5, 6, 7, 30, 120]))]
            if rng.random() < 0.6:
                unit = [rng.randrange(3) for _ in range(rng.randint(1, 7))]
                at = rng.randint(0, len(text))
                text[at:at] = (unit * rng.randint(3, 7))[rng.randrange(len(unit)) :]
            texts += [text] * rng.choice([1, 1, 3])
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        names = mixed(np.array([x for t in texts for x in t], np.uint64) + np.uint64(1))
        start, end, period = (x.tolist() for x in periodic.periodic_runs(names, starts))
        found = defaultdict(list)
        for s, e, q in zip(start, end, period, strict=True):
            owner = int(np.searchsorted(starts, s, side="right")) - 1
            found[owner].append((s - int(starts[owner]), e - s, q))
        assert [found[i] for i in range(len(texts))] == [brute_runs(t) for t in texts]


def test_a_nonterminal_is_looked_at_once():
    """A word repeated 2^12 times and 50 equal texts have about as many different nonterminals as one text's halvings."""
    for words, starts, most in (([0] * 4096, [0, 4096], 12), (list(range(64)) * 50, list(range(0, 3201, 64)), 64)):
        names = mixed(np.array(words, np.uint64) + np.uint64(1))
        text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        assert len(np.unique(periodic.grammar(names, text, 2)[0])) <= most


def edited(doc_id, text):
    w = WORD.findall(text or "")
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    prose = lambda n, k: " ".join(f"w{rng.randrange(k)}" for _ in range(n))
    rows = [(i, prose(rng.choice([0, 1, 7, 40, 200]), rng.choice([2, 5, 60]))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "a b " * 400), (204, "x " * 9 + "y z " * 5 + "z " * 6), (205, prose(30000, 500))]
    return rows + [(None, "a " * 8), (None, "a " * 8), (7, rows[3][1]), (206, "é\x85 " * 7), (206, "é\x85 " * 7), (207, "q r s " * 3 + "q r")]


def test_runs_of_documents(spark, texts):
    found = periodic.without_runs(documents(spark, texts), ("doc_id", "key")).collect()
    expected = Counter()
    for doc_id, text in texts:
        w = WORD.findall(text or "")
        runs = brute_runs(w)
        expected[doc_id, "k", len(w), tuple(runs), brute_collapse(w, runs)] += 1
    assert Counter((r[0], r[1], r.n_words, tuple(map(tuple, r[3])), r.collapsed) for r in found) == expected
    assert periodic.without_runs(documents(spark, [])).count() == 0


def test_query_of_runs(spark, texts, tmp_path):
    rows = [(d, t) for d, t in texts if t is None or len(t) < 20000]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    expected = Counter()
    for doc_id, text in rows:
        w = edited(doc_id, text)
        runs = brute_runs(w)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        expected[doc_id, len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4), sha(listed), sha(brute_collapse(w, runs))] += 1
    assert any(zlib.crc32(str(d).encode()) % 10 == 0 and len(WORD.findall(t or "")) > 30 for d, t in rows if d is not None)
    assert Counter(map(tuple, QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect())) == expected


# Hard negatives ---------------------------------------------------------------
VECTORS = "vec_id long, embedding array<float>, label int, key binary, grp long, rank int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, bytearray(b"k"), 1, 2) for r in rows], VECTORS)


def brute_negatives(rows, is_anchor):
    kept = {(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = Counter()
    for i, label, v in kept:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, u, strict=True)), j, m) for j, m, u in kept if j != i and len(u) == len(v))
        for s, j, _ in [x for x in scored if x[2] == label][:5]:
            inside = [(n, k) for n, k, m in scored if m != label and -50 * s <= -100 * n <= -95 * s]
            for rank, (n, k) in enumerate(inside[:3], 1):
                out[i, j, rank, k, -s, -n] += 1
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    base = [(i, [rng.uniform(-0.2, 1) for _ in range(6)], rng.choice([0, 0, 0, 1, 2])) for i in range(300)]
    base += [(300 + i, list(base[i][1]), rng.choice([0, 1])) for i in range(60)]  # ties
    base += [(400, None, 1), (401, [0.5] * 6, None), (402, [0.5, None, 0.5, 0.5, 0.5, 0.5], 0), (403, [float("nan")] * 6, 0), (404, [float("inf")] + [0.1] * 5, 0)]
    base += [(None, [0.5] * 6, 0), (410, [0.3, 0.4], 0), (420, [0.3, 0.5], 0), (421, [0.2, 0.3], 1), (430, [], 0), (431, [], 0), (432, [], 1)]
    base += [(440, [0.0] * 6, 0), (450, [-1.0] * 6, 2), base[20], base[20], (20, [0.9] * 6, 1), (500, [0.7], 4)]
    return base


def test_hard_negatives(spark, rows, monkeypatch):
    expected = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(expected) > 200
    found = lambda: Counter(map(tuple, negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0).collect()))
    assert found() == expected
    # Many blocks and passes give the same.
    for name, value in (("CANDIDATE_ROWS", 16), ("ANCHOR_ROWS", 5), ("PASS_BLOCKS", 2)):
        monkeypatch.setattr(negatives, name, value)
    assert found() == expected


def test_hard_negatives_of_no_rows_and_of_large_numbers(spark):
    none = vectors(spark, [])
    assert negatives.hard_negatives(none, F.col("vec_id") % 10 == 0).count() == 0
    large = vectors(spark, [(0, [3e38, 1.0], 0), (1, [3e38, 1.0], 0)])
    with pytest.raises(Exception, match="64 bits"):
        negatives.hard_negatives(large, F.col("vec_id") % 10 == 0).collect()


def test_keys_sort_like_anchor_falling_score_kind_and_id():
    values = [-(1 << 62), -3, 0, 5, 1 << 62]
    rows = [(a, r, s, k, i) for a in (-7, 4) for r in (0, 9) for s in values for k in (0, 1) for i in values]
    batches = [negatives.keys(*(np.array([x]) for x in (a, r, s)), k, np.array([i])) for a, r, s, k, i in rows]
    blobs = [b.column(1)[0].as_py() for b in batches]
    assert [next(negatives.entries(b)) for b in batches] == rows
    order = sorted(range(len(rows)), key=lambda j: blobs[j])
    assert [rows[j] for j in order] == sorted(rows, key=lambda x: (x[0], x[1], -x[2], x[3], x[4]))


def test_query_of_negatives(spark, rows, tmp_path):
    vectors(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    moved = [(i, v, (label + 1) % 10 if None not in (i, label) and i % 7 == 0 else label) for i, v, label in rows]
    assert Counter(map(tuple, QUERIES["op12_hard_negatives"](spark, str(tmp_path)).collect())) == brute_negatives(moved, lambda i: i % 50 == 0)


# Lines ------------------------------------------------------------------------
BLANK = " \t\n\x0b\x0c\r"


def line_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute_lines(rows):
    first, last = {}, {}
    place = lambda d: (d is None, d or 0)
    for d, text in rows:
        for line in (text or "").split("\n"):
            k = line_key(line)
            first[k], last[k] = min(first.get(k, place(d)), place(d)), max(last.get(k, place(d)), place(d))
    out = Counter()
    for d, text in rows:
        held = (text or "").split("\n")
        kept = [x for x in held if not (len(line_key(x)) >= 10 and first[line_key(x)] < place(d))]
        out[d, len(held), len(held) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(21)
    known = [f"line number {i} of all" for i in range(40)] + ["short", "ninechars", "ten chars!", "", "  ", "ÀÉÎ größe äöü"]
    rows = [(i, "\n".join(rng.choice(known).upper() if rng.random() < 0.2 else rng.choice(known) + rng.choice(["", " ", "\r", "\t\x0b"]) for _ in range(rng.randint(0, 8)))) for i in range(50)]
    rows += [(i, f"a line of a hot group\nown line of {i}") for i in range(100, 400)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "only once here\nonly once here"), (None, "a line of a hot group\nnull line, null line"), (None, "null line, null line")]
    rows += [(504, "same id, two texts\nx"), (504, "same id, two texts\ny"), (505, "Equal rows\nshared"), (505, "Equal rows\nshared"), (506, "equal ROWS"), (507, "\x85equal rows\x1c"), (508, "ten chars!")]
    return rows + [(509, "\n".join(f"long text line {i % 900}" for i in range(4000))), (510, "long text line 17")]


@pytest.mark.parametrize("most", [lines.MOST_CELLS, 1 << 16])
def test_repeated_lines(spark, pages, monkeypatch, most):
    monkeypatch.setattr(lines, "MOST_CELLS", most)
    found = lines.without_repeated_lines(documents(spark, pages)).collect()
    assert Counter(map(tuple, found)) == brute_lines(pages)
    assert lines.without_repeated_lines(documents(spark, [])).count() == 0


def test_a_full_filter_suspects_more_and_changes_nothing(spark, pages, monkeypatch):
    monkeypatch.setattr(lines, "cells", lambda words, size: np.zeros((len(words), 2), np.uint32))
    found = lines.without_repeated_lines(documents(spark, pages), ("doc_id",)).collect()
    assert Counter(map(tuple, found)) == brute_lines(pages)


def test_filter_holds_all_keys_of_two_documents_and_few_others(spark):
    rows = [(i, f"shared by two {i // 2}\nof its own only {i}") for i in range(2000)]
    bits, size = lines.twice_seen(documents(spark, rows), 10)

    def share(texts):
        words = np.array([np.frombuffer(lines.line_keys(lines.pa.array([t]), 10)[1][0], np.uint64) for t in texts])
        at = lines.cells(words, size)
        return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1).mean()

    assert share([f"shared by two {i}" for i in range(1000)]) == 1
    assert share([f"of its own only {i}" for i in range(2000)]) < 0.05


def test_query_of_lines(spark, pages, tmp_path):
    documents(spark, pages).write.parquet(str(tmp_path / "documents.parquet"))
    expected = Counter()
    for (d, n, gone, kept), times in brute_lines(pages).items():
        expected[d, n, gone, hashlib.sha256(kept.encode()).hexdigest()] += times
    assert Counter(map(tuple, QUERIES["op13_lines"](spark, str(tmp_path)).collect())) == expected


def test_all_pairs_of_a_hot_line_are_never_formed(spark):
    """300 documents of one line: one suspect row for each batch of texts."""
    docs = documents(spark, [(i, "a line of a hot group") for i in range(300)]).coalesce(2)
    given = docs.selectExpr("doc_id as id", "xxhash64(text) as tag", "text")
    bits, size = lines.twice_seen(given, 10)
    sent = given.mapInArrow(lambda b: lines.suspected(b, bits, size, 10), lines.SUSPECT).collect()
    assert len(sent) <= 2
    assert sorted(itertools.chain.from_iterable(r.ids for r in sent)) == list(range(300))
