"""The pipeline's stages against brute force, each on its own small table and one after another."""

import random
import re
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from vacancyflow.llm.queries import PIECE_MODEL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
STAGES = dict(corpus_pipeline.STAGES)
# Columns that are not a document's, some with names that the stages use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, label int, runs int, _id int, size string"
LETTERS = {"en": "abcde", "fi": "vwxyz"}


def prose(seed, n, letters="abcde", words=80):
    rng = random.Random(seed)
    known = ["".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(words)]
    return " ".join(rng.choices(known, k=n))


def table(spark, rows):
    return spark.createDataFrame([(*row, None if row[1] is None else len(row[1]), 1, 2, 3, 4, "x") for row in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, prose(i, rng.randint(40, 120), LETTERS["fi" if i % 2 else "en"]), "fi" if i % 2 else "en", ["a", "b", None][i % 3]) for i in range(60)]
    text = {i: out[i][1] for i in range(60)}
    passage = prose(500, 30)
    out += [(100 + i, text[0], "en", "a") for i in range(4)] + [(110, text[2].upper(), "en", "b"), (111, text[4] + " end", "en", "b")]
    out += [(120 + i, prose(600 + i, 50) + " " + passage + " " + prose(700 + i, 50), "en", "c") for i in range(3)]
    out += [(130, None, "en", "a"), (131, "", None, None), (132, " \n\t", "fi", "a"), (133, "123 456 !?", "en", "b"), (134, prose(800, 4000, words=900), "en", "d")]
    return out + [out[5], (None, text[6], "en", "a"), (135, "ab ba", "en", "a")]


def told(found):
    assert found.columns == list(corpus_pipeline.COLUMNS)
    return [tuple(r) for r in found.collect()]


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def given(rows):
    return [(*row[:4], None if row[1] is None else len(row[1])) for row in rows]


def test_language_stage_keeps_all_but_what_no_model_fits(spark, rows):
    strange = [(200, prose(900, 60, "ÅÄÖåäö"), None, "a"), (201, prose(901, 60, "бвгд"), None, "a")]
    found = told(STAGES["language"](spark, table(spark, rows + strange), None))
    assert Counter(found) == Counter(r for r in given(rows) if re.search("[A-Za-z]", r[1] or ""))


def test_near_duplicate_stage_keeps_one_of_each_group(spark, rows):
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    best = {}
    for i, r in enumerate(given(rows)):
        if sets[i] and (group[i] not in best or (r[0] is None, r[0] or 0) < (best[group[i]][0] is None, best[group[i]][0] or 0)):
            best[group[i]] = r
    expected = [*best.values(), *[r for i, r in enumerate(given(rows)) if not sets[i]]]
    assert Counter(told(STAGES["near_duplicates"](spark, table(spark, rows), None))) == Counter(expected)


def test_passage_stage_removes_what_a_smaller_document_has(spark, rows):
    holders = {}
    for doc_id, text, *_ in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - 12) if doc_id is not None else ():
            holders[tuple(w[i : i + 13])] = min(doc_id, holders.get(tuple(w[i : i + 13]), doc_id))
    expected = []
    for doc_id, text, lang, source in rows:
        w = WORD.findall(text or "")
        gone = {i + k for i in range(len(w) - 12) if doc_id is not None and holders[tuple(w[i : i + 13])] < doc_id for k in range(13)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else text
        expected.append((doc_id, kept, lang, source, None if kept is None else len(kept)))
    assert Counter(told(STAGES["passages"](spark, table(spark, rows), None))) == Counter(expected)


def targets(sizes):
    """Shares 5, 2, 1, repeating, of all sizes by source, none above 3 times its own; the rest goes to the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = {}
    while True:
        left = sum(sizes.values()) - sum(full.values())
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s: 3.0 * sizes[s] for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return full | share
        full |= over


def test_mixing_stage_comes_near_the_targets(spark, rows):
    size = {r: len(WORD.findall(r[1] or "")) for r in given(rows)}
    sizes = Counter()
    for r in given(rows):
        sizes[r[3]] += size[r]
    found = told(STAGES["mixing"](spark, table(spark, rows), None))
    assert set(found) <= set(given(rows)) and sorted(map(str, found)) == sorted(map(str, told(STAGES["mixing"](spark, table(spark, rows), None))))
    there, copies = Counter(given(rows)), Counter(found)
    assert all(copies[r] <= 3 * n if size[r] else copies[r] == n for r, n in there.items())
    for source, target in targets(sizes).items():
        taken = sum(size[r] * n for r, n in copies.items() if r[3] == source)
        assert abs(taken - target) <= max(size[r] for r in there if r[3] == source)


def test_piece_stage_equals_the_model_library(spark, rows):
    peer = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    found = STAGES["pieces"](spark, table(spark, rows), None).collect()
    assert all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in found)
    expected = Counter((doc_id, lang, source, tuple(peer.encode(text or ""))) for doc_id, text, lang, source in rows)
    assert Counter((r.doc_id, r.lang, r.source, tuple(r.ids)) for r in found) == expected


@pytest.mark.parametrize("empty", [False, True])
def test_run_applies_the_stages_in_turn(spark, rows, tmp_path, empty):
    table(spark, rows).limit(0 if empty else len(rows)).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in found}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "passages", "mixing", "pieces"]
    if empty:
        assert not found
    else:
        # Copies, near copies and texts without letters are gone; a source is taken whole or in part.
        assert ids and not ids & {100, 101, 102, 103, 110, 130, 131, 132, 133} and all(r.parity for r in found)
