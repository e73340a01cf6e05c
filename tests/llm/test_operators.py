"""The corpus operators against brute force on small tables with nulls, empty texts, ties, repeats and further columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vacancyflow.llm import components, fingerprints, jaccard, language, mixing, pieces, sharding, substrings, topk, toxicity, warc, words
from vacancyflow.llm.queries import PIECE_MODEL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, label int, _part int, ids string"


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source) with columns whose names the operators use themselves."""
    full = [(*row, None if row[1] is None else len(row[1]), "x", "y", 1, 2, "z") for row in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n, words=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(2, 6))) for _ in range(words)]
    return " ".join(rng.choices(vocabulary, k=n))


@pytest.fixture(scope="module")
def rows():
    base = [prose(i, 40 + i) for i in range(12)]
    out = [(i, text, "en", "s0" if i % 3 else None) for i, text in enumerate(base)]
    out += [(20, base[0], "en", "s0"), (21, base[0].upper(), "en", "s1"), (22, base[1] + " new end", "de", "s1")]
    out += [(23, base[2] + "\n\t" + base[3], None, "s2"), (24, None, None, None), (25, "", "en", "s2"), (26, " \t\n", "en", "s2")]
    out += [(27, "one two", "en", "s0"), (28, "One  two", "fr", "s0"), (29, prose(50, 5000, 400), "en", "s3")]
    out += [(None, base[4], "en", "s0"), (None, base[4], "en", "s0"), (30, base[5], "en", "s0"), (30, base[5], "en", "s0")]
    return out + [(31, "the " * 300, "en", "s0"), (32, "\x1cword\x85 café ▁ tail", "en", "s0")]


def test_words_are_runs_between_ascii_space():
    texts = ["a  b\x0bc\x1cd e\x85", "", None, "\r\n", " x "]
    values, starts = words.split_words(pa.array(texts))
    found = [values[a:b].to_pylist() for a, b in itertools.pairwise(starts)]
    assert found == [WORD.findall(t or "") for t in texts]


def test_byte_shards(spark, rows):
    found = sharding.byte_shards(documents(spark, rows), 5, 3).collect()
    sizes = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == sizes
    by_shard = {s: sorted((r.slot, r) for r in found if r.shard == s) for s in range(5)}
    line = [r for s in range(5) for _, r in by_shard[s]]
    assert [(r.doc_id is not None, r.doc_id or 0) for r in line] == sorted((r.doc_id is not None, r.doc_id or 0) for r in line)
    total, ahead = sum(r.size for r in line), 0
    for r in line:
        assert r.shard == (2 * ahead + r.size) * 5 // (2 * total)
        ahead += r.size
    assert all([slot for slot, _ in x] == list(range(len(x))) for x in by_shard.values())
    assert sharding.byte_shards(documents(spark, [])).count() == 0


def shingles(text, k):
    found = [w.translate(str.maketrans(*(x * 1 for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))) for w in WORD.findall(text or "")]
    return {tuple(found[i : i + k]) for i in range(max(1, len(found) - k + 1))} if found else set()


@pytest.mark.parametrize(("length", "least"), [(4, 85), (5, 80)])
def test_near_duplicates(spark, rows, length, least):
    sets = [shingles(t, length) for _, t, *_ in rows]
    name = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= least * len(a | b):
            old, new = name[j], name[i]
            name = [new if x == old else x for x in name]
    expected = Counter()
    for i, (doc_id, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if name[j] == name[i] and rows[j][0] is not None]
        expected[doc_id, len(sets[i]), min(ids, default=None) if sets[i] else doc_id] += 1
    found = jaccard.near_duplicates(documents(spark, rows), length, least)
    assert Counter((None if r.id == jaccard.NO_ID else r.id, r.n_shingles, r.component) for r in found.collect()) == expected
    assert jaccard.near_duplicates(documents(spark, [])).count() == 0


def test_linked_sets_share_prefixes_under_both_hash_orders():
    rng = np.random.default_rng(8)
    linked = apart = 0
    for _ in range(400):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 120)), dtype=np.uint64))
        other = rng.integers(0, 2**63, int(rng.integers(0, 30)), dtype=np.uint64)
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.choice([0.3, 0.9, 1])], other]))
        if not len(b):
            continue
        tokens, starts = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        x, y = (np.frombuffer(z, np.uint16) for z in jaccard.hash_prefixes(tokens, starts, 85))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 85 * (len(a) + len(b) - shared):
            assert jaccard.share_prefixes(x, y)
            linked += 1
        else:
            apart += not jaccard.share_prefixes(x, y)
    assert linked > 20 and apart > 20
    assert jaccard.hash_prefixes(np.zeros(0, np.uint64), np.array([0, 0]), 85) == [None]


def test_parities_differ_in_no_more_bits_than_sets_in_tokens():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 1100).astype(np.uint64)
    sets = [base[:400], base[:390], np.zeros(0, np.uint64), base[5:400], rng.integers(0, 1 << 62, 300).astype(np.uint64), base[:1], base, base[:1020]]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    found = jaccard.parities(np.concatenate(sets), starts)
    assert [None if x is None else 8 * len(x) for x in found] == [512, 512, None, 512, 512, 256, 2048, 1024]
    bits = [np.frombuffer(x or bytes(32), np.uint64) for x in found]
    assert np.bitwise_count(bits[5]).sum() == 1
    for i, j in itertools.combinations(range(len(sets)), 2):
        apart = len(set(sets[i].tolist()) ^ set(sets[j].tolist()))
        differ = jaccard.unlike(bits[i], bits[j])
        assert differ <= apart and differ % 2 == apart % 2
    assert jaccard.unlike(bits[0], bits[4]) > 80


def test_linked_chain_of_copies(spark):
    """Each text differs from the next by one word, so far ends are linked through others only."""
    base = prose(3, 300, 500).split()
    rows = []
    for i in range(60):
        base[5 * i] = f"changed{i}"
        rows.append((100 - i, " ".join(base), "en", "s"))
    assert {r.component for r in jaccard.near_duplicates(documents(spark, rows)).collect()} == {41}


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, rng.randint(101, 160)) for _ in range(80)] + [(7, 7)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **{x: 100 for a, b in links if a == 100 for x in (a, b)}}


@pytest.mark.parametrize("buckets", [None, 1])
def test_without_repeats(spark, rows, buckets):
    first = {}
    for doc_id, text, *_ in rows:
        found = WORD.findall(text or "")
        for i in range(len(found) - 12):
            if doc_id is not None:
                first[tuple(found[i : i + 13])] = min(doc_id, first.get(tuple(found[i : i + 13]), doc_id))
    expected = Counter()
    for doc_id, text, *_ in rows:
        found = WORD.findall(text or "")
        gone = {j for i in range(len(found) - 12) if doc_id is not None and first[tuple(found[i : i + 13])] < doc_id for j in range(i, i + 13)}
        expected[doc_id, len(found), len(gone), " ".join(w for i, w in enumerate(found) if i not in gone)] += 1
    found = substrings.without_repeats(documents(spark, rows), buckets=buckets)
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert substrings.without_repeats(documents(spark, [])).count() == 0


def test_windows_of_equal_hash_are_told_apart(monkeypatch):
    numbers, ids = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3]), np.array([5, 4, 6])
    monkeypatch.setattr(substrings, "run_hashes", lambda w, n: np.zeros(len(w) - n + 1, np.uint64))
    assert substrings.repeats(numbers, np.array([0, 3, 6]), ids, 3).tolist() == [False, False, True]


@pytest.fixture
def pages(spark):
    long = "<p>" + "é" * 700
    rows = [(1, "http://a/ b\r\n", long), (5, None, long), (3, "u", long), (7, "u", "short"), (8, "u", "short"), (9, "u", None), (None, "u", long), (10, "u", ""), (11, "u", "z" * 1000), (11, "u", "z" * 1000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_warc_round_trip(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/archives"
    found = [r for r in warc.round_trip(pages, folder).collect() if r.kind == "record"]
    expected = Counter()
    for page_id, _, html in pages.collect():
        payload = (html or "").encode()
        top = 5 if len(payload) == 1403 and page_id != 5 else None
        name = "urn:page:" + ("" if page_id is None else str(page_id))
        expected[name, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if top else "response", f"urn:page:{top}" if top else None] += 1
    assert Counter((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == expected
    again = {r.record_id: r for r in warc.read_archives(spark, folder, payloads=True).collect()}
    assert bytes(again["urn:page:7"].payload) == b"short"
    assert again["urn:page:1"].target_uri == "http://a/%20b%0D%0A"
    empty = f"file://{tmp_path}/none"
    assert warc.round_trip(pages.limit(0), empty).count() == 0


@pytest.mark.parametrize("plain", [False, True])
def test_salvage(plain):
    made = [warc.record(i, "u", b"payload %d" % i * 50, hashlib.sha1(b"").hexdigest(), None, "2024-01-01T00:00:00Z") for i in range(6)]
    parts = made if plain else [warc.compressed(x, 6) for x in made]
    broken = bytearray(parts[1])
    broken[len(broken) // 2] ^= 255
    data = b"".join([parts[0], bytes(broken), b"junk\x1f\x8b\x08junk", parts[2], parts[3][: len(parts[3]) // 2], parts[4], parts[5][:-3]])
    found = list(warc.salvaged(data))
    # Of the last member only the checksum is cut, so its record is still whole.
    assert [x[3]["warc-record-id"][10:-1] for x in found if x[0] == "record"] == ["0", "2", "4", *([] if plain else ["5"])]
    found = [x for x in found if x[5] is None or x[0] == "record"]
    assert [x[0] for x in found] == ["record", "gap", "record", "gap", "record", "gap" if plain else "record"]
    assert sum(x[2] for x in found) == len(data) and all(a[1] + a[2] == b[1] for a, b in itertools.pairwise(found))
    assert list(warc.salvaged(b"")) == []


def made_records(n, size=50):
    return [warc.record(i, "u", b"payload %d" % i * size, hashlib.sha1(b"").hexdigest(), None, "2024-01-01T00:00:00Z") for i in range(n)]


def names(found):
    return [int(x[3]["warc-record-id"][10:-1]) for x in found if x[0] == "record"]


def test_salvage_inside_members():
    made = made_records(3)
    broken = bytearray(made[1])
    broken[-20] ^= 255
    long = made[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    for second, why in ((bytes(broken), "block digest differs"), (long, "record not ended")):
        for data in (warc.compressed(made[0] + second + made[2], 6), made[0] + second + made[2]):
            found = list(warc.salvaged(data))
            assert names(found) == [0, 2]
            gaps = [x for x in found if x[0] == "gap"]
            assert len(gaps) == 1 and gaps[0][3] == why and gaps[0][2] == len(second)
            assert (gaps[0][5] or gaps[0][1]) == len(made[0])


@pytest.mark.parametrize("flip", [False, True])
def test_salvage_of_a_whole_file_in_one_member(flip):
    """Cut at its end or damaged in its midst, a member gives the records before, and the next member is found."""
    made = made_records(2000)
    data = bytearray(warc.compressed(b"".join(made), 6))
    whole = len(data)
    if flip:
        data[whole // 2 : whole // 2 + 40] = bytes(40)
    else:
        del data[whole * 9 // 10 :]
    tail = warc.compressed(warc.record(5000, "u", b"tail", "", None, "2024-01-01T00:00:00Z"), 6)
    found = list(warc.salvaged(bytes(data) + tail))
    assert names(found)[-1] == 5000 and names(found)[:-1] == list(range(len(names(found)) - 1))
    assert len(names(found)) > (2000 // 2 if flip else 2000 * 9 // 10) - 100
    outer = [x for x in found if x[0] == "gap" and x[5] is None]
    assert len(outer) == 1 and outer[0][1] + outer[0][2] == len(data)


def test_reading_members_takes_time_in_proportion():
    """Bytes handed to zlib stay in proportion to the archive: no member gets the whole rest."""
    fed = []

    class Counting:
        def __init__(self, real):
            self.real = real

        def decompress(self, piece):
            fed.append(len(piece))
            return self.real.decompress(piece)

        def copy(self):
            return Counting(self.real.copy())

        def __getattr__(self, name):
            return getattr(self.real, name)

    data = b"".join(warc.compressed(x, 6) for x in made_records(3000))
    real = warc.zlib.decompressobj
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(warc.zlib, "decompressobj", lambda bits: Counting(real(bits)))
        assert names(warc.salvaged(data)) == list(range(3000))
    assert max(fed) <= warc.PIECE and len(fed) < 3000 + 2 * len(data) // warc.PIECE


def test_warc_of_wide_tables_and_long_payloads(spark, tmp_path):
    """Columns named like those of the reader are not read; a payload of many megabytes comes back whole."""
    text = "".join(random.Random(1).choices("abcdefgh <>\n", k=1 << 20)) * 12
    rows = [(1, "u", text, "d", 5, "k", 1), (2, "u", text, "d", 5, "k", 1), (3, "v", None, "d", 5, "k", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string, refers_to int, kind string, offset int")
    found = {r.record_id: r for r in warc.round_trip(pages, f"file://{tmp_path}/wide").collect()}
    digest = hashlib.sha1(text.encode()).hexdigest()
    assert {k: (r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for k, r in found.items()} == {
        "urn:page:1": ("revisit", len(text), digest, "urn:page:2"),
        "urn:page:2": ("response", len(text), digest, None),
        "urn:page:3": ("response", 0, hashlib.sha1(b"").hexdigest(), None),
    }


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 3]) for i in range(250)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (400, None), (500, []), (600, [1.0] * 5 + [None]), (None, [1.0] * 6), (700, [float("nan")] + [0.0] * 5), (3, rows[3][1]), (800, [1.0, 2.0])]
    kept = dict((i, np.floor(np.float32(v).astype(float) * 1024).astype(int)) for i, v in rows if i in range(250) or i in (300, 301))
    expected = set()
    for q in kept:
        if q % 100 == 0:
            order = sorted((-int(kept[q] @ kept[c]), c) for c in kept if c != q)[:10]
            expected |= {(q, rank, c, -s) for rank, (s, c) in enumerate(order, 1)}
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, score string")
    assert {tuple(r) for r in topk.top_k(table, F.col("vec_id") % 100 == 0).collect()} == expected
    assert topk.top_k(table.limit(0), F.lit(True)).count() == 0


def test_mixing(spark, rows):
    found = mixing.mixed(documents(spark, rows)).collect()
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    stopped: set = set()
    while True:
        free = [s for s in names if s not in stopped]
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not above:
            break
        stopped |= above
    target = {s: 3 * sizes[s] if s in stopped else weight[s] * level for s in names}
    assert len(found) == len(rows)
    for source in names:
        own = [r for r in found if r.source == source]
        assert all(r.source_size == sizes[source] and r.target == pytest.approx(target[source]) and 0 <= r.taken <= 3 * r.size for r in own)
        assert sum(r.taken for r in own) == int(target[source] + 1e-9)
        epochs = int(target[source]) // sizes[source]
        assert sum(r.taken % max(r.size, 1) != 0 for r in own) <= 1 and all(epochs * r.size <= r.taken <= (epochs + 1) * r.size for r in own)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mixed(documents(spark, rows[::-1])).collect()))
    whole = mixing.mixed(documents(spark, rows), whole=True).collect()
    assert all(r.size == 0 or r.taken % r.size == 0 for r in whole)
    assert mixing.mixed(documents(spark, [])).count() == 0


def test_pieces_equal_the_model_library(spark, rows):
    import sentencepiece

    peer = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    more = [(40, "  two  spaces ", "en", "s"), (41, "tab\tand\nline 中文 🙂 \u0000", "en", "s"), (42, " ", "en", "s"), (43, "a" * 3000, "en", "s")]
    found = pieces.encoded(documents(spark, rows + more), PIECE_MODEL, ("doc_id", "ids")).select("doc_id", F.col("ids").alias("own"), "pieces.*").collect()
    texts = {d: t for d, t, *_ in rows + more}
    assert len(found) == len(rows + more)
    for r in found:
        assert r.own == "z" and r.parity and r.round_trip
        assert r.ids == peer.encode(texts[r.doc_id] or "")
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<i4").tobytes()).hexdigest()


def test_the_model_library_is_asked_for_every_whole_text():
    """Ids that differ only in texts of several words are told; repeated texts and words are asked for again."""
    with open(PIECE_MODEL, "rb") as file:
        model = file.read()
    coder, asked = pieces.Pieces(model, pieces.parsed(model)), []
    real = coder.peer

    class Turned:
        def encode(self, texts, **options):
            asked.extend(texts)
            return [ids[::-1] if " " in text else ids for text, ids in zip(texts, real.encode(texts, **options), strict=True)]

    coder.peer = Turned()
    texts = ["one two three", "word", "", "one two three", "  two  spaces", "word", "long " * (pieces.SLICE_CHARS // 4) + "end"]
    told = coder.encode(texts)
    assert asked == texts and [same for _, same, _ in told] == [" " not in x for x in texts]
    assert [ids.tolist() for ids, *_ in told] == real.encode(texts)


def test_language(spark):
    english, german = prose(1, 4000, 300), prose(1, 4000, 300).translate(str.maketrans("abcdeé", "uvwxyö"))
    cut = lambda text, n: [" ".join(text.split()[i : i + n]) for i in range(0, 4000, n)]
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([*((t, "en") for t in cut(english, 40)), *((t, "de") for t in cut(german, 40))])]
    learn = F.col("doc_id") % 2 == 0
    models = language.trained(documents(spark, rows), learn)
    extra = [(900, None, "en", "s"), (901, "12 34 !!", "en", "s"), (902, "", None, "s"), (903, "щы жъ " * 30, "en", "s"), (904, english.upper() * 5, "en", "s")]
    found = {r.doc_id: r for r in language.identified(documents(spark, rows + extra), models, ("doc_id", "label")).collect()}
    assert all(found[d].lang_pred == lang and not found[d].rejected and 0 <= found[d].score <= 1 for d, _, lang, _ in rows)
    assert [found[d].lang_pred for d in (900, 901, 902)] == ["und"] * 3 and all(found[d].rejected for d in (900, 901, 902, 903))
    assert found[904].lang_pred == "en"
    assert language.trained(documents(spark, []), learn) is None
    assert {r.lang_pred for r in language.identified(documents(spark, rows), None).collect()} == {"und"}


def test_kneser_ney_sums_to_one():
    """Over the alphabet and the unknown character, every context's probabilities sum to 1."""
    import pandas as pd

    grams = Counter()
    for w in ["abab", "abba", "baa", "aab"]:
        text = language.BEGIN * 3 + w + language.END
        grams.update(text[i - 4 : i] for i in range(4, len(text) + 1))
    models = language.Models(pd.DataFrame([("x", g, n) for g, n in grams.items()], columns=["lang", "gram", "n"]))
    context = language.BEGIN * 2 + "a"
    total = 0.0
    for char in ["a", "b", language.END, "?"]:
        codes = np.array([ord(c) for c in context + char], np.uint64)
        p, ends = np.full((1, 1), models.floor), np.array([3])
        for k in range(1, 5):
            h = language.gram_hashes(codes, ends - 1, k - 1) if k > 1 else np.zeros(1, np.uint64)
            p = models.rows(models.shares[k], language.gram_hashes(codes, ends, k)) + models.rows(models.weights[k], h) * p
        total += p[0, 0]
    assert total == pytest.approx(1)


def test_toxicity(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        text = prose(i % 7, 120, 300).split()
        if i % 4 == 0:
            for _ in range(6):
                text[rng.randrange(120)] = rng.choice(["horridword", "nastything", "vilephrase"])
        rows.append((i, " ".join(text), "en", "s"))
        labels.append((i, int(i % 4 == 0)))
    docs, marks = documents(spark, [*rows, (900, None, "en", "s"), (901, "", "en", "s"), (902, "x", "en", "s")]), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.trained(docs, marks, F.col("doc_id") % 5 != 0)
    found = {r.doc_id: r for r in toxicity.scored(docs, model, ("doc_id", "label")).collect()}
    held = [(found[d].predicted, t) for d, t in labels if d % 5 == 0]
    assert sum(p == t for p, t in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in found.values())
    assert found[900].score == found[901].score < 0.5
    assert toxicity.trained(docs, marks.filter("toxic = 0"), F.lit(True)) is None
    assert {r.score for r in toxicity.scored(docs, None).collect()} == {0.0}


def test_toxicity_counts_copies_once(spark):
    copies = [(f"alpha beta{i % 3} gamma", 1) for i in range(60)] + [(f"delta bad{'' if i % 2 else 'ly'} w{i}", 1) for i in range(10)]
    found = toxicity.counted(spark.createDataFrame([*copies, ("alpha x", 0), (None, 0), ("", 0)], "text string, toxic int"))
    rows = {r.segment: (r.toxic, r.ordinary) for r in found.collect()}
    assert rows["alpha"] == (3, 1)  # 60 documents, three contexts
    assert rows["gamma"] == (3, 0) and rows["beta0"] == (1, 0)
    assert rows["bad"] == (5, 0) and rows["delta"] == (2, 0)
    assert toxicity.counted(spark.createDataFrame([], "text string, toxic int")).count() == 0


def test_toxicity_with_odd_labels(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(240):
        text = prose(i, 80, 300).split()
        if i % 2:
            for _ in range(8):
                text[rng.randrange(80)] = "horridword"
        rows.append((i, " ".join(text), "en", "s"))
        labels.append((i, i % 2))
    # A document of both labels, one of an unknown label, one of none, a repeated row, a very long text.
    rows += [rows[1], (300, None, "en", "s"), (301, (prose(3, 10, 300) + " horridword ") * 2000, "en", "s"), (302, "", "en", "s")]
    marks = spark.createDataFrame([*labels, (4, 1), (6, None), (8, 7), (301, 1), (301, 1)], "doc_id long, toxic int")
    docs = documents(spark, rows)
    model = toxicity.trained(docs, marks, F.lit(True))
    found = [(r.doc_id, r.predicted, r.score) for r in toxicity.scored(docs, model).collect()]
    assert Counter(d for d, *_ in found) == Counter(d for d, *_ in rows)
    by_id = {d: (predicted, score) for d, predicted, score in found}
    assert by_id[301][0] == 1 and by_id[300] == by_id[302]
    # As many toxic as ordinary documents: without evidence a text is not toxic.
    assert by_id[300][0] == 0 and by_id[300][1] < 0.5
    assert sum(by_id[d][0] == t for d, t in labels) >= 0.95 * len(labels)


def test_fingerprints(spark, rows):
    found = fingerprints.fingerprints(documents(spark, rows)).collect()
    order = sorted({(d, t or "") for d, t, *_ in rows}, key=lambda x: (x[0] is not None, x[0] or 0))
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    expected = Counter()
    for doc_id, text, *_ in rows:
        text = text or ""
        half = len(text) // 2
        expected[doc_id, len(text), text[: len(text) - half] + after[doc_id, text][1][:half]] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited) for r in found) == expected
    prints = {}
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        a, b = set(r.fingerprint.split()), set(r.edited_fingerprint.split())
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b))
        prints[r.doc_id] = r.fingerprint
    assert prints[0] == prints[20] and prints[24] == prints[25]
    assert fingerprints.fingerprints(documents(spark, [])).count() == 0


def test_signatures_are_chains_behind_anchors(spark):
    text = spark.createDataFrame([("The red, red fox of the old wood and",)], "text string")
    found = set(text.select(fingerprints.signatures(F.col("text"))).first()[0])
    chains = [(" red red",), (" old wood",)]
    assert found == {r[0] for r in spark.createDataFrame([(c[0].strip(),) for c in chains], "c string").select(F.xxhash64("c")).collect()}


def test_near_pairs(spark):
    base = ("the " + prose(8, 200, 150).replace(" ", " the ")).split()
    rows = [(i, " ".join(base[: 400 - 10 * i]), "en", "s") for i in range(6)] + [(9, " ".join(base), "en", "s"), (10, "the other words", "en", "s")]
    pairs, members = fingerprints.near_pairs(documents(spark, rows))
    by_class = {r.doc_id: r.class_id for r in members.collect()}
    sets = {r.doc_id: set(r.s) for r in documents(spark, rows).select("doc_id", fingerprints.signatures(F.col("text")).alias("s")).collect()}
    expected = {frozenset((by_class[a], by_class[b])) for a, b in itertools.combinations(sets, 2) if by_class[a] != by_class[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {frozenset((r.first, r.second)) for r in pairs.collect()} == expected and by_class[0] == by_class[9]


def unigram_model(prefix=True, extra=True):
    """The bytes of a small unigram model: byte fallback, a user piece, a piece across words if `prefix`."""

    def varint(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    def field(number, value):
        if isinstance(value, bytes):
            return varint(number << 3 | 2) + varint(len(value)) + value
        if isinstance(value, float):
            return varint(number << 3 | 5) + np.array([value], "<f4").tobytes()
        return varint(number << 3) + varint(value)

    plain = ["▁", "a", "b", "c", "d", "▁a", "ab", "▁ab", "abc", "▁the", "t", "h", "e", "▁▁", "cd", *(["c▁d"] if prefix else [])]
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("<user>", 0.0, 4)]
    pieces += [(f"<0x{i:02X}>", -20.0, 6) for i in range(256)] + [(p, -1.0 - i / 7, 1) for i, p in enumerate(plain)]
    out = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    trainer = field(3, 1) + field(35, 1) + field(40, 0) + field(41, 1) + field(42, 2)
    normaliser = field(1, b"identity") + field(3, 1) + field(4, int(extra)) + field(5, 1)
    return out + field(2, trainer) + field(3, normaliser)


@pytest.mark.parametrize("prefix", [False, True])
@pytest.mark.parametrize("extra", [False, True])
def test_unigram_pieces_equal_the_model_library(spark, rows, tmp_path, prefix, extra):
    import sentencepiece

    model = unigram_model(prefix, extra)
    (tmp_path / "small.model").write_bytes(model)
    peer = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ["abc the ab cd", "c d abcd", "  the  abc ", "éü 中 🙂", "", None, "the " * 50, "x" * 40, "ab\ncd\tthe"]
    table = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    found = pieces.encoded(table, str(tmp_path / "small.model")).select("doc_id", "pieces.*").collect()
    for r in found:
        assert r.ids == peer.encode(texts[r.doc_id] or ""), texts[r.doc_id]
        assert r.parity
    assert pieces.encoded(documents(spark, []), str(tmp_path / "small.model")).count() == 0
