"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancyflow.llm.shared import small_batches
from vacancyflow.llm.words import chunks, mixed, split_words, vocabulary

ORDER, SAMPLE_DOCS, LEFT_OUT, MOST_LANGUAGES = 4, 1500, 5, 1000
CHUNK_BYTES = 1 << 20  # of texts scored at a time; what scoring holds is some forty times that
SLACK, LIKELY, SPREADS = 0.4, 0.9, 3.0  # see `calibrated`
BEGIN, END = "\x02", "\x03"
PREDICTED = "lang_pred string, score double, cross_entropy double, rejected boolean"
PREDICTED_TYPE = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())])


def letter_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Word numbers of all texts in turn, each text's start, and the lower-case words by number, with their letters
    and marks only; a word without letters is empty."""
    values, starts = split_words(pc.utf8_lower(pc.fill_null(texts, "")))
    at, words = vocabulary(values)
    letters = pc.replace_substring_regex(words, r"[^\p{L}\p{M}]+", "")
    return at, starts, pc.if_else(pc.match_substring_regex(letters, r"\p{L}"), letters, "").to_pylist()


def gram_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, each with ORDER - 1 begin marks and one end mark, and the places to predict."""
    text = "".join([BEGIN * (ORDER - 1) + w + END for w in words])
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    return codes, np.flatnonzero(codes != ord(BEGIN))


def gram_hashes(codes: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the `length` code points up to and including each of `ends`."""
    h = np.full(len(ends), length, np.uint64)
    for i in range(length - 1, -1, -1):
        h = h * np.uint64(0x100000001B3) + codes[ends - i]
    return mixed(h)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram and n of every run of ORDER characters in (lang, text)."""
    for batch in chunks(batches, 1):
        at, starts, words = letter_words(batch.column(1))
        langs = np.repeat(np.array(batch.column(0).to_pylist(), dtype=object), np.diff(starts))
        table = pd.DataFrame({"lang": langs, "at": at}).value_counts().reset_index(name="n")
        found: dict[tuple[str, str], int] = defaultdict(int)
        for lang, i, n in table.itertuples(index=False):
            if words[i]:
                text = BEGIN * (ORDER - 1) + words[i] + END
                for k in range(ORDER, len(text) + 1):
                    found[lang, text[k - ORDER : k]] += n
        keys, n = list(found), list(found.values())
        yield pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in keys], pa.string()), "gram": pa.array([k[1] for k in keys], pa.string()), "n": pa.array(n, pa.int64())})


def hashed_strings(grams: list[str]) -> np.ndarray:
    """`gram_hashes` of strings of one length."""
    if not grams or not grams[0]:
        return np.zeros(len(grams), np.uint64)
    length = len(grams[0])
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return gram_hashes(codes, np.arange(length - 1, len(codes), length), length)


class Models:
    """For each order k: sorted hashes of seen grams with their discounted shares, and sorted hashes of seen
    contexts with the weight of the lower order, one column per language."""

    def __init__(self, counts: pd.DataFrame) -> None:
        self.langs = sorted(counts["lang"].unique())
        chars = sorted({c for g in counts["gram"] for c in g[-1]})
        self.floor = 1.0 / (len(chars) + 1)
        shares, weights = ([defaultdict(dict) for _ in range(ORDER + 1)] for _ in range(2))
        for column, lang in enumerate(self.langs):
            own = counts[counts["lang"] == lang]
            level = dict(zip(own["gram"], own["n"], strict=True))
            for k in range(ORDER, 0, -1):
                singles, doubles = (sum(v == x for v in level.values()) for x in (1, 2))
                cut = singles / (singles + 2 * doubles) if singles else 0.5
                cut = min(max(cut, 0.1), 0.9)
                total, kinds, below = defaultdict(int), defaultdict(int), defaultdict(int)
                for gram, n in level.items():
                    total[gram[:-1]] += n
                    kinds[gram[:-1]] += 1
                    below[gram[1:]] += 1  # a lower order counts in how many contexts a gram was seen
                for gram, n in level.items():
                    shares[k][gram][column] = (n - cut) / total[gram[:-1]] if n > cut else 0.0
                for context, n in total.items():
                    weights[k][context][column] = cut * kinds[context] / n
                level = below
        self.shares = [self.sorted(x, 0.0) for x in shares]
        self.weights = [self.sorted(x, 1.0) for x in weights]
        self.usual, self.spread = np.full(len(self.langs), np.inf), np.zeros(len(self.langs))

    def sorted(self, rows: dict[str, dict[int, float]], absent: float) -> tuple[np.ndarray, np.ndarray]:
        keys = hashed_strings(list(rows))
        values = np.full((len(rows) + 1, len(self.langs)), absent)
        for i, by_lang in enumerate(rows.values()):
            for column, value in by_lang.items():
                values[i, column] = value
        order = np.argsort(keys)
        return keys[order], np.concatenate([values[order], values[-1:]])  # the last row is for what was not seen

    @staticmethod
    def rows(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
        known, values = table
        at = np.searchsorted(known, keys)
        seen = known[np.minimum(at, len(known) - 1)] == keys if len(known) else np.zeros(len(keys), bool)
        return values[np.where(seen, at, len(known))]

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Negative log probability of every word per language, and its number of predicted characters; 0 without letters."""
        full = [w for w in words if w]
        out, size = np.zeros((len(words), len(self.langs))), np.zeros(len(words), np.int64)
        if not full:
            return out, size
        codes, ends = gram_codes(full)
        _, first, back = np.unique(gram_hashes(codes, ends, ORDER), return_index=True, return_inverse=True)
        place = ends[first]  # one place for each different gram
        p = np.full((len(place), len(self.langs)), self.floor)
        for k in range(1, ORDER + 1):
            context = gram_hashes(codes, place - 1, k - 1) if k > 1 else np.zeros(len(place), np.uint64)
            p = self.rows(self.shares[k], gram_hashes(codes, place, k)) + self.rows(self.weights[k], context) * p
        lengths = np.fromiter(map(len, full), np.int64, len(full)) + 1
        at = np.flatnonzero([bool(w) for w in words])
        out[at] = np.add.reduceat(-np.log(p)[back], np.cumsum(lengths) - lengths, axis=0)
        size[at] = lengths
        return out, size

    def cross_entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language, in nats per character, and the number of characters."""
        at, starts, words = letter_words(texts)
        scores, size = self.word_scores(words)
        sums = np.concatenate([np.zeros((1, len(self.langs))), np.cumsum(scores[at], axis=0)])
        n = np.concatenate([[0], np.cumsum(size[at])])
        n = n[starts[1:]] - n[starts[:-1]]
        return (sums[starts[1:]] - sums[starts[:-1]]) / np.maximum(n, 1)[:, None], n


    def calibrated(self, lang: str, h: np.ndarray, n: np.ndarray) -> None:
        """Sets what is usual in a language from cross-entropies of rows and their numbers of characters.

        A row's distance from the median shrinks with the root of its length; the spread is the 0.9 quantile of the
        distances so scaled. Neither moves much for a few wrong rows.
        """
        column = self.langs.index(lang)
        self.usual[column] = np.median(h)
        self.spread[column] = np.quantile(np.abs(h - self.usual[column]) * np.sqrt(n), LIKELY)

    def limits(self, column: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The highest cross-entropy that fits: 1.4 times the usual one, and three spreads for the length."""
        return (1 + SLACK) * self.usual[column] + SPREADS * self.spread[column] / np.sqrt(np.maximum(n, 1))


def trained(docs: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS) -> Models | None:
    """Models of every language in `lang` of the rows where `learn` holds, or None where there are none.

    Of each language about `sample_docs` documents are learnt from, all if there are fewer, chosen by a hash
    of doc_id and text; that bounds the counts that reach the driver. A fifth of them is left out of the counts
    and used to calibrate what is rejected (all, where fewer than 5 are left out). More than 1000 languages end
    the run with an error, since a model holds a column for each.
    """
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("there")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return None
    there = F.create_map(*[F.lit(x) for row in sizes for x in row])
    place = F.pmod(F.xxhash64(F.lit("learn"), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    left_out = F.pmod(F.xxhash64(F.lit("left out"), "doc_id", "text"), F.lit(LEFT_OUT)) == 0
    sample = rows.filter(place * F.element_at(there, F.col("lang")) < sample_docs).select("lang", "text", left_out.alias("left_out"))
    # Where a language has few documents, none is left out.
    few = [row.lang for row in sizes if min(row.there, sample_docs) < 5 * LEFT_OUT]
    learnt = sample.filter(~F.col("left_out") | F.col("lang").isin(few)).select("lang", "text")
    grams = learnt.mapInArrow(counted, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = grams.toPandas()
    if counts.empty:
        return None
    models = Models(counts)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1, CHUNK_BYTES):
            h, n = models.cross_entropies(batch.column(1))
            column = np.array([models.langs.index(x) if x in models.langs else -1 for x in batch.column(0).to_pylist()])
            known = (column >= 0) & (n > 0)
            yield pa.RecordBatch.from_pydict({"lang": batch.column(0).filter(pa.array(known)), "left_out": batch.column(2).filter(pa.array(known)), "h": h[known, column[known]], "n": n[known]})

    # Three numbers for each document of the sample.
    told = sample.select("lang", "text", "left_out").mapInArrow(own, "lang string, left_out boolean, h double, n long").toPandas()
    for lang, rows_of in told.groupby("lang"):
        apart = rows_of[rows_of["left_out"]]
        used = apart if len(apart) >= 5 else rows_of
        models.calibrated(lang, used["h"].to_numpy(), used["n"].to_numpy())
    return models


def scored(texts: pa.Array, models: Models | None) -> pa.StructArray:
    if models is None:
        h, n = np.full((len(texts), 1), np.inf), np.zeros(len(texts), np.int64)
        langs, allowed = ["und"], np.full(len(texts), np.inf)
    else:
        h, n = models.cross_entropies(texts)
        langs, allowed = models.langs, models.limits(h.argmin(axis=1), n)
    best = h.argmin(axis=1)
    lowest = h[np.arange(len(h)), best]
    spread = np.exp(-(h - lowest[:, None]) * np.minimum(n, 40)[:, None]) if models else np.ones_like(h)
    score = np.where(n > 0, 1 / spread.sum(axis=1), 0.0)
    lang = np.where(n > 0, np.array(langs, dtype=object)[best], "und")
    rejected = (n == 0) | (lowest > allowed)
    columns = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(lowest, pa.float64(), mask=n == 0), pa.array(rejected)]
    return pa.StructArray.from_arrays(columns, ["lang_pred", "score", "cross_entropy", "rejected"])


def predictions(batches: Iterator[pa.Array], models: Models | None) -> Iterator[pa.Array]:
    """PREDICTED of every text of each batch, scored in slices of CHUNK_BYTES."""
    for texts in batches:
        parts = [scored(part.column(0), models) for part in chunks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), 0, CHUNK_BYTES)]
        yield pa.concat_arrays(parts) if parts else pa.array([], PREDICTED_TYPE)


def identified(docs: DataFrame, models: Models | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of `docs`, then lang_pred, score, cross_entropy and rejected.

    Words are runs between ASCII white space, lower-cased, letters only; a word's characters are predicted
    from its own. The prediction is the language of the lowest cross-entropy per character, the first by
    name in a tie. `score` is its share among all languages if 40 characters (or all, if fewer) had that
    cross-entropy. A null text, one without letters, and any text without models give `und` with score 0
    and are rejected, and so is a text whose cross-entropy exceeds what the language's calibration allows at its
    length. Whole texts are scored; repeated rows get equal results; rows keep their number, an empty table gives
    none. Only texts go to Python; the other columns stay where they are.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return predictions(batches, models)

    small_batches(docs.sparkSession)
    found = F.arrow_udf(run, PREDICTED)(F.col("text"))
    return docs.select(*keep, found.alias("_found")).select(*keep, "_found.*")
