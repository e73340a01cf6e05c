"""Toxicity by compression distance: windows compressed with a toxic and an ordinary dictionary."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancyflow.llm.shared import staged
from vacancyflow.llm.words import chunks, split_words

WINDOW = 10
SHARED_BYTES = 4000
SAMPLE_DOCS = 2500
LEAST_EVIDENCE, LEAST_RATIO = 20.0, 20.0
CALIBRATION = 4  # of this many documents learnt from, one calibrates and chooses no segments
LOW, HIGH = -4, 9  # gains in bytes beyond these count as these


def segments(text: str) -> set[str]:
    """The lower-case words of a text and their beginnings of 5 to 11 characters."""
    words = set(text.lower().split())
    return words | {w[:k] for w in words for k in range(5, min(len(w), 12))}


def segment_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """segment, toxic and ordinary document counts of (text, toxic)."""
    for batch in chunks(batches, 0):
        seen = [Counter(), Counter()]
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen[toxic].update(segments(text or ""))
        keys = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_pydict({"segment": pa.array(keys, pa.string()), "toxic": pa.array([seen[1][k] for k in keys], pa.int64()), "ordinary": pa.array([seen[0][k] for k in keys], pa.int64())})


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, the words before and after it, toxic: each once in a batch of (text, toxic)."""
    for batch in chunks(batches, 0):
        seen = set()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = (text or "").lower().split()
            seen.update(zip(words, ["", *words], [*words[1:], ""], [toxic] * len(words)))
        columns = list(zip(*seen)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in columns[:3]], pa.array(columns[3], pa.int32())], ["word", "before", "after", "toxic"])


def counted(sample: DataFrame) -> DataFrame:
    """segment, toxic, ordinary of (text, toxic): the documents with a segment, at most its different contexts.

    A context is a word with its neighbours. Copies of a text share theirs, so however many there are, their
    words do not pass for marks of the label.
    """
    there = sample.mapInArrow(segment_counts, "segment string, toxic long, ordinary long")
    there = there.groupBy("segment").agg(F.sum("toxic").alias("toxic_docs"), F.sum("ordinary").alias("ordinary_docs"))
    places = sample.mapInArrow(contexts, "word string, before string, after string, toxic int").distinct()
    places = places.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("ordinary"))
    size = F.length("word")
    starts = F.transform(F.sequence(F.lit(5), F.least(size - 1, F.lit(11))), lambda k: F.left("word", k))
    segment = F.explode(F.concat(F.array("word"), F.when(size > 5, starts).otherwise(F.array().cast("array<string>"))))
    places = places.select(segment.alias("segment"), "toxic", "ordinary").groupBy("segment").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    labels = [F.least(name, f"{name}_docs").alias(name) for name in ("toxic", "ordinary")]
    return there.join(places, "segment").select("segment", *labels)


def evidence(a: int, b: int, toxic: int, ordinary: int) -> float:
    """Signed likelihood ratio statistic of a segment in `a` of `toxic` and `b` of `ordinary` documents."""

    def fit(k: int, n: int, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n > k else 0.0)

    p = (a + b) / (toxic + ordinary)
    value = 2 * (fit(a, toxic, a / toxic) + fit(b, ordinary, b / ordinary) - fit(a, toxic, p) - fit(b, ordinary, p))
    return value if a * ordinary > b * toxic else -value


def chosen(ranked: list[str]) -> list[str]:
    """The segments that none before them contains."""
    out, present = [], ""
    for segment in ranked:
        if segment not in present:
            out.append(segment)
            present += " " + segment
    return out


@dataclass
class Classifier:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray | None = None  # log likelihood ratio of a window's gain
    slope: float = 1.0
    offset: float = 0.0

    def compressors(self) -> list:
        import zstandard

        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_BTULTRA, min_match=3, window_log=max(13, math.ceil(math.log2(2 * len(self.toxic) + 4096))),
            hash_log=14, chain_log=14, search_log=6, target_length=64, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        dictionaries = [zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for x in (self.ordinary, self.toxic)]
        return [zstandard.ZstdCompressor(dict_data=d, compression_params=settings) for d in dictionaries]

    def gains(self, texts: pa.Array, tools: list) -> np.ndarray:
        """Per text, how many of its windows the toxic dictionary makes shorter by LOW .. HIGH bytes.

        A text's windows are its words, WINDOW at a time, lower-cased, each word in exactly one.
        """
        values, starts = split_words(pc.utf8_lower(pc.fill_null(texts, "")))
        n = np.diff(starts)
        windows = -(-n // WINDOW)
        first = np.repeat(starts[:-1], windows) + WINDOW * (np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows))
        bounds = pa.array(np.append(first, len(values)).astype(np.int32))
        joined = pc.binary_join(pa.ListArray.from_arrays(bounds, values), " ").to_pylist()
        ordinary, toxic = (tool.compress for tool in tools)
        gain = np.fromiter((len(ordinary(w)) - len(toxic(w)) for w in map(str.encode, joined)), np.int64, len(joined))
        column = np.repeat(np.arange(len(n)), windows) * (HIGH - LOW + 1) + np.clip(gain, LOW, HIGH) - LOW
        return np.bincount(column, minlength=len(n) * (HIGH - LOW + 1)).reshape(len(n), -1)

    def calibrate(self, counts: np.ndarray, toxic: np.ndarray, share: float) -> None:
        """Window weights from the labelled documents' gains; slope and offset by logistic regression in which
        toxic documents weigh `share` of all."""
        # A document longer than the median one weighs as much as that, so no long one sets the weights.
        windows = np.maximum(counts.sum(axis=1), 1)
        seen = counts * np.minimum(1, np.median(windows) / windows)[:, None]
        a, b = seen[toxic].sum(axis=0) + 0.5, seen[~toxic].sum(axis=0) + 0.5
        self.weights = np.log(a / a.sum()) - np.log(b / b.sum())
        # A larger gain is no weaker evidence; the largest may not occur among these documents.
        self.weights[1 - LOW :] = np.maximum.accumulate(self.weights[1 - LOW :])
        x = np.stack([counts @ self.weights, np.ones(len(counts))], axis=1)
        w = np.where(toxic, share / toxic.sum(), (1 - share) / (~toxic).sum()) * len(toxic)
        beta = np.array([0.5, math.log(share / (1 - share))])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            hessian = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-3])
            beta = beta + np.clip(np.linalg.solve(hessian, x.T @ (w * (toxic - p)) - 1e-3 * beta), -1, 1)
        # A text without evidence is never predicted toxic, however many toxic documents were learnt from.
        self.slope, self.offset = float(beta[0]), min(float(beta[1]), -0.01)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(counts @ self.weights * self.slope + self.offset, -30, 30)))


def trained(docs: DataFrame, labels: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS) -> Classifier | None:
    """A classifier from the rows of `labels(doc_id, toxic)` where `learn` holds, or None without both labels.

    About `sample_docs` toxic and twice as many ordinary documents are learnt from, all if there are fewer,
    chosen by a hash of doc_id; that bounds all that reaches the driver. Labels other than 0 and 1 teach nothing;
    a document labelled both ways is learnt as both, repeated rows each count.

    The toxic dictionary holds every segment that toxic documents have LEAST_RATIO times as often as ordinary
    ones, two standard deviations on the safe side, whatever their number and bytes. Both dictionaries end with
    the same SHARED_BYTES of the commonest other segments; before them the ordinary one holds nothing that could
    match, so what differs in a window's lengths is what marks toxic text. Weights are calibrated on documents
    that chose no segment.
    """
    told = labels.filter(learn & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    there = {row.toxic: row.n for row in told.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(there) < 2:
        return None
    bound = F.when(F.col("toxic") == 1, sample_docs / there[1]).otherwise(2 * sample_docs / there[0])
    place = F.pmod(F.xxhash64(F.lit("learn"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # Some thousands of ids by `sample_docs`, so they go to the documents and not the other way round.
    choosing = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(CALIBRATION)) > 0
    told = told.filter(place < bound).withColumn("choosing", choosing)
    # Stored, so that the documents are read once for it and not for each count.
    sample = staged(docs.select("doc_id", "text").join(F.broadcast(told), "doc_id").select("text", "toxic", "choosing"))
    texts = sample.filter("choosing").select("text", "toxic")
    toxic, ordinary = texts.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not toxic or not ordinary:
        return None
    found = counted(texts).persist(StorageLevel.DISK_ONLY)
    a, b = F.col("toxic"), F.col("ordinary")
    marked = (a - 2 * F.sqrt(a)) / toxic > LEAST_RATIO * (b + 2 * F.sqrt(b) + 2) / ordinary
    marks = {r.segment: evidence(r.toxic, r.ordinary, toxic, ordinary) for r in found.filter(marked).collect()}
    best = sorted((s for s in marks if marks[s] > LEAST_EVIDENCE), key=lambda s: (-round(marks[s], 1), -len(s), s))
    # More of the commonest segments than are kept, as some mark a label and some are part of others.
    frequent = found.filter(~marked).orderBy((a + b).desc(), "segment").limit(SHARED_BYTES).collect()
    found.unpersist()
    shared, size = [], 0
    for segment in chosen([r.segment for r in frequent if abs(evidence(r.toxic, r.ordinary, toxic, ordinary)) <= LEAST_EVIDENCE]):
        size += len(segment.encode()) + 1
        if size > SHARED_BYTES:
            break
        shared.append(segment)
    # What is most useful stands last, nearest to the window.
    ends = " ".join(shared[::-1]).encode()
    own = " ".join([*chosen(best)[::-1], ""]).encode()
    made = Classifier(own + ends, b"\0" * len(own) + ends)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = made.compressors()
        for batch in chunks(batches, 0):
            counts = made.gains(batch.column(0), tools)
            yield pa.RecordBatch.from_pydict({"counts": pa.array(list(counts), pa.list_(pa.int64())), "toxic": batch.column(1).cast(pa.int32())})

    rows = sample.filter("not choosing").select("text", "toxic").mapInArrow(seen, "counts array<long>, toxic int").toPandas()
    if rows["toxic"].nunique() < 2:  # too few to be split
        rows = texts.mapInArrow(seen, "counts array<long>, toxic int").toPandas()
    made.calibrate(np.stack(rows["counts"].to_numpy()), rows["toxic"].to_numpy() == 1, there[1] / (there[0] + there[1]))
    return made


def scored(docs: DataFrame, model: Classifier | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of `docs`, then score (0 to 1) and predicted (1 from 0.5 on).

    The score sums the calibrated weights of all windows of the whole text. Null and empty texts have no
    window and get the score of no evidence, which is below 0.5. Without a model every score is 0. Rows keep
    their number.
    """
    count = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.compressors() if model else None
        for batch in chunks(batches, count):
            score = model.scores(model.gains(batch.column(count), tools)) if model else np.zeros(batch.num_rows)
            columns = [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(count)], *columns], [*keep, "score", "predicted"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, "text").mapInArrow(run, f"{kept}, score double, predicted int")
