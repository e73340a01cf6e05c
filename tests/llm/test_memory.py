"""What a worker holds at a time, and how often tables are read."""

import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vacancyflow.llm import language, pieces, substrings, toxicity
from vacancyflow.llm.queries import PIECE_MODEL
from vacancyflow.llm.words import CHUNK_BYTES


def texts(n, words, seed=1):
    rng = random.Random(seed)
    known = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(5000)]
    return pa.array([" ".join(rng.choices(known, k=words)) for _ in range(n)])


def peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_language_is_scored_in_small_slices():
    given = texts(3000, 170)
    size = sum(len(x.as_py()) for x in given)
    assert CHUNK_BYTES < size < 2 * CHUNK_BYTES
    grams = pd.DataFrame([(lang, "".join(g)) for lang in ("de", "en", "es", "fr") for g in zip("abcdefg", "bcdefgh", "cdefghi", "defghij", strict=True)], columns=["lang", "gram"])
    models = language.Models(grams.assign(n=3))
    for lang in models.langs:
        models.calibrated(lang, np.array([2.0, 3.0]), np.array([50, 60]))
    seen, whole = [], language.Models.cross_entropies

    def scored(self, part):
        seen.append(sum(len(x) for x in part.to_pylist()))
        return whole(self, part)

    language.Models.cross_entropies = scored
    try:
        found = []
        for part in language.predictions(iter([given]), models):
            found += part.to_pylist()
    finally:
        language.Models.cross_entropies = whole
    assert max(seen) <= 1.1 * (1 << 20) and sum(seen) == size
    expected = language.scored(given, models).to_pylist()
    assert [x["lang_pred"] for x in found] == [x["lang_pred"] for x in expected]
    assert [x["cross_entropy"] for x in found] == pytest.approx([x["cross_entropy"] for x in expected])


def test_passages_hold_one_chunk():
    given = texts(1600, 600)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(given))), pa.array(np.zeros(len(given), np.int32)), given], ["id", "tag", "text"])
    most = 1 << 20
    parts = [peak(lambda: sum(1 for _ in substrings.dealt(iter([batch.slice(0, n)]), 64, 13, most))) for n in (250, 1600)]
    assert parts[1] < 1.15 * parts[0]


def test_pieces_come_in_chunks_of_a_megabyte(spark):
    given = texts(400, 1000)
    docs = spark.createDataFrame([(i, x.as_py()) for i, x in enumerate(given)], "doc_id long, text string").coalesce(1)
    found = pieces.encoded(docs, PIECE_MODEL, with_ids=False).select("doc_id", "pieces.*").collect()
    assert len(found) == 400 and all(r.parity and r.round_trip for r in found)
    assert pieces.CHUNK_BYTES <= 1 << 20


def test_toxicity_reads_the_documents_once_to_learn(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join([*rng.choices("abcdefgh", k=60), *["horridword"] * (6 * (i % 2))])) for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    marks = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    read = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.read.parquet(f"{tmp_path}/docs").mapInArrow(passed, "doc_id long, text string")
    model = toxicity.trained(docs, marks, F.lit(True))
    assert model is not None and read.value == len(rows)
