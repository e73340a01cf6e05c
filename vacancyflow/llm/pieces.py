"""SentencePiece models on the tokenizers library: encoding, decoding and a check of parity."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vacancyflow.llm.shared import small_batches
from vacancyflow.llm.words import chunks, give_back

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format
MARK = "▁"
CHUNK_BYTES = 1 << 20
SLICE_CHARS = 1 << 17


# The model file ---------------------------------------------------------------
def wire(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protobuf message: ints, 4 or 8 raw bytes, or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind in (1, 2, 5):
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {kind}")


def parsed(model: bytes) -> dict:
    """Pieces (text, score, type), model type (1 unigram, 2 BPE), byte fallback and normaliser of a model file."""
    out = {"pieces": [], "type": 1, "byte_fallback": False, "charsmap": b"", "dummy_prefix": True, "extra_spaces": True, "escape": True, "suffix": False}
    for field, value in wire(model):
        if field == 1:
            piece = dict(wire(value))
            score = float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
            out["pieces"].append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif field == 2:
            trainer = dict(wire(value))
            out |= {"type": trainer.get(3, 1), "byte_fallback": bool(trainer.get(35, 0)), "suffix": bool(trainer.get(24, 0))}
        elif field == 3:
            norm = dict(wire(value))
            out |= {"charsmap": norm.get(2, b""), "dummy_prefix": bool(norm.get(3, 1)), "extra_spaces": bool(norm.get(4, 1)), "escape": bool(norm.get(5, 1))}
    if out["suffix"] or not out["escape"] or out["type"] not in (1, 2):
        raise ValueError("only unigram and BPE models with white space as a leading mark are read")
    out["merges"] = merges(out["pieces"]) if out["type"] == 2 else []
    return out


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every way to make a piece of two, by the score of the piece made: the order in which BPE merges."""
    scores = {p: s for p, s, kind in pieces if kind in (NORMAL, USER, UNUSED)}
    found = [(-score, i, p[:cut], p[cut:]) for i, (p, score) in enumerate(scores.items()) for cut in range(1, len(p)) if p[:cut] in scores and p[cut:] in scores]
    return [(a, b) for _, _, a, b in sorted(found)]


def slices(texts: list[str], most: int) -> Iterator[list[str]]:
    """Consecutive texts of about `most` characters together; a longer one is a slice of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield texts[start:i]
            start, size = i, 0
        size += len(text)
    if texts:
        yield texts[start:]


class Pieces:
    """Encoder and decoder of one model.

    A text is normalised, spaces become marks, one is put in front, and whole texts are encoded in
    multithreaded batches, without a cache: what a worker holds is one batch. Ids travel as int32 bytes.
    """

    def __init__(self, model: bytes, spec: dict, threads: int = 2) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))  # of the tokenizers library
        import sentencepiece
        from tokenizers import Tokenizer, models, normalizers

        self.spec, self.threads = spec, threads
        pieces = [p[0] for p in spec["pieces"]]
        ids = {p: i for i, p in enumerate(pieces)}
        unknown = next((i for i, p in enumerate(spec["pieces"]) if p[2] == UNKNOWN), 0)
        if spec["type"] == 1:
            core = models.Unigram([(p, s) for p, s, _ in spec["pieces"]], unk_id=unknown, byte_fallback=spec["byte_fallback"])
        else:
            core = models.BPE(vocab=ids, merges=spec["merges"], unk_token=pieces[unknown], fuse_unk=True, byte_fallback=spec["byte_fallback"])
        self.tokenizer = Tokenizer(core)
        self.charsmap = normalizers.Precompiled(spec["charsmap"]) if spec["charsmap"] else None
        kinds = [p[2] for p in spec["pieces"]]
        self.table = pa.array([bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode() for p, k in zip(pieces, kinds, strict=True)], pa.large_binary())
        self.peer = sentencepiece.SentencePieceProcessor(model_proto=model)

    def normalised(self, text: str) -> str:
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if self.spec["extra_spaces"]:
            text = re.sub(" +", " ", text.strip(" "))
        if text and self.spec["dummy_prefix"]:
            text = " " + text
        return text.replace(" ", MARK)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool, str]]:
        """The ids of each text, whether the model's own library, given the whole text, gives the same, and the normalised text."""
        normal = [self.normalised(x) for x in texts]
        out = []
        for part in slices(normal, SLICE_CHARS):
            # What the libraries return is far larger than the ids, so only ids are kept of each slice.
            mine = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            theirs = self.peer.encode(texts[len(out) : len(out) + len(part)], num_threads=self.threads)
            out += [(np.array(a, np.int32), a == b, x) for a, b, x in zip(mine, theirs, part, strict=True)]
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The texts of the ids, looked up for all at once; bytes that are no UTF-8 become the replacement character."""
        starts = np.cumsum([0, *map(len, ids)])
        found = self.table.take(pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
        places = np.frombuffer(found.buffers()[1], np.int64)[starts]
        data = memoryview(found.buffers()[2] or b"")
        texts = [str(data[a:b], "utf-8", "replace") for a, b in zip(places[:-1], places[1:], strict=True)]
        return [x[1:] if self.spec["dummy_prefix"] and x.startswith(" ") else x for x in texts]

    def expected(self, normal: str) -> str:
        """What decoding gives back: the normalised text, without the mark put in front."""
        text = normal.replace(MARK, " ")
        return text[1:] if self.spec["dummy_prefix"] else text


def encoded(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", with_ids: bool = True) -> DataFrame:
    """The columns `keep` of `docs`, then ids, n_tokens, ids_sha256 (of the ids as little-endian int32), decoded
    (null if equal to the text), round_trip and parity, in a struct column `pieces`.

    `model_path` is read by the driver and travels with the job. `round_trip` tells whether decoding the ids
    gives the normalised text, which is the text itself under a model without normalisation; `parity`
    whether the model's own library gives the same ids. Null and empty texts have no ids and both flags
    true. Whole texts are encoded; rows keep their columns and number. A mark character in a text stands
    for a space, as in the model format; such a text decodes to spaces.
    """
    small_batches(docs.sparkSession)
    with open(model_path, "rb") as file:
        model = file.read()
    spec = parsed(model)

    # A function for each chunk: nothing of it is held while the next is encoded.
    def coded(batch: pa.RecordBatch, coder: Pieces) -> pa.RecordBatch:
        texts = [x or "" for x in batch.column(len(keep)).to_pylist()]
        rows = []
        told = coder.encode(texts)
        backs = coder.decode([x[0] for x in told])
        for original, back, (ids, same, normal) in zip(texts, backs, told, strict=True):
            rows.append((ids if with_ids else None, len(ids), hashlib.sha256(ids).hexdigest(), None if back == original else back, back == coder.expected(normal), same))
        ids, *rest = zip(*rows, strict=True)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
        names = ("ids", "n_tokens", "ids_sha256", "decoded", "round_trip", "parity")
        columns = [pa.array(ids, pa.list_(pa.int32())), *[pa.array(c, t) for c, t in zip(rest, kinds, strict=True)]]
        return pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.StructArray.from_arrays(columns, names)], [*keep, "pieces"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Pieces(model, spec)
        for batch in chunks(batches, len(keep), CHUNK_BYTES):
            yield coded(batch, coder)
        # The worker goes on to other stages.
        del coder
        give_back()

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    pieces = "struct<ids: array<int>, n_tokens: bigint, ids_sha256: string, decoded: string, round_trip: boolean, parity: boolean>"
    return docs.select(*keep, text).mapInArrow(run, f"{kept}, pieces {pieces}")
