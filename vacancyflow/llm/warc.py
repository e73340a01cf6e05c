"""WARC archives: written with revisit records, read back with salvage of what damage leaves."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancyflow.llm.shared import shared_folder

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
PIECE = 16 << 10
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER, VERSION = b"\x1f\x8b\x08", b"WARC/1."
NEXT_START = re.compile(re.escape(MEMBER) + b"|" + re.escape(VERSION))

MANIFEST = "archive string, records long, bytes long"
READ = (
    "archive string, offset long, length long, inside long, kind string, reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"
)


# Writing ----------------------------------------------------------------------
def with_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, payload_digest and refers_to of every row of `pages(page_id, url, html, ...)`.

    Of pages with equal payloads of `least_bytes` or more, those with the largest page_id are responses and
    refers_to names it for the others. A null page_id is smaller than any other; pages that all have none
    are responses, and so is every copy of the row with the largest page_id. Null html is an empty payload.
    Only digests are grouped; a digest that many pages share is reduced before the shuffle.
    """
    html = F.coalesce("html", F.lit(""))
    told = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("payload_digest"))
    large = told.filter(F.octet_length("html") >= least_bytes).select("page_id", "payload_digest")
    largest = large.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    largest = largest.filter("n > 1 and refers_to is not null").drop("n")
    later = large.join(largest, "payload_digest").filter("page_id is null or page_id < refers_to").distinct()
    later = later.withColumnsRenamed({"page_id": "of_page", "payload_digest": "of_digest"})
    same = F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("payload_digest") == F.col("of_digest"))
    return told.join(later, same, "left").drop("of_page", "of_digest")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, with the length of the full payload, and no payload."""
    named = "" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{named}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def compressed(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def opened(folder: str) -> tuple:
    """The file system and path of a folder that driver and executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def write_archives(
    pages: DataFrame,
    folder: str,
    least_bytes: int = REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "2024-01-01T00:00:00Z",
    level: int = 1,
) -> DataFrame:
    """Writes gzip archives of `pages` below `folder`, one member per record, and returns their manifest.

    A task rolls to the next archive beyond `archive_bytes` and holds one archive in memory at most. Names
    and contents follow from the sorted partition alone, and files appear by a rename, so a task that is
    run again after a lost executor replaces its archives by equal ones.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        task, held, size, made, records = TaskContext.get(), [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, size, made, records
            name = f"pages-{task.partitionId():06d}-{made:05d}.warc.gz"
            with store.open_output_stream(f"{base}/.{name}-{task.taskAttemptId()}") as out:
                out.writelines(held)
            store.move(f"{base}/.{name}-{task.taskAttemptId()}", f"{base}/{name}")
            row = pa.RecordBatch.from_pydict({"archive": [name], "records": [records], "bytes": [size]})
            held, size, made, records = [], 0, made + 1, 0
            return row

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                page_id, url, html, digest, refers_to = row
                member = compressed(record(page_id, url, html.encode(), digest, refers_to, date), level)
                held.append(member)
                size += len(member)
                records += 1
                if size >= archive_bytes:
                    yield close()
        if held:
            yield close()

    store, base = opened(folder)
    store.create_dir(base, recursive=True)
    rows = with_revisits(pages, least_bytes).select("page_id", "url", "html", "payload_digest", "refers_to")
    manifest = rows.sortWithinPartitions("page_id", "payload_digest", "url").mapInArrow(put, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


# Reading ----------------------------------------------------------------------
class Damaged(ValueError):
    """Bytes that are no valid record."""


def plain_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at `at`, with its checks."""
    if not data.startswith(VERSION, at):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("header not ended")
    headers = {}
    for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("bad header line")
        headers[name.strip().lower()] = value.strip()
    if not headers.get("content-length", "").isdigit():
        raise Damaged("no content length")
    start = end + 4
    stop = start + int(headers["content-length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("record not ended")
    block = data[start:stop]
    told = headers.get("warc-block-digest", "")
    if told.startswith("sha1:") and told[5:] != base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise Damaged("block digest differs")
    return headers, block, stop + 4


def inflated(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at `at` holds, as far as it can be read, where it ends or fails, and why it fails.

    The member is fed in pieces, so what follows it is not copied. Where a piece fails, it is fed again byte by
    byte, so that everything before the damage is kept.
    """
    unpacker, out = zlib.decompressobj(31), []
    view = memoryview(data)
    while not unpacker.eof and at < len(data):
        piece, before = view[at : at + PIECE], unpacker.copy()
        try:
            out.append(unpacker.decompress(piece))
        except zlib.error:
            for i in range(len(piece)):
                try:
                    out.append(before.decompress(piece[i : i + 1]))
                except zlib.error:
                    return b"".join(out), at + i, "bad member"
        at += len(piece)
    if not unpacker.eof:
        return b"".join(out), at, "member not ended"
    return b"".join(out), at - len(unpacker.unused_data), None


def inner_records(text: bytes) -> Iterator[tuple]:
    """("record", place, length, headers, block) and ("gap", place, length, reason, None) of an inflated member:
    after a failed check the search goes on at the next version line."""
    at, gap, why = 0, -1, ""
    while at < len(text):
        try:
            headers, block, end = plain_record(text, at)
        except Damaged as error:
            if gap < 0:
                gap, why = at, str(error)
            after = text.find(VERSION, at + 1)
            at = after if after >= 0 else len(text)
            continue
        if gap >= 0:
            yield "gap", gap, at - gap, why, None
            gap = -1
        yield "record", at, end - at, headers, block
        at = end
    if gap >= 0:
        yield "gap", gap, len(text) - gap, why, None


def salvaged(data: bytes) -> Iterator[tuple]:
    """("record", offset, length, headers, block, inside) and ("gap", offset, length, reason, None, inside), in order.

    After a failed check the next member or version line that holds valid records is looked for; the bytes
    up to there are one gap, with the first reason. A record or gap of a member has the member's offset; `inside`
    is its place in the inflated member, and the length of such a gap counts inflated bytes. A member that
    can't be read to its end gives the valid records before its damage, and a gap from the damage on.
    """
    at, gap, why = 0, -1, ""
    while at < len(data):
        if data.startswith(MEMBER, at):
            text, stop, fault = inflated(data, at)
            found = [(kind, at, stop - at if kind == "record" else size, told, block, place) for kind, place, size, told, block in inner_records(text)]
        else:
            try:
                headers, block, stop = plain_record(data, at)
                found, fault = [("record", at, stop - at, headers, block, None)], None
            except Damaged as error:
                found, stop, fault = [], at, str(error)
        valid = any(x[0] == "record" for x in found)
        if gap >= 0 and (valid or fault is None):
            yield "gap", gap, at - gap, why, None, None
            gap = -1
        if valid or fault is None:
            yield from found
        if fault is None:
            at = stop
            continue
        after = NEXT_START.search(data, at + 1)
        following = after.start() if after else len(data)
        if gap < 0:
            gap, why = min(stop, following) if valid else at, fault
        at = following
    if gap >= 0 and gap < len(data):
        yield "gap", gap, len(data) - gap, why, None, None


def fields(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    """record_type, record_id, target_uri, refers_to, payload_bytes, payload_digest, payload of a record."""
    kind = headers.get("warc-type")
    head, _, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
    if kind == "revisit":
        told = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        size = int(told[1]) if told else None
        text = headers.get("warc-payload-digest", "")
        digest = base64.b32decode(text[5:]).hex() if text.startswith("sha1:") else None
        payload = None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    named = [headers.get(k, "").strip("<>") or None for k in ("warc-record-id", "warc-refers-to")]
    return kind, named[0], headers.get("warc-target-uri"), named[1], size, digest, payload if payloads else None


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Every record and every quarantined gap of the archives in `folder`, gzip or plain.

    `kind` is record or gap; a gap has offset, length, reason and, within a member, `inside`. Bytes and digest
    of a response are taken from its payload; a revisit has those that its headers tell. An empty file gives
    no row, a file without any valid record one gap. Each archive is read whole by one task, and a member is
    inflated whole: an archive of 2 GB or more ends the read with an error, so large crawls are cut into archives
    as `write_archives` does.
    """

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("inside", pa.int64())]
            + [(n, pa.string()) for n in ("kind", "reason", "record_type", "record_id", "target_uri", "refers_to")]
            + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
        )
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                name, rows, size = path.as_py().rpartition("/")[2], [], 0
                for kind, at, length, told, block, inside in salvaged(content.as_py() or b""):
                    row = fields(told, block, payloads) if kind == "record" else (None,) * 7
                    rows.append((name, at, length, inside, kind, told if kind == "gap" else None, *row))
                    size += len(block or b"") if payloads else 0
                    if len(rows) >= 4096 or size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    return files.select("path", "content").mapInArrow(take, READ)


def round_trip(pages: DataFrame, folder: str | None = None, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Writes `pages` to archives and returns what `read_archives` finds there."""
    folder = folder or shared_folder(pages.sparkSession)
    write_archives(pages, folder, least_bytes)
    return read_archives(pages.sparkSession, folder)
