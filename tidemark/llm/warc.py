"""WARC archives: writing, reading, and reassembly of segmented records.

Reassembly groups a response with its continuation records by origin identifier,
orders them by segment number, verifies that every number and the total length
are there, and decodes the chunked transfer framing.

Defined cases: a null html is an empty payload; a null page id or url is written
as an absent header and read back as null; rows that share the page id and the
payload of a response are responses too; an empty table gives no archive and no
row; columns besides page_id, url and html are not archived. A record with a gap, a
wrong total or a broken chunk, with a cut header or block, or without a length has a
null payload and says so in ``error``; so does an archive that cannot be unpacked to its
end or has bytes outside of records. An archive is one gzip stream, as Spark's writer
makes it; archives with a stream a record are read as well.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir

#: Bytes of a segment's block, of an HTTP chunk and of an archive; and the least payload that is deduplicated.
SEGMENT, CHUNK, ARCHIVE, REVISIT_FROM = 16384, 4096, 4 << 20, 1000
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_RECORD = "record_id string, type string, page_id long, url string, refers_to long, digest string, payload_bytes long, origin string, number int, total long, block binary, error string"


def revisits(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with digest, payload_bytes and refers_to (null for a response)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.sha2(html.cast("binary"), 256).alias("same"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long"))
    keys = pages.select(F.col("page_id").cast("long").alias("p"), F.sha2(html.cast("binary"), 256).alias("same"), F.octet_length(html).alias("n"))
    keys = keys.where(F.col("n") >= REVISIT_FROM).groupBy("same").agg(F.max("p").alias("last"), F.count("*").alias("copies")).where("copies > 1 and last is not null")
    joined = rows.join(keys.select("same", "last"), "same", "left")
    other = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "html", "digest", "payload_bytes", F.when(other, F.col("last")).alias("refers_to"))


def _cuts(body: bytes, size: int) -> list[bytes]:
    """Pieces of at most ``size`` bytes (a character's length at least), cut between UTF-8 characters."""
    out, at = [], 0
    while at < len(body):
        to = min(len(body), at + size)
        while to < len(body) and body[to] & 0xC0 == 0x80 and to > at + 1:
            to -= 1
        out.append(body[at:to])
        at = to
    return out


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {' '.join(str(v).splitlines())}" for k, v in headers if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def records_of(record_id: str, page_id, url, payload: bytes, digest: str, refers_to, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    common = [("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", url), ("X-Page-Id", page_id), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", len(payload))]
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id), *common, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page", refers_to), ("Content-Type", "application/http;msgtype=response")], b"HTTP/1.1 200 OK\r\n\r\n")
        return
    body = b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in _cuts(payload, CHUNK)) + b"0\r\n\r\n"
    parts = _cuts(_HEAD + body, segment)
    for n, part in enumerate(parts, 1):
        named = [("WARC-Type", "response"), ("WARC-Record-ID", record_id)] if n == 1 else [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{record_id[:-1]}.{n}>"), ("WARC-Segment-Origin-ID", record_id)]
        many = [("WARC-Segment-Number", n)] if len(parts) > 1 else []
        total = [("WARC-Segment-Total-Length", sum(map(len, parts)))] if n == len(parts) > 1 else []
        yield _record([*named, *(common if n == 1 else common[:1]), *many, *total, ("Content-Type", "application/http;msgtype=response")], part)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to whole archives of bounded size; a long page may run over into the next."""
    parts: list[bytes] = []
    size, n, task = 0, 0, TaskContext.get().partitionId()

    def archive() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary()).cast(pa.string())], ["value"])

    for batch in batches:
        for row in range(batch.num_rows):
            page_id, url, html, digest, refers_to = (batch.column(i)[row].as_py() for i in range(5))
            n += 1
            ident = f"<urn:uuid:{uuid.UUID(int=(task << 64) + n)}>"
            for record in records_of(ident, page_id, url, html.encode(), digest, refers_to):
                if parts and size + len(record) > ARCHIVE:
                    yield archive()
                    parts, size = [], 0
                parts.append(record)
                size += len(record)
    if parts:
        yield archive()


def write_archives(pages: DataFrame, path: str) -> None:
    """Write pages as gzip-compressed archives, one bounded file each, through Spark's own writer."""
    rows = revisits(pages).select("page_id", "url", "html", "digest", "refers_to")
    rows.mapInArrow(_build, "value string").write.option("maxRecordsPerFile", 1).option("compression", "gzip").mode("overwrite").text(path)


def unpacked(data: bytes) -> tuple[bytes, str | None]:
    """An archive's bytes, as far as they can be had, and what is wrong with it."""
    if data[:2] != b"\x1f\x8b":
        return data, None
    out = []
    while data:
        stream = zlib.decompressobj(wbits=31)
        try:
            out.append(stream.decompress(data))
        except zlib.error as e:
            return b"".join(out), f"archive is broken: {e}"
        if not stream.eof:
            return b"".join(out), "archive is cut"
        data = stream.unused_data
    return b"".join(out), None


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """(headers in lower case, block, error) of each record of one archive's bytes."""
    at = 0
    while at < len(data):
        begin = data.find(b"WARC/", at)
        if data[at : begin if begin >= 0 else len(data)].strip(b"\r\n"):
            yield {}, b"", "bytes outside of a record"
        if begin < 0:
            return
        end = data.find(b"\r\n\r\n", begin)
        lines = data[begin : end if end >= 0 else len(data)].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        if end < 0:
            yield headers, b"", "header is cut"
            return
        size = headers.get("content-length", "")
        if not (size.isascii() and size.isdigit()):
            yield headers, b"", "record has no length"
            at = data.find(b"WARC/", end)
            if at < 0:
                return
            continue
        block = data[end + 4 : end + 4 + int(size)]
        yield headers, block, None if len(block) == int(size) else "block is cut"
        at = end + 4 + int(size)


def _row(headers: dict[str, str], block: bytes, error: str | None) -> tuple:
    def whole(name: str) -> int | None:
        nonlocal error
        text = headers.get(name)
        if text is None:
            return None
        if text.removeprefix("-").isascii() and text.removeprefix("-").isdigit() and abs(int(text)) < 2**31 << 32 * (name != "warc-segment-number"):
            return int(text)
        error = error or f"{name} is no number"
        return None

    number = whole("warc-segment-number")
    named = headers.get("warc-record-id")
    origin = headers.get("warc-segment-origin-id") or (named if number is not None else None)
    digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
    found = (named, headers.get("warc-type"), whole("x-page-id"), headers.get("warc-target-uri"), whole("x-refers-to-page"), digest, whole("x-payload-length"), origin, number, whole("warc-segment-total-length"), block)
    return (*found, error)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in _RECORD.split(", ")]
    for batch in batches:
        for data in batch.column(0):
            raw, error = unpacked(data.as_py())
            rows = [_row(*x) for x in parse(raw)]
            if error:
                rows.append(_row({}, b"", error))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``; origin and number are set for segments only."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, _RECORD)


def decode_chunked(block: bytes) -> bytes:
    """Payload of an HTTP message; ValueError where the chunk framing is broken."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no end of HTTP headers")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size line is cut")
        size = int(body[at:end].partition(b";")[0], 16)
        at = end + 2
        if size < 0:
            raise ValueError("chunk size is negative")
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut")
        out.append(body[at : at + size])
        at += size + 2


def join_segments(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """One block of (number, total, block) segments in any order, repeated ones once."""
    by = {n: (total, block) for n, total, block in sorted(segments, key=lambda x: (x[0], x[1] or 0))}
    if sorted(by) != list(range(1, len(by) + 1)):
        raise ValueError("segment numbers have a gap")
    whole = b"".join(by[n][1] for n in sorted(by))
    if (total := by[len(by)][0]) is None:
        raise ValueError("last segment is missing")
    if total != len(whole):
        raise ValueError(f"{len(whole)} bytes, {total} announced")
    return whole


_OUT = "record_id string, type string, page_id long, url string, refers_to long, digest string, payload_bytes long, payload binary, error string"
_SLIM = _OUT.replace("payload binary, ", "")


def _finish(meta: list, block: bytes | None, error: str | None, keep: bool) -> list:
    """meta: record_id, type, page_id, url, refers_to, digest, payload_bytes."""
    payload = None
    if meta[1] == "response" and not error:
        try:
            payload = decode_chunked(block)
        except ValueError as e:
            error = str(e)
        else:
            found = hashlib.sha1(payload).hexdigest()
            if meta[5] and meta[5] != found:
                payload, error = None, "payload digest differs"
            meta[5:7] = [found, len(payload)] if payload is not None else meta[5:7]
    return [*meta, *([payload] if keep else []), error]


def _rows(rows: list[list], keep: bool) -> pa.RecordBatch:
    fields = [x.split() for x in (_OUT if keep else _SLIM).split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])


def reassemble(records: DataFrame, keep_payload: bool = True) -> DataFrame:
    """A row per logical record: its headers, payload (if kept) and error. Only segments are shuffled."""

    def single(batches):
        for batch in batches:
            if batch.num_rows:
                yield _rows([_finish([batch.column(i)[r].as_py() for i in range(7)], *(batch.column(i)[r].as_py() for i in (7, 8)), keep_payload) for r in range(batch.num_rows)], keep_payload)

    def grouped(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        heads = [r for r in rows if r["type"] == "response"]
        head = heads[0] if heads else rows[0]
        meta = [head[c] for c in ("record_id", "type", "page_id", "url", "refers_to", "digest", "payload_bytes")]
        if not heads:
            return pa.Table.from_batches([_rows([_finish(meta, None, "first segment is missing", keep_payload)], keep_payload)])
        if broken := next((r["error"] for r in rows if r["error"]), None):
            return pa.Table.from_batches([_rows([_finish(meta, None, broken, keep_payload)], keep_payload)])
        try:
            block, error = join_segments([(r["number"], r["total"], r["block"]) for r in rows]), None
        except ValueError as e:
            block, error = None, str(e)
        return pa.Table.from_batches([_rows([_finish(meta, block, error, keep_payload)], keep_payload)])

    schema = _OUT if keep_payload else _SLIM
    whole = records.where("origin is null").select("record_id", "type", "page_id", "url", "refers_to", "digest", "payload_bytes", "block", "error").mapInArrow(single, schema)
    split = records.where("origin is not null").groupBy("origin").applyInArrow(grouped, schema)
    return whole.unionByName(split)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and reassemble them."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return reassemble(read_records(spark, path), keep_payload=False)
