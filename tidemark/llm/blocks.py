"""Pieces and key blocks: a compact exchange of many hashed keys.

Documents are packed into pieces of a few MB. A piece asks about its distinct keys
by one block per bucket (a row of sorted packed keys instead of a row per key), and
a bucket answers each block with one bit per key. Piece ids come from the content,
so a recomputed piece finds its answers, and a piece without answers fails loudly.
Buckets grow in number with the text, so that each stays within a task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_bytes
from .words import U, mix

#: Text bytes of a piece, and text bytes for which one bucket is added.
PIECE, BUCKET = 4 << 20, 8 << 20
ASK = "bucket int, piece_id long, level int, payload binary"
ANSWER = "piece_id long, level int, bucket int, bits binary"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(piece_id, payload): compressed runs of (doc_id, text) rows, a null text as an empty one."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(pa.Table.from_batches(held).combine_chunks())
            payload = sink.getvalue()
            return pa.RecordBatch.from_arrays([pa.array([_signed(xxhash.xxh3_64_intdigest(payload))]), pa.array([payload.to_pybytes()], pa.binary())], ["piece_id", "payload"])

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                held.append(part)
                size += pc.sum(pc.binary_length(part.column(1))).as_py() or 0
                if size >= PIECE:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(pack, "piece_id long, payload binary")


def opened(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all().combine_chunks()


def bucket_count(docs: DataFrame, text_col: str = "text") -> int:
    return max(48, text_bytes(docs, f"`{text_col}`") // BUCKET)


def order(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys to (order by bucket then key, bounds of buckets in that order)."""
    bucket = (mix(keys ^ U(0x51ED270B9F1C3A77)) % U(buckets)).astype(np.int32)
    by = np.lexsort((keys, bucket))
    return by, np.searchsorted(bucket[by], np.arange(buckets + 1))


def asks(piece_id: int, level: int, buckets: int, bounds: np.ndarray, payload) -> pa.RecordBatch:
    """One row per bucket that has keys; payload(from, to) gives its bytes."""
    used = np.flatnonzero(np.diff(bounds))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used, pa.int32()),
            pa.array(np.full(len(used), piece_id), pa.int64()),
            pa.array(np.full(len(used), level), pa.int32()),
            pa.array([payload(bounds[b], bounds[b + 1]) for b in used], pa.binary()),
        ],
        ["bucket", "piece_id", "level", "payload"],
    )


def answers(rows: list[tuple[int, int, int, np.ndarray]]) -> pa.Table:
    """Rows of (piece, level, bucket, flags)."""
    piece, level, bucket, bits = zip(*rows, strict=True)
    return pa.table({"piece_id": pa.array(piece, pa.int64()), "level": pa.array(level, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "bits": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())})


def flags(table: pa.Table, level: int, bounds: np.ndarray) -> np.ndarray:
    """The answers of one level in key order; fails if a bucket that was asked is silent."""
    out = np.zeros(bounds[-1], bool)
    got = {}
    for lv, b, bits in zip(table["level"].to_pylist(), table["bucket"].to_pylist(), table["bits"], strict=True):
        if lv == level:
            got[b] = bits
    for b in np.flatnonzero(np.diff(bounds)):
        if b not in got:
            raise RuntimeError(f"no answer for level {level}, bucket {b}: the input changed between two reads")
        n = bounds[b + 1] - bounds[b]
        out[bounds[b] : bounds[b + 1]] = np.unpackbits(np.frombuffer(got[b].as_buffer(), np.uint8), count=n).astype(bool)
    return out


def low5(keys: np.ndarray) -> bytes:
    """The five low bytes of each key."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def from5(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view(U).ravel()
