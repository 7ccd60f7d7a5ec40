"""Container headers and PCM audio from file bytes, without codecs.

``videos`` reads the headers of MP4 files, ``audio`` the samples of WAV files. Both scan
``binaryFile``, so a file is held whole by one task (2 GB at most). A file that cannot
be read keeps its row, with the reason in ``error``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

VIDEO = "path string, fps double, width int, height int, frame_count long, duration double, codec string, error string"
AUDIO = "path string, rate int, channels int, duration double, samples array<float>, error string"
_NESTED = (b"moov", b"trak", b"mdia", b"minf", b"stbl")


def boxes(data: bytes, at: int = 0, end: int | None = None) -> Iterator[tuple[bytes, int, int]]:
    """(kind, body start, body end) of the boxes in a range."""
    end = len(data) if end is None else end
    while at + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            (size,), head = struct.unpack_from(">Q", data, at + 8), 16
        size = size or end - at
        if size < head or at + size > end:
            raise ValueError(f"box {kind.decode('latin-1')} is cut")
        yield kind, at + head, at + size
        at += size


def mp4_header(data: bytes) -> tuple[float, int, int, int, float, str]:
    """(fps, width, height, frames, duration, codec) of the first video track."""
    tracks: list[dict] = []

    def walk(at: int, end: int, track: dict | None) -> None:
        for kind, a, b in boxes(data, at, end):
            if kind in _NESTED:
                if kind == b"trak":
                    tracks.append({})
                walk(a, b, tracks[-1] if tracks else None)
            elif track is not None:
                long = data[a : a + 1] == b"\x01"
                if kind == b"tkhd":
                    track["width"], track["height"] = (x >> 16 for x in struct.unpack_from(">II", data, b - 8))
                elif kind == b"mdhd":
                    track["scale"], track["ticks"] = struct.unpack_from(">IQ", data, a + 20) if long else struct.unpack_from(">II", data, a + 12)
                elif kind == b"hdlr":
                    track["kind"] = data[a + 8 : a + 12]
                elif kind == b"stsd":
                    track["codec"] = data[a + 12 : a + 16].decode("latin-1")
                elif kind == b"stts":
                    (n,) = struct.unpack_from(">I", data, a + 4)
                    track["frames"] = sum(struct.unpack_from(">I", data, a + 8 + 8 * k)[0] for k in range(n))

    walk(0, len(data), None)
    t = next((t for t in tracks if t.get("kind") == b"vide"), None)
    if t is None:
        raise ValueError("no video track")
    duration = t["ticks"] / t["scale"]
    return t["frames"] / duration if duration else 0.0, t["width"], t["height"], t["frames"], duration, t["codec"]


def wav_samples(data: bytes) -> tuple[int, int, np.ndarray]:
    """(rate, channels, mono samples in -1..1) of PCM of 8, 16 or 32 bits."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("no RIFF/WAVE header")
    at, form, body = 12, None, None
    while at + 8 <= len(data):
        kind, size = struct.unpack_from("<4sI", data, at)
        part = data[at + 8 : at + 8 + size]
        if kind == b"fmt ":
            form = struct.unpack_from("<HHIIHH", part)
        elif kind == b"data":
            body = part
        at += 8 + size + size % 2
    if form is None or body is None:
        raise ValueError("no format or no data")
    code, channels, rate, _, _, bits = form
    if code != 1 or bits not in (8, 16, 32) or not channels:
        raise ValueError(f"format {code} with {bits} bits is not supported")
    width = bits // 8
    raw = np.frombuffer(body[: len(body) // (width * channels) * width * channels], {8: np.uint8, 16: "<i2", 32: "<i4"}[bits]).astype(np.float64)
    raw = (raw - 128) / 128 if bits == 8 else raw / 2.0 ** (bits - 1)
    return rate, channels, raw.reshape(-1, channels).mean(1)


def resampled(samples: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Samples at another rate, by linear interpolation."""
    if rate == to or not len(samples):
        return samples
    n = int(len(samples) * to / rate)
    return np.interp(np.arange(n) * rate / to, np.arange(len(samples)), samples)


def _each(folder_rows: DataFrame, schema: str, names: list[str], read) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    row, error = read(content.as_py()), None
                except (ValueError, KeyError, IndexError, struct.error, ZeroDivisionError) as e:
                    row, error = (None,) * (len(names) - 2), f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pylist([dict(zip(names, (path, *row, error), strict=True))], _arrow(schema))

    return folder_rows.select("path", "content").mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "long": pa.int64(), "array<float>": pa.list_(pa.float32())}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in schema.split(", "))])


def videos(spark: SparkSession, folder: str) -> DataFrame:
    """Header facts of every MP4 file under a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.mp4").load(folder)
    return _each(files, VIDEO, [x.split()[0] for x in VIDEO.split(", ")], mp4_header)


def audio(spark: SparkSession, folder: str, rate: int = 16000) -> DataFrame:
    """Mono samples at ``rate`` of every WAV file under a folder; the duration is the file's own."""

    def read(data: bytes) -> tuple:
        own, channels, samples = wav_samples(data)
        return rate, channels, len(samples) / own, resampled(samples, own, rate).astype(np.float32)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(folder)
    return _each(files, AUDIO, [x.split()[0] for x in AUDIO.split(", ")], read)


def bursts(samples: np.ndarray, rate: int, frame: float = 0.02, floor: float = 0.02, pause: float = 0.2) -> list[tuple[float, float]]:
    """Spans (s) whose frames are louder than ``floor``; shorter pauses do not part them."""
    width = max(1, int(rate * frame))
    n = len(samples) // width
    loud = np.sqrt((samples[: n * width].reshape(n, width) ** 2).mean(1)) > floor if n else np.zeros(0, bool)
    out: list[list[float]] = []
    for k in np.flatnonzero(loud):
        a, b = k * width / rate, (k + 1) * width / rate
        if out and a - out[-1][1] < pause:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def pitch(samples: np.ndarray, rate: int) -> float:
    """Half the sign changes a second."""
    return float(np.count_nonzero(np.diff(np.signbit(samples)))) / 2 * rate / max(1, len(samples))


def wav_bytes(samples: np.ndarray, rate: int) -> bytes:
    """A 16-bit mono file."""
    body = (np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + b"data" + struct.pack("<I", len(body)) + body


def mp4_bytes(width: int, height: int, frames: int, fps: int, codec: str = "avc1") -> bytes:
    """A file that holds the headers of one video track and no frames."""
    box = lambda kind, body: struct.pack(">I4s", 8 + len(body), kind) + body
    full = lambda kind, body: box(kind, b"\0\0\0\0" + body)
    stbl = full(b"stsd", struct.pack(">II4s", 1, 16, codec.encode()) + b"\0" * 8) + full(b"stts", struct.pack(">III", 1, frames, 1))
    mdia = full(b"mdhd", struct.pack(">IIIIHH", 0, 0, fps, frames, 0, 0)) + full(b"hdlr", b"\0\0\0\0vide" + b"\0" * 12) + box(b"minf", box(b"stbl", stbl))
    trak = full(b"tkhd", b"\0" * 72 + struct.pack(">II", width << 16, height << 16)) + box(b"mdia", mdia)
    return box(b"ftyp", b"isom\0\0\0\0") + box(b"moov", full(b"mvhd", struct.pack(">IIII", 0, 0, fps, frames) + b"\0" * 80) + box(b"trak", trak))
