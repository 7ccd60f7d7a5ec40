"""Vectorised words: byte buffers of Arrow strings to word bounds and 64-bit hashes.

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D, which never cut a
UTF-8 character. No Python object is made per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_WORD = ~_SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            step = np.full(size, U(base))
            step[0] = 1
            _powers[k] = np.cumprod(step)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, nulls as empty; offsets start at 0."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(array.type) else np.int32
    offsets = np.frombuffer(array.buffers()[1], width)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if array.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


@dataclass
class Words:
    data: np.ndarray  # bytes of all rows
    offsets: np.ndarray  # byte offsets of rows
    starts: np.ndarray  # byte start of each word
    ends: np.ndarray  # byte end of each word
    rows: np.ndarray  # word offsets of rows
    hashes: np.ndarray  # 64-bit hash of each word
    spans: Spans | None = None  # of data

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


class Spans:
    """64-bit hashes of byte spans [start, end) of one buffer, equal for equal bytes; sums are made once."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = powers(max(1, len(data)))
        self.sums = np.empty(len(data) + 1, U)
        self.sums[0] = 0
        step = _TABLE[data]
        step *= power[: len(data)]
        np.cumsum(step, out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, U)
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Spans(data)(starts, ends)


def words(array: pa.Array, lower: bool = False) -> Words:
    """All words of a string array; ``lower`` folds A-Z first."""
    data, offsets = buffers(array)
    if lower:
        data = LOWER[data]
    inside = _WORD[data]
    n = len(data)
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        before[cuts] = False
        after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    spans = Spans(data)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), spans(starts, ends), spans)


def words_in_slices(array: pa.Array, limit: int = 1 << 20) -> Words:
    """As ``words``, hashing about ``limit`` bytes at a time: bounded scratch memory for large arrays."""
    data, offsets = buffers(array)
    parts, at = [], 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        w = words(array.slice(at, to - at))
        parts.append((w.starts + offsets[at], w.ends + offsets[at], np.diff(w.rows), w.hashes))
        at = to
    if not parts:
        return words(array)
    starts, ends, counts, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Words(data, offsets, starts, ends, np.concatenate([[0], np.cumsum(counts)]), hashes)


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Order-sensitive hash of each run of ``length`` hashes, by doubling; len - length + 1 values."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U)
    out, at, level, width = np.zeros(n, U), 0, hashes, 1
    rest = length
    while rest:
        if rest & 1:
            out = mix(out * U(0x9FB21C651E98DF25) + level[at : at + n])
            at += width
        rest >>= 1
        if rest:
            level = mix(level[:-width] * U(0xA24BAED4963EE407) + level[width:] + U(width))
            width *= 2
    return out


def row_windows(rows: np.ndarray, length: int) -> np.ndarray:
    """Start indices of windows of ``length`` words that stay inside their row."""
    counts = np.maximum(np.diff(rows) - length + 1, 0)
    if not counts.sum():
        return np.zeros(0, np.int64)
    return np.repeat(rows[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())


_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def bare_words(array: pa.Array) -> Words:
    """Lower-cased words without ASCII punctuation at their ends; words of punctuation only are left out."""
    w = words(array, lower=True)
    starts, ends, data = w.starts.copy(), w.ends.copy(), w.data
    live = np.arange(len(starts))
    while len(live):
        live = live[(starts[live] < ends[live]) & _PUNCT[data[np.minimum(starts[live], len(data) - 1)]]]
        starts[live] += 1
    live = np.arange(len(starts))
    while len(live):
        live = live[(ends[live] > starts[live]) & _PUNCT[data[ends[live] - 1]]]
        ends[live] -= 1
    keep = ends > starts
    rows = np.concatenate([[0], np.cumsum(keep)])[w.rows]
    starts, ends = starts[keep], ends[keep]
    return Words(data, w.offsets, starts, ends, rows, w.spans(starts, ends), w.spans)


def map_rows(batch: pa.RecordBatch, fields: list[pa.Field], columns: list[pa.Array]) -> pa.RecordBatch:
    """The batch with columns replaced or added by name."""
    names = {f.name for f in fields}
    kept = [i for i, f in enumerate(batch.schema) if f.name not in names]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *columns], schema=pa.schema([*(batch.schema.field(i) for i in kept), *fields]))
