"""Benchmark decontamination by spaced-seed hashing.

Fixed masks pick four of five or eight neighbouring words and ignore the others. The
seeds of the test items are joined with those of the documents. Of hits that follow one
another on a diagonal (an alignment of a document and an item) only the first is made,
so that repeated words cost the sum of both lengths and not their product. Around each
hit the aligned words are compared: a window of 13 words (an item's length, if shorter)
counts with at most 3 substitutions. Together the two masks have an intact placement
in every window of 13 words with any three substitutions, so no such window is lost.

Words are lower-cased and stripped of ASCII punctuation at their ends. Defined cases:
null and empty texts have no hit; items under five words are too short to be evidence;
items of 5 to 7 words must match whole, those of 8 to 12 words with one substitution;
repeated items and rows are reported each; the words of ``first_word`` and ``end_word``
are counted after stripping; ``matched`` is the best window's; an empty test set finds
nothing; other columns pass through ``decontaminated`` and are ignored by
``contaminated``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices
from .words import U, bare_words, mix

#: Word positions that each mask looks at.
MASKS = ((0, 1, 2, 4), (0, 2, 3, 7))
WINDOW, MISSES, SHORTEST = 13, 3, 5
#: Test bytes that one broadcast may hold; a larger test set is taken in as many passes.
BROADCAST_BYTES = 32 << 20


def allowed(length: int) -> int:
    """Substitutions that a window of this many words may have."""
    return MISSES if length >= WINDOW else int(length >= 8)


def seeds(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of the masked words from each position on."""
    n = len(hashes) - mask[-1]
    out = np.full(max(n, 0), U(mask[-1]))
    for at in mask:
        out = mix(out * U(0x9FB21C651E98DF25) + hashes[at : at + n]) if n > 0 else out
    return out


def _before(h: np.ndarray, row: np.ndarray, none: np.uint64) -> np.ndarray:
    """The seed one word earlier in the row; ``none`` where a row begins."""
    out = np.full(len(h), none)
    out[1:] = np.where(row[1 : len(h)] == row[: len(h) - 1], h[:-1], none) if len(h) else out[1:]
    return out


def _pair(h: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(h * U(0xA24BAED4963EE407) + before)


class Tests:
    """The words and seeds of a bounded set of test items, for lookup."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        w = bare_words(pa.array(texts, pa.string()))
        self.ids, self.rows, self.hashes = np.array(ids, np.int64), w.rows, w.hashes
        self.index = []
        row = w.row
        for mask in MASKS:
            h = seeds(w.hashes, mask)
            before = _before(h, row, U(1))
            at = np.arange(len(h))
            at = at[row[at] == row[at + mask[-1]]] if len(h) else at
            at = at[np.diff(w.rows)[row[at]] >= SHORTEST]
            by = np.lexsort((before[at], h[at]))
            at = at[by]
            h, pair = h[at], _pair(h[at], before[at])
            first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
            order = np.argsort(pair[first])
            bits = np.zeros(1 << 22, bool)
            bits[h >> U(42)] = True
            self.index.append((mask, h, at, bits, pair[first][order], first[order], np.diff(np.append(first, len(pair)))[order]))

    def hits(self, hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document word, test word) pairs that begin an equal seed within one row, and whose words before do not."""
        found = []
        for mask, keys, places, bits, pairs, first, many in self.index:
            h = seeds(hashes, mask)
            before = _before(h, row, U(2))
            at = np.flatnonzero(bits[h >> U(42)])
            at = at[row[at] == row[at + mask[-1]]]
            lo, hi = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
            at, lo, hi = (x[hi > lo] for x in (at, lo, hi))
            pair = _pair(h[at], before[at])
            same = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
            known = pairs[same] == pair if len(pairs) else np.zeros(len(at), bool)
            cut = np.where(known, first[same], hi) if len(pairs) else hi
            on = np.where(known, cut + many[same], hi) if len(pairs) else hi
            for begin, end in ((lo, cut), (on, hi)):
                n = end - begin
                turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                found.append((np.repeat(at, n), places[np.repeat(begin, n) + turn]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def overlaps(self, w) -> list[tuple[int, int, int, int, int]]:
        """(row, item, first word, end word, most words matched in a window) of each row and item that overlap."""
        row = w.row
        doc, test = self.hits(w.hashes, row)
        if not len(doc):
            return []
        item = np.searchsorted(self.rows, test, "right") - 1
        by = np.lexsort((doc - test, item, row[doc]))
        lines = np.stack([row[doc], item, doc - test], 1)[by]
        lines = lines[np.concatenate([[True], (lines[1:] != lines[:-1]).any(1)])]
        out: dict[tuple[int, int], list[int]] = {}
        for r, i, shift in lines.tolist():
            lo = max(w.rows[r], self.rows[i] + shift)
            hi = min(w.rows[r + 1], self.rows[i + 1] + shift)
            length = min(WINDOW, int(self.rows[i + 1] - self.rows[i]))
            if length < SHORTEST or hi - lo < length:
                continue
            same = np.concatenate([[0], np.cumsum(w.hashes[lo:hi] == self.hashes[lo - shift : hi - shift])])
            matched = same[length:] - same[:-length]
            good = np.flatnonzero(matched >= length - allowed(length))
            if len(good):
                a, b, m = int(lo + good[0] - w.rows[r]), int(lo + good[-1] + length - w.rows[r]), int(matched.max())
                old = out.get((r, i))
                out[r, i] = [min(a, old[0]), max(b, old[1]), max(m, old[2])] if old else [a, b, m]
        return [(r, i, *v) for (r, i), v in out.items()]


def test_sets(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator:
    """Broadcasts of the test items, each of a checked size."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null")
    size = int(rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0)
    parts = max(1, -(-2 * size // BROADCAST_BYTES)) if size > BROADCAST_BYTES else 1
    for part in range(parts):
        block = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part)
        got = block.collect()  # at most about BROADCAST_BYTES, by the size above
        yield rows.sparkSession.sparkContext.broadcast(Tests([x.i for x in got], [x.t for x in got]))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, first_word, end_word, matched) of each document and item that overlap."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    names = ["doc_id", "item_id", "first_word", "end_word", "matched"]

    def scan(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            for batch in batches:
                ids = batch.column(0)
                at = 0
                for part in slices(batch, "text"):
                    found = tests.overlaps(bare_words(part.column(1)))
                    if found:
                        r, i, a, b, m = (np.array(x, np.int64) for x in zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(r + at)), *(pa.array(x) for x in (tests.ids[i], a, b, m))], names)
                    at += part.num_rows

        return run

    out = None
    for shared in test_sets(benchmark):
        found = rows.mapInArrow(scan(shared), ", ".join(f"{n} long" for n in names))
        out = found if out is None else out.unionByName(found)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that overlap a test item, in one pass a test block and no shuffle."""

    def clean(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text_col):
                    keep = np.ones(part.num_rows, bool)
                    for found in shared.value.overlaps(bare_words(part.column(text_col))):
                        keep[found[0]] = False
                    yield part if keep.all() else part.filter(pa.array(keep))

        return run

    out = docs
    for shared in test_sets(benchmark):
        out = out.mapInArrow(clean(shared), T.StructType(docs.schema.fields))
    return out
