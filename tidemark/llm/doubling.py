"""Substring dedup by level-wise doubling of repeated word windows.

The wanted length is halved down to the first level (13: 6, then 13). At the first
level each wanted window stands for itself by its smallest six-word hash, so that one
key serves several windows. Only windows repeated at one level are extended to
(about) twice that length at the next, and the levels end early once no candidate
survives. At the last level every surviving window learns whether its words also
start in a document with a smaller id, and the words under such windows go.

The first levels are filters: their keys keep over 40 bits and can only let too much
through. The last level compares two 64-bit hashes of whole windows.

Defined cases: a null text has no words; a null id neither removes nor loses words;
rows that share an id do not count against each other; texts shorter than a window
stay whole; other columns are ignored. ``docs`` must be a stable scan (files or a table):
a piece that reads other rows the second time is told so by an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .common import checkpoint
from .words import U, Words, mix, row_windows, windows, words_in_slices

FIRST = 5  # no level is shorter
_NO_ID = np.iinfo(np.int64).max
_SECOND = U(0x3C6EF372FE94F82B)  # makes the second hash another one


def levels_of(length: int) -> list[int]:
    """Window lengths from the shortest to the wanted one, each at most twice (and one) the one before."""
    out = [length]
    while out[-1] // 2 > FIRST:
        out.append(out[-1] // 2)
    return out[::-1]


class _Piece:
    """Words of a piece and, level by level, its candidate windows."""

    def __init__(self, payload: bytes, levels: list[int], buckets: int):
        table = blocks.opened(payload)
        self.ids = table["doc_id"].combine_chunks()
        self.doc = self.ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        self.w: Words = words_in_slices(table["text"].combine_chunks())
        self.levels, self.buckets = levels, buckets
        self.of_word = self.doc[self.w.row]
        self.at = row_windows(self.w.rows, levels[min(1, len(levels) - 1)])
        self.at = self.at[self.of_word[self.at] != _NO_ID]

    def keys(self, level: int) -> np.ndarray:
        """The key of each candidate window at this level."""
        h = windows(self.w.hashes, self.levels[level])
        if level == 0 and len(self.levels) > 1:  # the least short window in each window of the next level
            span, width = self.levels[1] - self.levels[0] + 1, 1
            while width < span:
                step = min(width, span - width)
                h = np.minimum(h[:-step], h[step:]) if len(h) > step else h[:0]
                width += step
            return mix(h[self.at]) if len(self.at) else np.zeros(0, U)
        return h[self.at] if len(self.at) else np.zeros(0, U)

    def filter_ask(self, level: int):
        """Distinct keys in bucket order, the place of each window's key, and keys seen in two documents here."""
        keys, place = np.unique(self.keys(level), return_inverse=True)
        by, bounds = blocks.order(keys, self.buckets)
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        place = rank[place]
        doc = self.of_word[self.at]
        low, high = np.full(len(keys), _NO_ID), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, place, doc)
        np.maximum.at(high, place, doc)
        return keys[by], bounds, place, low < high

    def filter_apply(self, level: int, table: pa.Table) -> None:
        """Keep candidates whose window is repeated, and turn to the next length."""
        _, bounds, place, here = self.filter_ask(level)
        alive = (blocks.flags(table, level, bounds) | here)[place]
        if level == 0:
            self.at = self.at[alive]
            return
        shift = self.levels[level + 1] - self.levels[level]
        good = self.at[alive]
        nxt = row_windows(self.w.rows, self.levels[level + 1])
        marks = np.zeros(len(self.w.hashes) + shift + 1, bool)
        marks[good] = True
        self.at = nxt[marks[nxt] & marks[nxt + shift]]

    def last_ask(self):
        """(distinct hashes, their second hashes, first ids, bounds, place of each window, windows that a smaller id here removes)."""
        h, doc = self.keys(len(self.levels) - 1), self.of_word[self.at]
        g = windows(mix(self.w.hashes ^ _SECOND), self.levels[-1])[self.at] if len(self.at) else h
        order = np.lexsort((g, h))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(fresh) - 1
        keys, others = h[order][fresh], g[order][fresh]
        by, bounds = blocks.order(keys, self.buckets)
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        place = rank[place]
        first = np.full(len(keys), _NO_ID)
        np.minimum.at(first, place, doc)
        return keys[by], others[by], first, bounds, place, doc > first[place]

    def removed(self, table: pa.Table) -> np.ndarray:
        """Which words go."""
        _, _, _, bounds, place, here = self.last_ask()
        gone = self.at[here | blocks.flags(table, len(self.levels) - 1, bounds)[place]]
        edge = np.zeros(len(self.w.hashes) + 1, np.int32)
        np.add.at(edge, gone, 1)
        np.add.at(edge, gone + self.levels[-1], -1)
        return np.cumsum(edge)[:-1] > 0


def _open(left: pa.Table, right: pa.Table, upto: int, levels: list[int], buckets: int) -> Iterator[tuple[int, _Piece]]:
    """Pieces of a group, with the filters below ``upto`` applied."""
    for piece_id, payload in zip(left["piece_id"].to_pylist(), left["payload"], strict=True):
        piece = _Piece(payload.as_buffer(), levels, buckets)
        for level in range(upto):
            piece.filter_apply(level, right)
        yield piece_id, piece


def _repeated(table: pa.Table) -> pa.Table:
    """A bucket of a filter level: keys that two pieces ask about."""
    asked = [blocks.from5(x.as_buffer()) for x in table["payload"]]
    every = np.sort(np.concatenate(asked))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    return blocks.answers([(p, lv, b, _isin(k, twice)) for p, lv, b, k in zip(table["piece_id"].to_pylist(), table["level"].to_pylist(), table["bucket"].to_pylist(), asked, strict=True)])


def _isin(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, keys)
    at[at == len(ordered)] = 0
    return ordered[at] == keys if len(ordered) else np.zeros(len(keys), bool)


def _earlier(table: pa.Table) -> pa.Table:
    """A bucket of the last level: keys whose first id anywhere is smaller than the asking one."""
    asked = [np.frombuffer(x.as_buffer(), np.int64).reshape(3, -1) for x in table["payload"]]
    keys, others, first = (np.concatenate([a[k] for a in asked]) for k in range(3))
    by = np.lexsort((first, others, keys))
    fresh = np.ones(len(by), bool)
    fresh[1:] = (keys[by][1:] != keys[by][:-1]) | (others[by][1:] != others[by][:-1])
    least = np.empty(len(by), np.int64)
    least[by] = first[by][fresh][np.cumsum(fresh) - 1]
    ends = np.cumsum([a.shape[1] for a in asked])
    parts = np.split(least < first, ends[:-1])
    return blocks.answers(list(zip(table["piece_id"].to_pylist(), table["level"].to_pylist(), table["bucket"].to_pylist(), parts, strict=True)))


def substring_dedup(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, spans): spans are removed word ranges [start, end)."""
    levels, buckets = levels_of(length), blocks.bucket_count(docs, text_col)
    packed = blocks.pieces(docs, id_col, text_col)
    told = docs.sparkSession.createDataFrame([], blocks.ANSWER)
    last = len(levels) - 1

    def ask_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield asked(batch.column(0)[row].as_py(), _Piece(batch.column(1)[row].as_buffer(), levels, buckets), 0)

    def asked(piece_id: int, piece: _Piece, level: int) -> pa.RecordBatch:
        if level < last:
            keys, bounds, _, _ = piece.filter_ask(level)
            return blocks.asks(piece_id, level, buckets, bounds, lambda a, b: blocks.low5(keys[a:b]))
        keys, others, first, bounds, _, _ = piece.last_ask()
        return blocks.asks(piece_id, level, buckets, bounds, lambda a, b: keys[a:b].tobytes() + others[a:b].tobytes() + first[a:b].tobytes())

    def ask_at(level: int):
        def ask(left: pa.Table, right: pa.Table) -> pa.Table:
            out = [asked(p, piece, level) for p, piece in _open(left, right, level, levels, buckets)]
            return pa.Table.from_batches(out, _ASK) if out else _ASK.empty_table()

        return ask

    for level in range(last + 1):
        rows = packed.mapInArrow(ask_first, blocks.ASK) if level == 0 else _with(packed, told, ask_at(level), blocks.ASK)
        answer = rows.groupBy("bucket").applyInArrow(_earlier if level == last else _repeated, blocks.ANSWER)
        told = checkpoint(told.unionByName(answer) if level else answer)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_kept(piece, right) for _, piece in _open(left, right, last, levels, buckets)] or [], _RESULT)

    return _with(packed, told, finish, "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<start:long,end:long>>")


_ASK = pa.schema([("bucket", pa.int32()), ("piece_id", pa.int64()), ("level", pa.int32()), ("payload", pa.binary())])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("spans", pa.list_(_SPAN))])


def _with(packed: DataFrame, told: DataFrame, function, schema: str) -> DataFrame:
    return packed.groupBy("piece_id").cogroup(told.groupBy("piece_id")).applyInArrow(function, schema)


def _kept(piece: _Piece, answers: pa.Table) -> pa.RecordBatch:
    gone, w = piece.removed(answers), piece.w
    raw, counts, texts, spans = w.data.tobytes(), [], [], []
    for row in range(len(piece.doc)):
        a, b = w.rows[row], w.rows[row + 1]
        cut = gone[a:b]
        tokens = raw[w.offsets[row] : w.offsets[row + 1]].split()
        counts.append((b - a, int(cut.sum())))
        texts.append(b" ".join(compress(tokens, ~cut) if counts[-1][1] else tokens))
        edge = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]]))) if counts[-1][1] else ()
        spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2], strict=True)])
    n, r = (pa.array([int(x[k]) for x in counts], pa.int64()) for k in (0, 1))
    return pa.RecordBatch.from_arrays([piece.ids, n, r, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(_SPAN))], schema=_RESULT)
