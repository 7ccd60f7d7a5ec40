"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A merge-type model repeatedly joins the best-ranked neighbouring pieces. Here every
candidate merge that enters the agenda is skipped with probability ``dropout`` by a
hash keyed with the occurrence's draw (seed, row key and place in the text) and the
candidate's place, so every occurrence of a word has a segmentation of its own, each
of them reproducible, and all decode to the text. With dropout 0 the result is the
model's own segmentation.

The agenda runs over many words of a slice at once: a step joins the best candidate of
every word. Words that stand often enough in a slice run once without dropout, and an
occurrence that skips none of the candidates of that run has its result; every other
occurrence has a run of its own. Words over LONG characters use a heap each.

Defined cases: a null text gives null ids and a null decoded text; an empty one gives no
ids; characters outside the vocabulary, and U+2581 itself, are spelt in byte pieces;
equal rows give equal ids; other columns pass through.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices
from .words import U, buffers, hash_spans, map_rows, mix

#: Characters of a long word, cells of a joint agenda, text bytes and ids taken at once, and no candidate.
LONG, CELLS, TEXT, IDS, NONE = 64, 1 << 17, 1 << 18, 1 << 17, np.int32(2**31 - 1)
_WIDTHS = (4, 6, 8, 10, 12, 16, 24, 40, LONG)
_K = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9))


def default_model() -> str:
    """The installed public model; any other merge-type model's path can be given instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


class Model:
    """Pieces, byte pieces and the table of merges of a sentencepiece file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
        self.size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        normal = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(self.size)]
        ids = {p: i for i, p in enumerate(names) if normal[i]}
        self.byte = np.array([next((i for i in [sp.piece_to_id(f"<0x{b:02X}>")] if sp.is_byte(i)), -1) for b in range(256)], np.int32)
        if (self.byte < 0).any():
            raise ValueError("the model has no byte pieces; it cannot be lossless")
        by_rank = sorted(ids.values(), key=lambda i: (-sp.get_score(i), i))
        self.rank = np.full(self.size, NONE, np.int32)
        self.rank[by_rank] = np.arange(len(by_rank))
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1 and p != "▁":
                self.char[ord(p)] = i
        self.char[0x20] = ids["▁"]
        merges = {(ids[p[:k]] << 20) | ids[p[k:]]: i for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}
        self.cut_lines = not any("\n" in p and len(p) > 1 for p in ids)
        self.cut_spaces = not any("▁" in p.lstrip("▁") for p in ids)
        self.merges = merges
        self._table(merges)
        raw = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() if normal[i] else b"" for i, p in enumerate(names)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_at = np.concatenate([[0], np.cumsum([len(x) for x in raw])])

    def _table(self, merges: dict[int, int]) -> None:
        """Open table of pairs by a multiplicative hash; the few that collide are kept in order beside it."""
        keys = np.fromiter(merges, np.int64, len(merges))
        values = np.fromiter(merges.values(), np.int32, len(merges))
        slot = self._slot(keys)
        first = np.zeros(len(keys), bool)
        first[np.unique(slot, return_index=True)[1]] = True
        self.slot_key, self.slot_value = np.full(1 << 19, -1, np.int64), np.full(1 << 19, -1, np.int32)
        self.slot_key[slot[first]], self.slot_value[slot[first]] = keys[first], values[first]
        rest = np.argsort(keys[~first])
        self.rest_key, self.rest_value = keys[~first][rest], values[~first][rest]
        self.crowded = np.zeros(1 << 19, bool)
        self.crowded[slot[~first]] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(U) * _K[0] >> U(45)).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        keys = (left.astype(np.int64) << 20) | right
        keys[(left < 0) | (right < 0) | (left >= self.size) | (right >= self.size)] = -2
        shape, keys = keys.shape, keys.ravel()
        slot = self._slot(keys)
        out = np.where(self.slot_key[slot] == keys, self.slot_value[slot], np.int32(-1))
        odd = np.flatnonzero((out < 0) & self.crowded[slot])
        if len(odd):
            at = np.minimum(np.searchsorted(self.rest_key, keys[odd]), len(self.rest_key) - 1)
            out[odd] = np.where(self.rest_key[at] == keys[odd], self.rest_value[at], -1)
        return out.reshape(shape)


def _limit(dropout: float) -> np.uint64:
    return U(min(int(dropout * 2.0**64), 2**64 - 1))


def _priority(model: Model, merged, draw, left_at, right_at, limit) -> np.ndarray:
    """Rank of each candidate; NONE where there is none or it is skipped."""
    out = np.where(merged >= 0, model.rank[np.maximum(merged, 0)], NONE)
    if limit:
        out = np.where(mix(draw + _candidate(left_at, right_at, merged)) < limit, NONE, out)
    return out


def _candidate(left_at, right_at, merged) -> np.ndarray:
    """What a candidate's hash adds to the draw."""
    return left_at.astype(U) * _K[0] + right_at.astype(U) * _K[1] + merged.astype(np.int64).astype(U) * _K[2]


def agenda(model: Model, symbols: list[int], draw: int, dropout: float, trace: list | None = None) -> list[int]:
    """Segmentation of one word by a heap of candidate merges; ``trace`` gets (left, right, merged) of every candidate."""
    limit = _limit(dropout)
    ids, after, before = list(symbols), list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    heap: list[tuple[int, int, int, int, int, int]] = []

    def push(a: int, b: int) -> None:
        if a >= 0 and b < len(ids) and (m := model.merges.get((ids[a] << 20) | ids[b])) is not None and max(ids[a], ids[b]) < model.size:
            if trace is not None:
                trace.append((a, b, m))
            one = lambda v, t: np.array([v], t)
            rank = int(_priority(model, one(m, np.int32), one(draw, U), one(a, np.int64), one(b, np.int64), limit)[0])
            if rank != NONE:
                heapq.heappush(heap, (rank, a, b, ids[a], ids[b], m))

    for k in range(len(ids) - 1):
        push(k, k + 1)
    while heap:
        _, a, b, left, right, m = heapq.heappop(heap)
        if ids[a] != left or ids[b] != right or after[a] != b:
            continue
        ids[a], ids[b] = m, -1
        after[a] = after[b]
        if after[b] < len(ids):
            before[after[b]] = a
        push(before[a], a)
        push(a, after[a])
    return [x for x in ids if x >= 0]


def segment(model: Model, symbols: np.ndarray, offsets: np.ndarray, draws: np.ndarray, dropout: float, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of all words; symbols of word i are symbols[offsets[i]:offsets[i + 1]].

    ``trace`` gets (word, left, right, merged) arrays of every candidate that was on an agenda.
    """
    limit, sizes = _limit(dropout), np.diff(offsets)
    out, count = np.full(len(symbols), -1, np.int32), np.zeros(len(sizes), np.int64)
    low = 0
    for width in _WIDTHS:
        group = np.flatnonzero((sizes > low) & (sizes <= width))
        low = width
        for at in range(0, len(group), max(1, CELLS // width)):
            _together(model, symbols, offsets, draws, limit, group[at : at + max(1, CELLS // width)], width, out, count, trace)
    for i in np.flatnonzero(sizes > LONG):
        seen: list = []
        got = agenda(model, symbols[offsets[i] : offsets[i + 1]].tolist(), int(draws[i]), dropout, seen)
        if trace is not None and seen:
            trace.append((np.full(len(seen), i), *np.array(seen, np.int64).T))
        out[offsets[i] : offsets[i] + len(got)], count[i] = got, len(got)
    place = np.arange(len(symbols)) - np.repeat(offsets[:-1], sizes) < np.repeat(count, sizes)
    return out[place], np.concatenate([[0], np.cumsum(count)])


def _together(model, symbols, offsets, draws, limit, rows, width, out, count, trace=None) -> None:
    """Run the agenda of words of at most ``width`` symbols in steps of one merge each."""
    column = np.arange(width)
    size = (offsets[rows + 1] - offsets[rows])[:, None]
    ids = np.where(column < size, symbols[np.minimum(offsets[rows][:, None] + column, len(symbols) - 1)], np.int32(-1))
    place = np.broadcast_to(column.astype(np.int16), ids.shape).copy()
    draw = draws[rows]
    merged = model.joined(ids[:, :-1], ids[:, 1:])
    rank = _priority(model, merged, draw[:, None], place[:, :-1], place[:, 1:], limit)
    if trace is not None:
        w, a = np.nonzero(merged >= 0)
        trace.append((rows[w], place[w, a].astype(np.int64), place[w, a + 1].astype(np.int64), merged[w, a].astype(np.int64)))
    while True:
        best = rank.argmin(1) if rank.shape[1] else np.zeros(len(rows), np.int64)
        live = rank[np.arange(len(rows)), best] != NONE if rank.shape[1] else np.zeros(len(rows), bool)
        if not live.all():
            done = ~live
            here = ids[done] >= 0
            target = offsets[rows[done]][:, None] + column[: ids.shape[1]]
            out[target[here]] = ids[done][here]
            count[rows[done]] = here.sum(1)
            if not live.any():
                return
            rows, ids, place, merged, rank, draw, best = (x[live] for x in (rows, ids, place, merged, rank, draw, best))
        n, w = ids.shape
        every = np.arange(n)
        ids[every, best] = merged[every, best]
        keep = column[:w] != (best + 1)[:, None]
        ids, place = ids[keep].reshape(n, w - 1), place[keep].reshape(n, w - 1)
        keep = column[: w - 1] != best[:, None]
        merged, rank = merged[keep].reshape(n, w - 2), rank[keep].reshape(n, w - 2)
        for left in (best - 1, best):
            of = np.flatnonzero((left >= 0) & (left < w - 2))
            a = left[of]
            m = model.joined(ids[of, a], ids[of, a + 1])
            merged[of, a] = m
            rank[of, a] = _priority(model, m, draw[of], place[of, a], place[of, a + 1], limit)
            if trace is not None:
                new = m >= 0
                trace.append((rows[of[new]], place[of[new], a[new]].astype(np.int64), place[of[new], a[new] + 1].astype(np.int64), m[new].astype(np.int64)))


def _symbols(model: Model, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, first byte of each) of UTF-8 bytes; a character without a piece is size + code point."""
    points = np.frombuffer(data.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    raw = np.frombuffer(data, np.uint8)
    ids = model.char[points]
    ids = np.where(ids < 0, (points + model.size).astype(np.int32), ids)
    if (points >= 0xDC80).any() and ((points >= 0xDC80) & (points <= 0xDCFF)).any():
        width = np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where((points >= 0xDC80) & (points <= 0xDCFF), 1, np.where(points < 0x10000, 3, 4))))
        return ids, np.concatenate([[0], np.cumsum(width)[:-1]])
    return ids, np.flatnonzero((raw & 0xC0) != 0x80)


def _spelt(model: Model, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids with characters outside the vocabulary in byte pieces, how many each became)."""
    odd = np.flatnonzero(ids >= model.size)
    many = np.ones(len(ids), np.int64)
    if not len(odd):
        return ids, many
    spelt = [chr(int(p)).encode("utf-8", "surrogateescape") for p in ids[odd] - model.size]
    many[odd] = [len(s) for s in spelt]
    out = np.repeat(ids, many)
    at = np.concatenate([[0], np.cumsum(many)])[odd]
    for a, s in zip(at, spelt, strict=True):
        out[a : a + len(s)] = model.byte[list(s)]
    return out, many


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of runs [start, start + size), one after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def encode_array(model: Model, texts: pa.Array, row_keys: np.ndarray, seed: int, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets of rows) of a string array."""
    data, offsets = buffers(texts)
    full = np.flatnonzero(np.diff(offsets))
    rows = np.zeros(len(texts) + 1, np.int64)
    if not len(full):
        return np.zeros(0, np.int32), rows
    sizes = np.diff(offsets)[full]
    text = np.full(len(data) + len(full), 0x20, np.uint8)  # a space stands before each text
    starts = offsets[full] + np.arange(len(full))
    text[_spread(starts + 1, sizes)] = data
    space, line = text == 0x20, text == 0x0A
    first = np.zeros(len(text), bool)
    if model.cut_spaces:
        first[1:] = space[1:] & ~space[:-1]
    if model.cut_lines:
        first[1:] |= line[1:] | line[:-1]
    first[starts] = True
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], len(text))
    row = np.searchsorted(starts, begin, "right") - 1
    within = np.arange(len(begin)) - np.searchsorted(begin, starts)[row]
    draw = mix(mix(row_keys[full][row] + U(seed & 0xFFFFFFFFFFFFFFFF)) + within.astype(U) * _K[1])
    word = hash_spans(text, begin, end)
    _, one, back = np.unique(word, return_index=True, return_inverse=True)
    width = end[one] - begin[one]
    symbols, at = _symbols(model, text[_spread(begin[one], width)].tobytes())
    bounds = np.searchsorted(at, np.concatenate([[0], np.cumsum(width)]))
    if dropout:
        ids, at, back = _dropped(model, symbols, bounds, back, draw, dropout)
    else:
        ids, at = segment(model, symbols, bounds, draw[one], 0.0)
    ids, many = _spelt(model, ids)
    at = np.concatenate([[0], np.cumsum(many)])[at]
    n = np.diff(at)[back]
    rows[full + 1] = np.add.reduceat(n, np.searchsorted(begin, starts))
    return ids[_spread(at[:-1][back], n)], np.cumsum(rows)


def _dropped(model, symbols, bounds, word, draw, dropout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, result of each occurrence of a word) with dropout."""
    sizes, many = np.diff(bounds), np.bincount(word, minlength=len(bounds) - 1)
    often = np.flatnonzero(many * (1 - dropout) ** (1.5 * sizes) > 1)  # a word of n characters has about 1.5 n candidates
    place = np.full(len(sizes), -1)
    place[often] = np.arange(len(often))
    trace: list = []
    ids, at = segment(model, symbols[_spread(bounds[often], sizes[often])], np.concatenate([[0], np.cumsum(sizes[often])]), np.zeros(len(often), U), 0.0, trace)
    back = place[word]
    own = np.flatnonzero((back < 0) | _skips(trace, back, draw, len(often), _limit(dropout)))
    size = sizes[word[own]]
    more, to = segment(model, symbols[_spread(bounds[word[own]], size)], np.concatenate([[0], np.cumsum(size)]), draw[own], dropout)
    back[own] = len(often) + np.arange(len(own))
    return np.concatenate([ids, more]), np.concatenate([at, at[-1] + to[1:]]), back


def _skips(trace: list, run: np.ndarray, draw: np.ndarray, runs: int, limit: np.uint64) -> np.ndarray:
    """Whether each draw skips a candidate of its run without dropout (-1: it has none)."""
    out = np.zeros(len(run), bool)
    if not trace:
        return out
    of, left, right, merged = (np.concatenate(x) for x in zip(*trace, strict=True))
    by = np.argsort(of, kind="stable")
    key = _candidate(left, right, merged)[by]
    at = np.searchsorted(of[by], np.arange(runs + 1))
    n = np.where(run >= 0, np.diff(at)[run], 0)
    for a in range(0, len(run), IDS):  # a bounded number of occurrences at a time
        some = slice(a, a + IDS)
        hit = mix(np.repeat(draw[some], n[some]) + key[_spread(at[:-1][run[some]], n[some])]) < limit
        out[some] = np.bincount(np.repeat(np.arange(len(n[some])), n[some]), hit, len(n[some])) > 0
    return out


def decode_array(model: Model, ids: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bytes, offsets of rows) of the texts that ids spell, without the space before each."""
    size = np.diff(model.raw_at)[ids]
    raw = model.raw[_spread(model.raw_at[:-1][ids], size)]
    ends = np.concatenate([[0], np.cumsum(size)])[offsets]
    keep = np.ones(len(raw), bool)
    lead = ends[:-1][np.diff(ends) > 0]
    keep[lead[raw[lead] == 0x20]] = False
    return raw[keep].tobytes(), np.concatenate([[0], np.cumsum(keep)])[ends]


_IDS = pa.list_(pa.int32())


def encode(docs: DataFrame, text_col: str = "text", key_col: str = "doc_id", model_path: str | None = None, seed: int = 17, dropout: float = 0.1, out: str = "piece_ids") -> DataFrame:
    """``docs`` with an array of piece ids. ``key_col`` (any id) makes the draws of rows differ."""
    path = model_path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for part in slices(batch, text_col, TEXT):
                text, keys = part.column(text_col), part.column(key_col).cast(pa.string()).fill_null("")
                raw, at = buffers(keys)
                ids, rows = encode_array(model, text, hash_spans(raw, at[:-1], at[1:]), seed, dropout)
                made = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(ids, pa.int32()), mask=text.is_null() if text.null_count else None)
                yield map_rows(part, [pa.field(out, _IDS)], [made])

    kept = [f for f in docs.schema.fields if f.name != out]
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, ids_col: str = "piece_ids", model_path: str | None = None, out: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids spell."""
    path = model_path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            ids = batch.column(ids_col)
            rows = np.concatenate([[0], np.cumsum(np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))])
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(rows, rows[at] + IDS, "right")) - 1)
                raw, offsets = decode_array(model, flat[rows[at] : rows[to]], rows[at : to + 1] - rows[at])
                made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), to - at, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(raw)]).cast(pa.binary())
                text = pa.Array.from_buffers(pa.string(), len(made), made.buffers(), offset=made.offset)
                part = batch.slice(at, to - at)
                if part.column(ids_col).null_count:
                    text = pa.compute.if_else(part.column(ids_col).is_valid(), text, pa.scalar(None, pa.string()))
                yield map_rows(part, [pa.field(out, pa.string())], [text])
                at = to

    kept = [f for f in docs.schema.fields if f.name != out]
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.StringType())]))
