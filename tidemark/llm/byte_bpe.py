"""Byte-level BPE by tree concatenation, and decoding.

A text longer than LEAF bytes is cut into halves, again and again, at the nearest
character and without regard to words. All leaves of a slice are encoded at once; a text
over SPREAD bytes is dealt over tasks first. Then neighbours are joined, level by level:
the bytes around a join are encoded again, in windows that double until the new tokens
agree with those of both sides.

Why an agreed join is exact. A run of tokens is the encoding of its bytes if its
pre-token starts are the pattern's, and each two neighbours inside a pre-token are the
encoding of their own bytes (no merge across the border of two such neighbours can ever
be the first one). A pre-token start that lies REACH bytes before the end of a text does
not change when the text goes on. So a window may begin at such a start, or at any token
that it makes again; and it may end where both sides have a token border that starts a
pre-token in both, or that lies inside one in both, with the same token before or after
it. From there on both scans of the pattern are one and the same.

Pre-tokens come from character classes, which the tokenizer itself tells; each distinct
pre-token is given to the tokenizer once and kept in a table of bounded size.

Defined cases: a null text has null ids and a null decoded text; an empty one has no ids;
special tokens are found in texts as the tokenizer finds them; bytes that are not UTF-8
are decoded to U+FFFD; ids outside the vocabulary are an error; an existing column of the
new one's name is replaced and all others pass through.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices
from .words import U, Spans, buffers, map_rows

#: Bytes of a leaf and of the first half-window; bytes of a text from which it is dealt over tasks.
LEAF, WINDOW, SPREAD = 4096, 32, 4 << 20
#: Bytes that a scan of the pattern looks ahead at most, with room to spare; text bytes and ids taken at once; pre-tokens kept in the table.
REACH, TEXT, IDS, KEPT = 8, 1 << 20, 1 << 18, 400_000
_SPACE, _LETTER, _NUMBER, _OTHER, _UNKNOWN = range(5)
#: The pattern's contractions (fixed values).
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def default_model() -> str:
    """The installed public vocabulary; any byte-level BPE file with the same pre-tokenizer can be given instead."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def _alphabet() -> dict[str, int]:
    """The character that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of runs [start, start + size), one after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _sums(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


class Model:
    """Token bytes, special tokens, character classes and the table of encoded pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, bpe = spec["pre_tokenizer"] or {}, spec["model"]
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or bpe.get("dropout") or bpe.get("ignore_merges"):
            raise ValueError("a byte-level BPE file with the plain pattern is needed")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True  # pre-tokens hold none; they are cut out before
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        found = sorted(self.special, key=lambda s: (-len(s), s))
        self.find_special = re.compile(b"|".join(map(re.escape, found))) if found else None
        alphabet = _alphabet()
        words = {i: bytes(alphabet[c] for c in w) for w, i in bpe["vocab"].items()} | {i: s for s, i in self.special.items()}
        raw = [words.get(i, b"") for i in range(max(words) + 1)]
        self.raw, self.raw_at = np.frombuffer(b"".join(raw), np.uint8), _sums(np.array([len(r) for r in raw]))
        self.length = np.diff(self.raw_at)
        self.classes = np.full(0x110000, _UNKNOWN, np.uint8)
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.size, self.kept = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    # ---- pre-tokens ----------------------------------------------------------------------

    def kinds(self, points: np.ndarray) -> np.ndarray:
        """The class of each character."""
        out = self.classes[points]
        if (out == _UNKNOWN).any():
            self._ask(np.unique(points[out == _UNKNOWN]))
            out = self.classes[points]
        return out

    def _ask(self, points: np.ndarray) -> None:
        """A character has the class of a neighbour that the tokenizer does not part it from."""
        self.classes[points] = _SPACE
        for before, kind in (("a", _LETTER), ("1", _NUMBER), ("!", _OTHER)):
            probe = "".join(before + chr(p) + "\n" for p in points.tolist())
            got = self.library.pre_tokenizer.pre_tokenize_str(probe)
            joined = np.array([a // 3 for _, (a, b) in got if a % 3 == 0 and b - a >= 2 and probe[a] == before], np.int64)
            self.classes[points[joined]] = kind

    def starts(self, text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Byte places in ``text`` where pre-tokens start; ``bounds`` are those of separate texts in it."""
        if not len(text):
            return np.zeros(0, np.int64)
        points = np.frombuffer(text.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        places = np.flatnonzero((text & 0xC0) != 0x80)
        kind, n = self.kinds(points), len(points)
        first = np.zeros(n + 1, bool)  # where a separate text starts
        first[np.searchsorted(places, bounds)] = True
        start = first.copy()
        start[1:n] |= kind[1:] != kind[:-1]
        run = np.flatnonzero(start[:n])
        end = np.append(run[1:], n)
        goes_on = ~first[end]
        blank = (kind[run] == _SPACE) & goes_on  # white space before a word: its last character stands alone or, if a space, goes with the word
        last = end[blank] - 1
        start[last] = True
        start[end[blank][points[last] == 0x20]] = False
        mark = np.flatnonzero((points[run] == 0x27) & (end - run == 1) & goes_on & start[run])
        mark = mark[kind[end[mark]] == _LETTER]
        for c in _CONTRACTIONS:
            at, stop = end[mark], end[mark + 1]
            hit = stop - at >= len(c) - 1
            for k, letter in enumerate(c[1:]):
                hit &= points[np.minimum(at + k, n - 1)] == ord(letter)
            start[at[hit]] = False
            start[at[hit] + len(c) - 1] = True
        return places[np.flatnonzero(start[:n])]

    # ---- encoding of separate texts ------------------------------------------------------

    def encode(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, whether each starts a pre-token, offsets of the spans) of spans of ``data``, each a text of its own."""
        sizes = end - begin
        text, bounds = data[spread(begin, sizes)], _sums(sizes)
        start = self.starts(text, bounds)
        stop = np.append(start[1:], len(text))
        key, one, back = np.unique(Spans(text)(start, stop), return_index=True, return_inverse=True)
        at, size = self._known(key, text, start[one], stop[one])
        at, size = at[back], size[back]
        ids, ends = self.kept[spread(at, size)], _sums(size)
        marks = np.zeros(len(ids), bool)
        marks[ends[:-1]] = True
        return ids, marks, ends[np.searchsorted(start, bounds)]

    def _known(self, key, text, start, stop) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of the ids of each distinct pre-token."""
        if len(self.keys) > KEPT:
            self.forget()
        at = np.searchsorted(self.keys, key)
        if len(self.keys):
            new = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != key)
        else:
            new = np.arange(len(key))
        if len(new):
            raw = text.tobytes()
            words = [raw[a:b].decode() for a, b in zip(start[new].tolist(), stop[new].tolist(), strict=True)]
            got = self.library.encode(words, is_pretokenized=True, add_special_tokens=False)
            size = np.bincount(np.array(got.word_ids, np.int64), minlength=len(new))
            to = at[new]
            self.keys, self.at, self.size = np.insert(self.keys, to, key[new]), np.insert(self.at, to, len(self.kept) + _sums(size)[:-1]), np.insert(self.size, to, size)
            self.kept = np.concatenate([self.kept, np.array(got.ids, np.int32)])
            at = np.searchsorted(self.keys, key)
        return self.at[at], self.size[at]


# ---- tree --------------------------------------------------------------------------------


def leaves(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes of the leaves of all texts, number of leaves of each text, a power of two)."""
    size = end - begin
    many = 1 << np.ceil(np.log2(np.maximum(size, LEAF) / LEAF)).astype(np.int64)
    k = np.arange(many.sum()) - np.repeat(_sums(many)[:-1], many)
    cut = np.repeat(begin, many) + np.repeat(size, many) * k // np.repeat(many, many)
    return whole(data, cut, k > 0), many


def whole(data: np.ndarray, at: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Places moved back to the start of their character."""
    at = at.copy()
    for _ in range(3):
        inside = move & (data[np.minimum(at, len(data) - 1)] & 0xC0 == 0x80) & (at < len(data))
        at[inside] -= 1
    return at


class Tokens:
    """Tokens of many texts in a row: ids, pre-token marks and first bytes; the texts tile part of ``data``."""

    def __init__(self, model: Model, data: np.ndarray, ids: np.ndarray, marks: np.ndarray, start: np.ndarray):
        self.model, self.data, self.ids, self.marks, self.start = model, data, ids, marks, start

    def join(self, left: np.ndarray, at: np.ndarray, right: np.ndarray) -> None:
        """Join the encodings of [left, at) and [at, right), for many disjoint pairs in order."""
        cut = np.zeros((2, len(at)), np.int64)  # tokens [cut[0], cut[1]) give way
        new: list = [None] * len(at)
        first, middle = np.searchsorted(self.start, left), np.searchsorted(self.start, at)
        open_, width = np.arange(len(at)), WINDOW
        while len(open_):
            done = self._windows(left[open_], at[open_], right[open_], first[open_], middle[open_], width)
            for k, found in zip(open_.tolist(), done, strict=True):
                if found is not None:
                    cut[0, k], cut[1, k], new[k] = found[0], found[1], found[2:]
            open_ = np.array([k for k in open_.tolist() if new[k] is None], np.int64)
            width *= 2
        keep = np.ones(len(self.ids), bool)
        keep[spread(cut[0], cut[1] - cut[0])] = False
        place = np.repeat(cut[0], [len(n[0]) for n in new])  # before which old token each new one goes
        order = np.argsort(np.concatenate([np.flatnonzero(keep), place - 0.5]), kind="stable")
        self.ids, self.marks, self.start = (np.concatenate([old[keep], *(n[k] for n in new)])[order] for k, old in enumerate((self.ids, self.marks, self.start)))

    def _windows(self, left, at, right, first, middle, width) -> list:
        """For each pair (from, to, ids, marks, starts) of the tokens that change, or None where this width does not agree."""
        i = np.maximum(np.searchsorted(self.start, at - width, "right") - 1, first)
        i = np.where(at - width <= left, first, i)
        while True:
            inside = (i > first) & (self.data[self.start[i]] & 0xC0 == 0x80)
            if not inside.any():
                break
            i[inside] -= 1
        x, y = self.start[i], np.minimum(at + width, right)
        y = whole(self.data, y, y < right)
        ids, marks, ends = self.model.encode(self.data, x, y)
        of = np.repeat(np.arange(len(at)), np.diff(ends))
        stop = np.cumsum(self.model.length[ids])
        base = np.concatenate([[0], stop])[ends[:-1]]
        start = x[of] + np.concatenate([[0], stop[:-1]]) - base[of]
        stop = x[of] + stop - base[of]
        fresh = marks[ends[:-1]] & (self.marks[i] | (i == first))
        agree = fresh | (ids[ends[:-1]] == self.ids[i])
        marks[ends[:-1]] = self.marks[i]
        # borders after each token of the window that the right side has too
        n = len(self.ids)
        r = np.searchsorted(self.start, stop)
        there = (stop > at[of]) & (stop <= y[of] - REACH) & (r < n)
        there &= self.start[np.minimum(r, n - 1)] == stop
        after = np.minimum(np.arange(len(ids)) + 1, len(ids) - 1)
        mark = marks[after] & (of[after] == of)
        old = self.marks[np.minimum(r, n - 1)]
        same = (ids == self.ids[np.maximum(r - 1, 0)]) & (r - 1 >= middle[of]) | (ids[after] == self.ids[np.minimum(r, n - 1)]) & (of[after] == of)
        there &= np.where(mark | old, mark & old, same)
        ended = (stop == right[of]) & (y == right)[of]
        hit = np.flatnonzero((there | ended) & agree[of])
        out: list = [None] * len(at)
        one, k = np.unique(of[hit], return_index=True)
        for p, e in zip(one.tolist(), hit[k].tolist(), strict=True):
            some = slice(ends[p], e + 1)
            out[p] = (i[p], r[e] if there[e] else np.searchsorted(self.start, right[p]), ids[some], marks[some], start[some])
        return out


def grow(tokens: Tokens, cuts: np.ndarray, many: np.ndarray, end: np.ndarray) -> Tokens:
    """Join the parts of all texts, neighbours first; text t has many[t] parts, whose first bytes are in ``cuts``."""
    at = _sums(many)[:-1]
    step = 1
    while (many > step).any():
        k = np.arange(many.sum()) - np.repeat(at, many)
        of = np.repeat(np.arange(len(many)), many)
        right = np.flatnonzero((k % (2 * step) == step))
        stop = np.where(k[right] + step < many[of[right]], cuts[np.minimum(right + step, len(cuts) - 1)], end[of[right]])
        tokens.join(cuts[right - step], cuts[right], stop)
        step *= 2
    return tokens


def encode_texts(model: Model, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Tokens:
    """Tokens of texts without special tokens, each by its own tree."""
    begin, end = begin[end > begin], end[end > begin]
    cuts, many = leaves(data, begin, end)
    last = np.cumsum(many) - 1
    stops = np.append(cuts[1:], 0)
    stops[last] = end
    ids, marks, ends = model.encode(data, cuts, stops)
    size = model.length[ids]
    start = np.cumsum(size) - size
    start = start - np.repeat(start[ends[:-1]], np.diff(ends)) + np.repeat(cuts, np.diff(ends)) if len(ids) else start
    return grow(Tokens(model, data, ids, marks, start), cuts, many, end)


def roots(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end) of the stretches between special tokens, and (place, id) of the special tokens."""
    raw, place, stop, ids = data.tobytes(), [], [], []
    if model.find_special and model.find_special.search(raw):
        rows = {int(np.searchsorted(offsets, p, "right")) - 1 for m in model.find_special.finditer(raw) for p in (m.start(), m.end() - 1)}
        for row in sorted(rows):
            for m in model.find_special.finditer(raw, int(offsets[row]), int(offsets[row + 1])):
                place.append(m.start())
                stop.append(m.end())
                ids.append(model.special[m.group()])
    place, stop = np.array(place, np.int64), np.array(stop, np.int64)
    return np.sort(np.concatenate([offsets[:-1], stop])), np.sort(np.concatenate([offsets[1:], place])), place, np.array(ids, np.int32)


def encode_array(model: Model, texts: pa.Array, special: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets of rows) of a string array; without ``special`` the strings of special tokens are plain text."""
    data, offsets = buffers(texts)
    if not special:
        t = encode_texts(model, data, offsets[:-1], offsets[1:])
        return t.ids, np.searchsorted(t.start, offsets)
    begin, end, place, own = roots(model, data, offsets)
    t = encode_texts(model, data, begin, end)
    start, ids = t.start, t.ids
    if len(place):
        start, ids = np.concatenate([start, place]), np.concatenate([ids, own])
        by = np.argsort(start, kind="stable")
        start, ids = start[by], ids[by]
    return ids, np.searchsorted(start, offsets)


def decode_array(model: Model, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The texts that ids spell."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(model.length)):
        raise ValueError("an id is outside the vocabulary")
    raw = model.raw[spread(model.raw_at[:-1][ids], model.length[ids])]
    ends = _sums(model.length[ids])[offsets]
    text = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes()))
    try:
        text.validate(full=True)
    except pa.ArrowInvalid:
        text = pa.array([raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)], pa.large_string())
    return text.cast(pa.string())


# ---- DataFrames --------------------------------------------------------------------------

_IDS = pa.list_(pa.int32())


def _lists(ids: np.ndarray, rows: np.ndarray, null: pa.Array | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(ids, pa.int32()), mask=null)


def encode(docs: DataFrame, text_col: str = "text", model_path: str | None = None, out: str = "ids", special: bool = True) -> DataFrame:
    """``docs`` with an array of token ids; the order of rows is not kept."""
    path = model_path or default_model()
    kept = [f for f in docs.schema.fields if f.name != out]
    docs = docs.select(*(F.col(f"`{f.name}`") for f in kept))
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for part in slices(batch, text_col, TEXT):
                text = part.column(text_col)
                ids, rows = encode_array(model, text, special)
                yield map_rows(part, [pa.field(out, _IDS)], [_lists(ids, rows, text.is_null() if text.null_count else None)])

    long = F.octet_length(F.col(f"`{text_col}`")) > SPREAD
    short = docs.where(~F.coalesce(long, F.lit(False))).mapInArrow(run, schema)
    others = [f.name for f in kept if f.name != text_col]
    whole_rows = docs.where(long).select(F.monotonically_increasing_id().alias("key"), F.struct(*([F.col(f"`{c}`") for c in others] or [F.lit(0)])).alias("rest"), F.col(f"`{text_col}`").alias("text"))
    rest = whole_rows.schema["rest"].dataType
    fields = [T.StructField("key", T.LongType()), T.StructField("part", T.LongType()), T.StructField("rest", rest), T.StructField("kind", T.IntegerType()), T.StructField("text", T.StringType())]
    dealt = whole_rows.mapInArrow(_deal(path, special), T.StructType(fields)).repartition("key", "part")
    coded = dealt.mapInArrow(_parts(path), T.StructType([*fields, T.StructField("ids", T.BinaryType()), T.StructField("marks", T.BinaryType())]))
    joined = coded.groupBy("key").applyInArrow(_joined(path), T.StructType([T.StructField("rest", rest), T.StructField("text", T.StringType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    column = {c: F.col("rest")[c] for c in others} | {text_col: F.col("text")}
    return short.union(joined.select(*(column[f.name].alias(f.name) for f in kept), F.col("ids").alias(out)))


def _deal(path: str, special: bool):
    """Parts of long texts: kind -1 goes on from the part before it, -2 starts a stretch, others are special tokens by their id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                data, offsets = buffers(row.column(2))
                begin, end, place, own = roots(model, data, offsets) if special else (offsets[:-1], offsets[1:], *np.zeros((2, 0), np.int64))
                cut, kind = [place], [own.astype(np.int64)]
                for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                    if b > a:
                        c = whole(data, np.arange(a, b, SPREAD), np.arange(a, b, SPREAD) > a)
                        cut.append(c)
                        kind.append(np.where(c == a, -2, -1))
                cut, kind = np.concatenate(cut), np.concatenate(kind)
                by = np.argsort(cut, kind="stable")
                cut, kind = cut[by], kind[by]
                for k, (a, b) in enumerate(zip(cut.tolist(), [*cut[1:].tolist(), len(data)], strict=True)):
                    rest = row.column(1) if k == 0 else pa.nulls(1, row.column(1).type)
                    yield pa.RecordBatch.from_arrays([row.column(0), pa.array([k], pa.int64()), rest, pa.array([kind[k]], pa.int32()), pa.array([data[a:b].tobytes().decode()])], ["key", "part", "rest", "kind", "text"])

    return run


def _parts(path: str):
    """Each part by its own tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                kind = row.column(3)[0].as_py()
                if kind < 0:
                    data, offsets = buffers(row.column(4))
                    t = encode_texts(model, data, offsets[:-1], offsets[1:])
                    ids, marks = t.ids, t.marks
                else:
                    ids, marks = np.array([kind], np.int32), np.ones(1, bool)
                made = [pa.array([ids.astype("<i4").tobytes()], pa.binary()), pa.array([np.packbits(marks).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([*row.columns, *made], [*row.schema.names, "ids", "marks"])

    return run


def _joined(path: str):
    """The parts of one text joined by the upper levels of its tree."""

    def run(table: pa.Table) -> pa.Table:
        model = load(path)
        table = table.sort_by("part").combine_chunks()
        data, offsets = buffers(table["text"].combine_chunks())
        ids = [np.frombuffer(x.as_buffer(), "<i4") for x in table["ids"]]
        marks = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=len(i)).astype(bool) for x, i in zip(table["marks"], ids, strict=True)]
        kind, ids, marks = table["kind"].to_numpy(), np.concatenate(ids), np.concatenate(marks)
        size = model.length[ids]
        new = np.flatnonzero(kind != -1)
        tokens = grow(Tokens(model, data, ids, marks, np.cumsum(size) - size), offsets[:-1], np.diff(np.append(new, len(kind))), np.append(offsets[:-1][new[1:]], offsets[-1]))
        text = pa.array([data.tobytes().decode()], pa.string())
        return pa.table({"rest": table["rest"].slice(0, 1).combine_chunks(), "text": text, "ids": _lists(tokens.ids, np.array([0, len(tokens.ids)]))})

    return run


def decode(docs: DataFrame, ids_col: str = "ids", model_path: str | None = None, out: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids spell, special tokens included."""
    path = model_path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            ids = batch.column(ids_col)
            rows = _sums(pc.fill_null(ids.value_lengths(), 0).to_numpy(zero_copy_only=False))
            flat, at = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64), 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(rows, rows[at] + IDS, "right")) - 1)
                part = batch.slice(at, to - at)
                text = decode_array(model, flat[rows[at] : rows[to]], rows[at : to + 1] - rows[at])
                if part.column(ids_col).null_count:
                    text = pc.if_else(part.column(ids_col).is_valid(), text, pa.scalar(None, pa.string()))
                yield map_rows(part, [pa.field(out, pa.string())], [text])
                at = to

    kept = [f for f in docs.schema.fields if f.name != out]
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.StringType())]))
