"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes.

A slice of a batch is one buffer, a space before each text, and documents are offsets in
it. The ends of all tokens of both sides are counted once; where both sides end, a group
ends. Prefix sums of these cuts give each token its group and, taken at the documents'
offsets, each document its numbers.

Links are all pairs of tokens in a group. The documents that hold an id pair linked are
counted over the whole corpus: each slice lists its documents' distinct pairs once, in a
compact piece that is kept; tasks add up before the exchange. A pair with a share of at
least 1/COMMON of all (document, pair) entries is common, so there are at most COMMON of
them, and pieces look them up in a broadcast; all rarer pairs meet their counts in a join.

Defined cases: a null or empty text, and one that the second tokenizer does not spell
byte for byte (such as one that holds U+2581), has no tokens and zeros; repeated rows
count as documents of their own; a null id stays; other columns are ignored. A group of
many tokens is listed by its distinct ids, a block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import byte_bpe
from .byte_bpe import spread
from .common import checkpoint, slices
from .words import buffers

#: Text bytes of a piece; links of a group from which its ids are made distinct first; entries held at once; common pairs at most.
TEXT, CROWD, ENTRIES, COMMON = 1 << 20, 256, 1 << 22, 1_000_000
_SHIFT = 20  # bits of an id


def default_piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def load_pieces(path: str) -> Pieces:
    return Pieces(path)


class Pieces:
    """A sentencepiece model and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        raw = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.raw, self.at = np.frombuffer(b"".join(raw), np.uint8), _sums([len(r) for r in raw])
        self.length = np.diff(self.at)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of texts)."""
        got = self.sp.encode(texts, num_threads=1)
        rows = _sums([len(x) for x in got])
        return np.fromiter(chain.from_iterable(got), np.int64, rows[-1]), rows


def _sums(sizes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))]).astype(np.int64)


class Alignment:
    """Groups of both tokenizers over all texts of a string array."""

    def __init__(self, a: byte_bpe.Model, b: Pieces, texts: pa.Array):
        raw, offsets = buffers(texts)
        full = np.flatnonzero(np.diff(offsets))
        size = np.diff(offsets)[full] + 1
        start = _sums(size)
        data = np.full(start[-1], 0x20, np.uint8)
        data[spread(start[:-1] + 1, size - 1)] = raw
        ids, rows = b.encode(texts.take(pa.array(full)).to_pylist())
        width = b.length[ids]
        made = _sums(width)[rows]
        good = np.diff(made) == size
        n = np.diff(rows)
        spelt, of = b.raw[spread(b.at[ids], width)], np.repeat(np.arange(len(full)), np.diff(made))
        fair = good[of]
        wrong = spelt[fair] != data[spread(start[:-1][good], size[good])]
        good[of[fair][wrong]] = False
        token = good[np.repeat(np.arange(len(full)), n)]
        self.b, width = ids[token], width[token]
        n, size, begin = n[good], size[good], start[:-1][good]
        self.rows, self.texts = full[good], len(texts)
        first = np.cumsum(width) - width
        ends_b = first + width - np.repeat(first[_sums(n)[:-1]], n) + np.repeat(begin, n) if len(width) else width
        t = byte_bpe.encode_texts(a, data, begin, begin + size)
        self.a, ends_a = t.ids.astype(np.int64), t.start + a.length[t.ids]
        cut = np.bincount(np.concatenate([ends_a, ends_b]), minlength=len(data) + 1) == 2
        before = _sums(cut)  # cuts before each place
        self.group_a, self.group_b = before[ends_a], before[ends_b]
        self.of_doc = np.append(before[begin + 1], before[-1])  # first group of each document
        groups = before[-1]
        self.many_a, self.many_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)

    def column(self, values: np.ndarray) -> np.ndarray:
        """Values of aligned documents as a column of all rows; the others have 0."""
        out = np.zeros(self.texts, np.int64)
        out[self.rows] = values
        return out

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value of groups."""
        return self.column(np.diff(_sums(values)[self.of_doc]))

    def spelling(self) -> tuple[bytes, np.ndarray]:
        """(text, offsets of rows): decimal ids of each group's A tokens, a bar and its B tokens; groups apart by semicolons."""
        upto_a, upto_b = _sums(self.many_a), _sums(self.many_b)
        place_a = np.arange(len(self.a)) + upto_b[self.group_a]
        place_b = np.arange(len(self.b)) + upto_a[self.group_b + 1]
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[place_a], ids[place_b] = self.a, self.b
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[(upto_a + upto_b)[1:] - 1] = ord(";")
        mark[upto_a[1:] + upto_b[:-1] - 1] = ord("|")
        digits, at = _decimals(int(ids.max(initial=0)) + 1)
        size = np.diff(at)[ids] + 1
        ends = _sums(size)
        out = np.empty(ends[-1], np.uint8)
        out[ends[1:] - 1] = mark
        out[spread(ends[:-1], size - 1)] = digits[spread(at[ids], size - 1)]
        bounds = np.zeros(self.texts + 1, np.int64)
        doc = ends[(upto_a + upto_b)[self.of_doc]]
        bounds[self.rows + 1] = np.diff(doc)
        return out.tobytes(), np.cumsum(bounds)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(document, A id, B id) of linked ids as one sorted key, and how many links each has."""
        doc = np.searchsorted(self.of_doc, np.arange(len(self.many_a)), "right") - 1
        product = self.many_a * self.many_b
        at_a, at_b = _sums(self.many_a), _sums(self.many_b)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def add(keys: np.ndarray, n: np.ndarray | None) -> None:
            nonlocal held, size
            held.append(_merged([(keys, n)]))
            size += len(held[-1][0])
            if size > ENTRIES:
                held = [_merged(held)]
                size = 0

        small = np.flatnonzero(product <= CROWD)
        for at in range(0, len(small), ENTRIES // CROWD):
            g = small[at : at + ENTRIES // CROWD]
            many = product[g]
            k, of = spread(np.zeros(len(g), np.int64), many), np.repeat(g, many)
            add(self._key(doc[of], self.a[at_a[of] + k // self.many_b[of]], self.b[at_b[of] + k % self.many_b[of]]), None)
        for g in np.flatnonzero(product > CROWD):
            a, na = np.unique(self.a[at_a[g] : at_a[g + 1]], return_counts=True)
            b, nb = np.unique(self.b[at_b[g] : at_b[g + 1]], return_counts=True)
            block = max(1, ENTRIES // len(b))
            for at in range(0, len(a), block):
                add(self._key(doc[g], a[at : at + block, None], b[None, :]).ravel(), (na[at : at + block, None] * nb[None, :]).ravel())
        return _merged(held) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    @staticmethod
    def _key(doc, a, b):
        return (doc << 2 * _SHIFT) | (a << _SHIFT) | b


def _merged(parts: list[tuple[np.ndarray, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1 and parts[0][1] is None:
        return np.unique(parts[0][0], return_counts=True)
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    by = np.argsort(keys, kind="stable")
    keys, n = keys[by], n[by]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


@lru_cache(maxsize=4)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << max(16, (n - 1).bit_length())
    text = [str(i) for i in range(n)]
    return np.frombuffer("".join(text).encode(), np.uint8), _sums([len(t) for t in text])


# ---- pieces ------------------------------------------------------------------------------

_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _piece(id_array: pa.Array, al: Alignment, whole_text: bool) -> bytes:
    """A slice's documents and their distinct pairs, packed."""
    keys, links = al.pairs()
    of = keys >> 2 * _SHIFT
    out, at = al.spelling()
    view, text = memoryview(out), []
    for a, b in zip(at.tolist(), at[1:].tolist(), strict=False):
        body = view[a : max(a, b - 1)]
        text.append(bytes(body).decode() if whole_text else hashlib.sha256(body).hexdigest() if b > a else "")
    docs = pa.table(
        {
            "doc_id": id_array,
            "n_a": al.per_doc(al.many_a),
            "n_b": al.per_doc(al.many_b),
            "n_groups": al.column(np.diff(al.of_doc)),
            "n_links": al.per_doc(al.many_a * al.many_b),
            "groups": text,
            "pairs": al.column(np.bincount(of, minlength=len(al.rows))),
        }
    )
    pair = keys & ((1 << 2 * _SHIFT) - 1)
    entries = pa.table({"a": (pair >> _SHIFT).astype(np.uint32), "b": (pair & ((1 << _SHIFT) - 1)).astype(np.uint32), "m": links.astype(np.uint64)})
    packed = []
    for table in (docs, entries):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table.combine_chunks())
        packed.append(sink.getvalue().to_pybytes())
    return packed


def _opened(row: pa.RecordBatch, at: int) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """(documents, document of each entry, pair, links)."""
    docs = pa.ipc.open_stream(row.column("docs")[at].as_buffer()).read_all()
    entries = pa.ipc.open_stream(row.column("entries")[at].as_buffer()).read_all()
    pair = (entries["a"].to_numpy().astype(np.int64) << _SHIFT) | entries["b"].to_numpy()
    return docs, np.repeat(np.arange(len(docs)), docs["pairs"].to_numpy()), pair, entries["m"].to_numpy().astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, documents), added up over a task's pieces."""
    held: list = []
    size = 0

    def out(part) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part[0], pa.int64()), pa.array(part[1], pa.int64())], ["pair", "n"])

    for batch in batches:
        for at in range(batch.num_rows):
            held.append(_merged([(_opened(batch, at)[2], None)]))
            size += len(held[-1][0])
            if size > ENTRIES // 2:
                held = [_merged(held)]
                size = len(held[0][0])
                if size > ENTRIES // 4:
                    yield out(held[0])
                    held, size = [], 0
    if held:
        yield out(_merged(held))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_model: str | None = None, piece_model: str | None = None, whole_text: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of every row of ``docs``.

    ``groups`` is the groups' text (as in ``Alignment.spelling``) or, without ``whole_text``,
    its SHA-256 in hexadecimal; '' without tokens. ``n_best`` counts links whose pair no other
    pair of the same A id exceeds in documents; ``count_sum`` adds up the documents of all links' pairs.
    """
    paths = byte_model or byte_bpe.default_model(), piece_model or default_piece_model()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_bpe.load(paths[0]), load_pieces(paths[1])
        for batch in batches:
            for part in slices(batch, "text", TEXT):
                packed = _piece(part.column(0), Alignment(a, b, part.column(1)), whole_text)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in packed], ["docs", "entries"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    pieces = checkpoint(rows.mapInArrow(cut, "docs binary, entries binary").withColumn("piece", F.monotonically_increasing_id()))
    counted = pieces.select("entries", "docs").mapInArrow(_count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", _SHIFT))  # an A id has at most as many pairs as there are B ids
    counts = checkpoint(counted.withColumn("best", F.col("n") == F.max("n").over(of_a)))
    total = int(counts.agg(F.sum("n")).first()[0] or 0)
    often = F.col("n").cast("decimal(38)") * COMMON >= total
    table = counts.where(often).toArrow()  # at most COMMON rows
    by = np.argsort(table["pair"].to_numpy())
    common = pieces.sparkSession.sparkContext.broadcast((table["pair"].to_numpy()[by], table["n"].to_numpy()[by], table["best"].to_numpy()[by]))

    def look(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether it is common, its place)."""
        keys = common.value[0]
        at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
        return (keys[at] == pair if len(keys) else np.zeros(len(pair), bool)), at

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                docs, of, pair, m = _opened(batch, at)
                hit, place = look(pair)
                of, m, place, n = of[hit], m[hit], place[hit], len(docs)
                sums = [np.zeros(n, np.int64), np.zeros(n, np.int64)]
                np.add.at(sums[0], of, m * common.value[2][place])
                np.add.at(sums[1], of, m * common.value[1][place])
                columns = [pa.array(np.full(n, batch.column("piece")[at].as_py()), pa.int64()), pa.array(np.arange(n), pa.int64()), *(docs[c].combine_chunks() for c in ("doc_id", *_NUMBERS, "groups")), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, ["piece", "row", "doc_id", *_NUMBERS, "groups", "n_best", "count_sum"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                _, of, pair, m = _opened(batch, at)
                new = ~look(pair)[0]
                columns = [np.full(new.sum(), batch.column("piece")[at].as_py()), of[new], pair[new], m[new]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["piece", "row", "pair", "m"])

    base = pieces.mapInArrow(known, f"piece long, row long, doc_id long, {', '.join(f'{c} long' for c in _NUMBERS)}, groups string, n_best long, count_sum long")
    asked = pieces.mapInArrow(rare, "piece long, row long, pair long, m long").join(counts.where(~often), "pair")
    more = asked.groupBy("piece", "row").agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("best_more"), F.sum(F.col("m") * F.col("n")).alias("sum_more"))
    added = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0))).alias(c)
    return base.join(more, ["piece", "row"], "left").select("doc_id", *_NUMBERS, "groups", added("n_best", "best_more"), added("count_sum", "sum_more"))
