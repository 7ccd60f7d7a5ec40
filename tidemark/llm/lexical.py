"""Ranked lexical search over a windowed inverted index.

``index`` packs documents into windows of at most WINDOW documents, numbered in the order
of their ids inside a window, and keeps each window's postings term by term: a sorted
table of term hashes, and for each term its document numbers and occurrences. ``search``
traverses the postings of one window at a time. For each query it adds each term's weights
into one array of buckets, a document each, that stays in the processor's cache, and marks
the buckets in a bitset; of the words of the bitset that are not empty, the buckets over
the query's lowest kept score go to its heap. Heaps of tasks are merged in levels of
FAN_IN.

Statistics cover the whole index: documents that hold a term, documents and their terms.
Terms are compared by 64-bit hashes.

Defined cases: a null text, or one without a term, is no document of the statistics and
has no score; a row without an id counts in the statistics and is not ranked; rows that
share an id are ranked apart; an item whose text is null or has no term finds nothing;
items that share an id each have their results; other columns are ignored. Queries are
broadcast in groups of about QUERY_BYTES, one pass over the index for each group.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import spread
from .common import checkpoint, slices, text_bytes
from .words import LOWER, Spans, buffers

#: Documents and text bytes of a window, text bytes of queries of one pass, and tasks whose heaps are merged at once.
WINDOW, TEXT, QUERY_BYTES, FAN_IN = 8192, 4 << 20, 8 << 20, 64
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each term, term offsets of rows); A-Z are folded."""
    data, offsets = buffers(array)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)  # where a term cannot go on from the byte before
    edge[offsets] = True
    start = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    stop = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return Spans(LOWER[data])(start, stop), np.searchsorted(start, offsets)


# ---- index -------------------------------------------------------------------------------


class Postings:
    """A window: ids and lengths of its documents; postings (document number, occurrences) by term."""

    def __init__(self, ids, ranked, length, key, at, doc, tf):
        self.ids, self.ranked, self.length, self.key, self.at, self.doc, self.tf = ids, ranked, length, key, at, doc, tf

    @classmethod
    def build(cls, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Postings:
        """From (ids, whether there is one, terms of each row, term hashes) of runs of rows."""
        ids, ranked, length, key = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.lexsort((ids, ~ranked))
        number = np.empty(len(by), np.int64)
        number[by] = np.arange(len(by))
        term, back = np.unique(key, return_inverse=True)
        pair, tf = np.unique(back * WINDOW + np.repeat(number, length), return_counts=True)
        return cls(ids[by], ranked[by], length[by], term, np.searchsorted(pair // WINDOW, np.arange(len(term) + 1)), pair % WINDOW, tf)

    def packed(self) -> bytes:
        gaps = [self.ids.astype("<i8"), self.ranked.astype("u1"), self.length.astype("<i8"), self.key.astype("<u8"), np.diff(self.at).astype("<u2"), self.doc.astype("<u2"), self.tf.astype("<u4")]
        head = np.array([len(self.ids), len(self.key), len(self.doc)], "<i8")
        return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in (head, *gaps)))

    @classmethod
    def opened(cls, payload: bytes) -> Postings:
        raw = zstandard.ZstdDecompressor().decompress(payload)
        docs, keys, pairs = np.frombuffer(raw, "<i8", 3)
        out, at = [], 24
        for kind, n in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<u8", keys), ("<u2", keys), ("<u2", pairs), ("<u4", pairs)):
            out.append(np.frombuffer(raw, kind, n, at))
            at += out[-1].nbytes
        ids, ranked, length, key, many, doc, tf = out
        return cls(ids, ranked.astype(bool), length, key, np.concatenate([[0], np.cumsum(many.astype(np.int64))]), doc.astype(np.int64), tf.astype(np.int64))


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(n_docs, n_terms, payload): the windows of all rows of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        rows = size = 0

        def flush() -> pa.RecordBatch:
            w = Postings.build(held)
            return pa.RecordBatch.from_pydict({"n_docs": [len(w.ids)], "n_terms": [int(w.length.sum())], "payload": [w.packed()]})

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                for at in range(0, part.num_rows, WINDOW):
                    some = part.slice(at, WINDOW)
                    key, ends = terms(some.column(1))
                    n = np.diff(ends)
                    full = n > 0
                    if rows + full.sum() > WINDOW:
                        yield flush()
                        held, rows, size = [], 0, 0
                    ids = some.column(0)
                    held.append((ids.fill_null(0).to_numpy(zero_copy_only=False)[full], ids.is_valid().to_numpy(zero_copy_only=False)[full], n[full], key))
                    rows, size = rows + int(full.sum()), size + some.nbytes
                    if size >= TEXT:
                        yield flush()
                        held, rows, size = [], 0, 0
        if rows:
            yield flush()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "n_docs long, n_terms long, payload binary")


# ---- search ------------------------------------------------------------------------------


class Queries:
    """Distinct terms of each query, as places in one sorted table of terms."""

    def __init__(self, texts: pa.Array):
        key, ends = terms(texts)
        row = np.repeat(np.arange(len(texts)), np.diff(ends))
        self.term, back = np.unique(key, return_inverse=True)
        pair = np.unique(row * (len(self.term) + 1) + back)
        self.places = pair % (len(self.term) + 1)
        self.at = np.searchsorted(pair // (len(self.term) + 1), np.arange(len(texts) + 1))


def _found(w: Postings, term: np.ndarray) -> np.ndarray:
    """The place of each term in a window's table, -1 if it is not there."""
    at = np.minimum(np.searchsorted(w.key, term), max(len(w.key) - 1, 0))
    return np.where(w.key[at] == term, at, -1) if len(w.key) else np.full(len(term), -1)


def score_window(w: Postings, q: Queries, weight: np.ndarray, n_docs: int, n_terms: int, k: int, heaps: list[list[tuple[int, int]]]) -> None:
    """Push the window's best documents on the heap of each query, as (score, -id), at most k on each."""
    place = _found(w, q.term)
    here = np.flatnonzero((place >= 0) & (weight > 0))
    if not len(here):
        return
    size = w.at[place[here] + 1] - w.at[place[here]]
    posting = spread(w.at[place[here]], size)
    doc = w.doc[posting]
    m = 10 + (90 * w.length * n_docs) // n_terms
    tf = w.tf[posting]
    part = np.repeat(weight[here], size) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    first = np.full(len(q.term) + 1, -1)
    first[here] = np.cumsum(size) - size
    many = np.zeros(len(q.term), np.int64)
    many[here] = size
    words = -(-len(w.ids) // 64)
    bucket, mark = np.zeros(words * 64, np.int64), np.zeros(words * 64, np.uint8)
    ranked = np.zeros(words * 64, bool)
    ranked[: len(w.ids)] = w.ranked
    for i in range(len(q.at) - 1):
        hit = False
        for t in q.places[q.at[i] : q.at[i + 1]].tolist():
            a, n = first[t], many[t]
            if n:
                d = doc[a : a + n]  # a document stands once in a term's postings
                bucket[d] += part[a : a + n]
                mark[d] = 1
                hit = True
        if not hit:
            continue
        occupied = np.flatnonzero(np.packbits(mark).view(np.uint64))
        heap = heaps[i]
        least = heap[0][0] if len(heap) == k else 1
        scores = bucket.reshape(-1, 64)[occupied]
        over = (scores >= least) & ranked.reshape(-1, 64)[occupied]
        row, column = np.nonzero(over)
        score, number = scores[row, column], occupied[row] * 64 + column
        if len(score) > k:  # of a window, the k best at most; earlier numbers have smaller ids
            top = np.lexsort((number, -score))[:k]
            score, number = score[top], number[top]
        for s, d in zip(score.tolist(), w.ids[number].tolist(), strict=True):
            if len(heap) < k:
                heapq.heappush(heap, (s, -d))
            elif (s, -d) > heap[0]:
                heapq.heapreplace(heap, (s, -d))
        bucket.reshape(-1, 64)[occupied] = 0
        mark.reshape(-1, 64)[occupied] = 0


def search(windows: DataFrame, items: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of each item with the highest scores over 0, ties to smaller ids.

    ``windows``: an index that was written or checkpointed, as every pass reads it twice.
    """
    total = windows.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = int(total["n"] or 0), int(total["l"] or 0)
    rows = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    passes = max(1, -(-text_bytes(rows, "text") // QUERY_BYTES))
    out = None
    for turn in range(passes):
        group = rows if passes == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == turn)
        got = _search(windows, group, k, n_docs, n_terms)
        out = got if out is None else out.unionByName(got)
    return out


def _search(windows: DataFrame, items: DataFrame, k: int, n_docs: int, n_terms: int) -> DataFrame:
    sc = windows.sparkSession.sparkContext
    table = items.toArrow()  # about QUERY_BYTES of text
    q = Queries(table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string()))
    shared = sc.broadcast(q)

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(shared.value.term), np.int64)
        for batch in batches:
            for payload in batch.column("payload"):
                w = Postings.opened(payload.as_buffer())
                at = _found(w, shared.value.term)
                there = at >= 0
                df[there] += np.diff(w.at)[at[there]]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some], pa.int64())], ["term", "df"])

    df = windows.select("payload").mapInArrow(frequency, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # at most a row for each term of the queries
    weight = np.zeros(len(q.term), np.int64)
    for t, n in zip(df["term"].to_pylist(), df["df"].to_pylist(), strict=True):
        weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
    weights = sc.broadcast(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        heaps: list[list[tuple[int, int]]] = [[] for _ in range(len(q.at) - 1)]
        for batch in batches:
            for payload in batch.column("payload"):
                score_window(Postings.opened(payload.as_buffer()), q, weights.value, n_docs, n_terms, k, heaps)
        flat = [(i, -d, s) for i, heap in enumerate(heaps) for s, d in heap]
        columns = list(zip(*flat, strict=True)) if flat else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    found = windows.select("payload").mapInArrow(run, "item long, doc_id long, score long").withColumn("part", F.spark_partition_id())
    parts = windows.rdd.getNumPartitions()
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        found = _merge(found.withColumn("part", F.expr(f"part div {FAN_IN}")), ["item", "part"], k).drop("rank")
    best = _merge(found, ["item"], k)
    names = items.sparkSession.createDataFrame(pa.table({"item": pa.array(range(table.num_rows), pa.int64()), "item_id": table["item_id"]}))
    return best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _merge(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index all of ``docs`` and search it for ``items``."""
    return search(checkpoint(index(docs, id_col, text_col)), items, k)
