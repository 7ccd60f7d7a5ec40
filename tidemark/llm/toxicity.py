"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max index.

Terms are lower-cased words and their first 4, 6 and 8 bytes; every term of the
labelled sample is in the vocabulary. A term weighs (1 + log tf) * idf * contrast: idf
counts every document, and contrast, z**2 / (z**2 + Z**2), follows how far the term's
document frequencies in the two classes of the sample lie apart, so that a term that
tells nothing counts for little and none is left out. A text and the labelled examples
are unit vectors of those weights. The index holds each term's postings in blocks of
examples, with the block's largest weight; the few terms that stand in one of thirty-two
examples or more are a dense table, whose part of the cosines is a matrix product. Blocks
are visited by falling upper bound and left out once the bound is below the k-th
similarity found, so the neighbours are exact. They vote with weight similarity**2 over a prior; an isotonic fit of
leave-one-out votes turns votes into scores.

Defined cases: a null or empty text, or one without a vocabulary term, gets the rate
of toxic labels among examples without one; labels other than 0 and 1 are ignored, a
document labelled both ways counts as toxic; of sample rows that share an id the
smallest text is the example; without labels every score is 0; ties between
neighbours (cosines that agree to six places) go to the smaller example id; every row of ``docs`` is scored, repeated ids
and texts alike; in ``score`` columns named score, predicted or evidence are replaced, others
pass through; ``accepted`` changes no column.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices
from .words import U, Words, bare_words, map_rows, mix

#: Labelled examples of a class, bytes of their texts (a class), z of a half contrast, neighbours, examples in a block, share of the examples that makes a term dense, texts in a product, the prior's weight, and the score from which a text is called toxic.
EXAMPLES, BYTES, Z, NEIGHBOURS, BLOCK, DENSE, TOGETHER, PRIOR, LIMIT = 1000, 16 << 20, 6.0, 15, 32, 1 / 32, 64, 1.0, 0.3
_PREFIXES = (4, 6, 8)


def terms(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every term occurrence."""
    row = w.row
    keys, rows = [w.hashes], [row]
    for k, n in enumerate(_PREFIXES):
        of = np.flatnonzero(w.ends - w.starts >= n)
        keys.append(mix(w.spans(w.starts[of], w.starts[of] + n) + U(k + 1)))
        rows.append(row[of])
    return np.concatenate(keys), np.concatenate(rows)


class Vocabulary:
    """Sorted term hashes with a bitmap that tells most foreign ones apart."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << 22, bool)
        self.bits[keys >> U(42)] = True

    def counted(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, count) of the terms that are known, by row then term."""
        near = np.flatnonzero(self.bits[hashes >> U(42)])
        hashes, rows = hashes[near], rows[near]
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == hashes if len(self.keys) else np.zeros(len(hashes), bool)
        pair, count = np.unique(rows[hit] * (len(self.keys) + 1) + at[hit], return_counts=True)
        return pair // (len(self.keys) + 1), pair % (len(self.keys) + 1), count


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of runs [start, start + size), one after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Index:
    """Unit vectors of the examples, by term, then block, then example."""

    def __init__(self, vocabulary: Vocabulary, weight: np.ndarray, ids: np.ndarray, labels: np.ndarray, share: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray):
        """``row``, ``term``, ``count``: terms of the examples; ``weight`` of each term; ``share``: rows that an example stands for."""
        self.vocabulary, self.weight, self.wide = vocabulary, weight, BLOCK
        value = (1 + np.log(count)) * weight[term]
        norm = np.sqrt(np.bincount(row, value * value, len(ids)))
        good = value > 0
        row, term, value = row[good], term[good], value[good] / norm[row[good]]
        has = norm > 0
        strongest = np.full(len(ids), len(weight))
        by = np.lexsort((value, row))
        strongest[row[by]] = term[by]  # the last one of a row stays
        order = np.lexsort((ids, strongest))
        order = order[has[order]]
        place = np.full(len(ids), -1)
        place[order] = np.arange(len(order))
        self.ids, self.labels, self.share = ids[order], labels[order].astype(float), share[order]
        self.prior = float((share * labels).sum() / share.sum()) if len(ids) else 0.0
        self.empty = float((share * labels)[~has].sum() / share[~has].sum()) if (~has).any() else self.prior
        example = place[row]
        dense = np.flatnonzero(np.bincount(term, minlength=len(weight)) > DENSE * len(order))
        self.column = np.full(len(weight), -1, np.int32)
        self.column[dense] = np.arange(len(dense))
        column = self.column[term]
        of = column >= 0
        self.table = np.zeros((len(dense), len(order)), np.float32)
        self.table[column[of], example[of]] = value[of]
        term, example, value = term[~of], example[~of], value[~of]
        by = np.lexsort((example, term))
        term, example, value = term[by], example[by], value[by]
        block = example // self.wide
        cut = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(by) else np.zeros(0, np.int64)
        self.blocks = -(-len(order) // self.wide)
        self.example, self.value = example.astype(np.int32), value.astype(np.float32)
        self.from_block = np.append(cut, len(by)).astype(np.int32)
        self.block = block[cut].astype(np.int32)
        self.most = np.maximum.reduceat(self.value, cut) if len(cut) else np.zeros(0, np.float32)
        self.from_term = np.searchsorted(term[cut], np.arange(len(weight) + 1)).astype(np.int32)
        self.knots: tuple = ((0.0,), (0.0,))

    def search(self, vectors: Iterator[tuple[int, np.ndarray, np.ndarray]], leave: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(row, examples, cosines) of the NEIGHBOURS nearest with a positive cosine of each vector; ``leave[row]`` is left out."""
        while some := list(islice(vectors, TOGETHER)):
            query = np.zeros((len(some), len(self.table)), np.float32)
            for k, (_, term, weight) in enumerate(some):
                column = self.column[term]
                query[k, column[column >= 0]] = weight[column >= 0]
            common = query @ self.table
            for (row, term, weight), dense in zip(some, common, strict=True):
                rare = self.column[term] < 0
                yield row, *self.nearest(term[rare], weight[rare], dense, -1 if leave is None else leave[row])

    def nearest(self, term: np.ndarray, weight: np.ndarray, dense: np.ndarray, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) by falling bound of the blocks; ``dense``: what the dense terms add to each example's cosine."""
        n = self.from_term[term + 1] - self.from_term[term]
        pair = _spread(self.from_term[term], n)
        own, block = np.repeat(weight, n), self.block[pair]
        upper = np.bincount(block, own * self.most[pair], self.blocks) if len(pair) else np.zeros(self.blocks)
        upper += np.maximum.reduceat(dense, np.arange(0, len(dense), self.wide))
        order = np.argsort(-upper, kind="stable")
        best, sims, at, step = np.zeros(0, np.int64), np.zeros(0), 0, 8
        lane = np.arange(self.wide)
        while at < len(order):
            least = max(sims[-1] - 1e-6, 1e-6) if len(sims) == NEIGHBOURS else 1e-6
            some = order[at : at + step]
            some = some[upper[some] > least]
            if not len(some):
                break
            open_ = np.zeros(self.blocks, bool)
            open_[some] = True
            here = np.flatnonzero(open_[block])
            first = self.from_block[pair[here]]
            many = self.from_block[pair[here] + 1] - first
            of = _spread(first, many)
            got = np.bincount(self.example[of], np.repeat(own[here], many) * self.value[of], len(self.ids)) + dense
            if leave >= 0:
                got[leave] = 0
            lanes = (some[:, None] * self.wide + lane).ravel()
            lanes = lanes[lanes < len(got)]
            good = lanes[got[lanes] >= least]
            best, sims = np.concatenate([best, good]), np.concatenate([sims, got[good]])
            top = np.lexsort((self.ids[best], -np.round(sims, 6)))[:NEIGHBOURS]
            best, sims = best[top], sims[top]
            at, step = at + step, step * 4
        return best, sims

    def vote(self, best: np.ndarray, sims: np.ndarray) -> float:
        w = sims**2 * self.share[best]
        return float((w @ self.labels[best] + PRIOR * self.prior) / (w.sum() + PRIOR))

    def vectors(self, row: np.ndarray, term: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(row, terms, unit weights) of the rows whose terms weigh something."""
        value = (1 + np.log(count)) * self.weight[term]
        cuts = np.flatnonzero(np.diff(row)) + 1
        for r, t, w in zip(np.split(row, cuts), np.split(term, cuts), np.split(value, cuts), strict=True):
            if len(r) and (norm := np.sqrt(w @ w)) > 0:
                yield int(r[0]), t, w / norm

    def calibrated(self, vote: float) -> float:
        return float(np.clip(np.interp(vote, *self.knots), 0, 1))


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the weighted isotonic fit of y on x (pool adjacent violators)."""
    by = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[by].tolist(), y[by].tolist(), w[by].tolist(), strict=True):
        pools.append([a, a, b * c, c])
        while len(pools) > 1 and (pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3] or pools[-2][1] == pools[-1][0]):
            last = pools.pop()
            pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
    xs = [v for p in pools for v in (p[0], p[1])]
    return np.array(xs), np.array([p[2] / p[3] for p in pools for _ in range(2)])


def contrast(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Weight in [0, 1) of terms by their document frequencies in the sample's classes."""
    n0, n1 = max(1, n_clean), max(1, n_toxic)
    p = (clean + toxic + 1) / (n0 + n1 + 2)
    z2 = (toxic / n1 - clean / n0) ** 2 / (p * (1 - p) * (1 / n0 + 1 / n1))
    return z2 / (z2 + Z * Z)


def _labelled(labels: DataFrame, learn: Column) -> DataFrame:
    good = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learn)
    return good.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))


def sampled(text: DataFrame, marked: DataFrame) -> pa.Table:
    """(doc_id, text, y): at most EXAMPLES documents and BYTES of text of each class, first by hash of the id."""
    chosen = [marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXAMPLES) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    rows = text.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))  # at most 2 * EXAMPLES ids
    order = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("bytes", F.sum(F.octet_length("text")).over(order)).where(F.col("bytes") <= BYTES)
    return rows.select("doc_id", "text", "y").orderBy("doc_id").toArrow()


def frequencies(text: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """(documents that hold each term, all documents); each task counts first."""
    shared, size = text.sparkSession.sparkContext.broadcast(vocabulary), len(vocabulary.keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, np.int64)
        for batch in batches:
            n += batch.num_rows
            for part in slices(batch, "text", 1 << 20):
                total += np.bincount(shared.value.counted(*terms(bare_words(part.column(0))))[1], minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))], ["t", "n"])

    got = text.select("text").mapInArrow(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()  # a row a term of the sample
    shared.destroy()
    t, n = got["t"].to_numpy(), got["n"].to_numpy()
    df = np.zeros(size + 1, np.int64)
    df[t] = n  # -1, the last place, has all documents
    return df[:-1], int(df[-1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Fit on the bounded sample of labelled documents where ``learn`` holds (of ``labels``); idf over all documents."""
    text = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    marked = _labelled(labels, learn)
    totals = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    got = sampled(text, marked)
    ids, y = got["doc_id"].to_numpy(), got["y"].to_numpy()
    found, at = [], 0
    for batch in got.to_batches():
        for part in slices(batch, "text", 1 << 18):  # bounded scratch memory on the driver: each slice keeps its distinct terms
            keys, row = terms(bare_words(part.column(1)))
            by = np.lexsort((keys, row))
            keys, row = keys[by], row[by]
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])])) if len(keys) else np.zeros(0, np.int64)
            found.append((keys[first], (row[first] + at).astype(np.int32), np.diff(np.append(first, len(keys))).astype(np.int32)))
            at += part.num_rows
    del got
    keys, row, count = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, np.int32))
    del found
    vocabulary = Vocabulary(np.unique(keys))
    term = np.searchsorted(vocabulary.keys, keys).astype(np.int32)
    del keys
    size = len(vocabulary.keys)
    sizes = np.bincount(y, minlength=2)
    apart = contrast(*(np.bincount(term[y[row] == k], minlength=size) for k in (0, 1)), *sizes.tolist())
    df, n_docs = frequencies(text, vocabulary)
    weight = (np.log((1 + n_docs) / (1 + df)) + 1) * apart
    share = np.array([totals.get(k, 0) / max(1, sizes[k]) for k in (0, 1)])
    index = Index(vocabulary, weight, ids, y, share[y] if len(y) else np.zeros(0), row, term, count)
    if len(index.ids):
        place = {d: k for k, d in enumerate(index.ids.tolist())}
        at = np.array([place.get(d, -1) for d in ids.tolist()])
        known = list(index.search(index.vectors(row, term, count), at))
        votes, of = np.array([index.vote(best, sims) for _, best, sims in known]), at[[r for r, _, _ in known]]
        index.knots = isotonic(votes, index.labels[of], index.share[of])
    return index


_NEAR = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("toxic", T.IntegerType())]))


def _scores(ix: Index, texts: pa.Array, evidence: int = 0) -> tuple[np.ndarray, list[list[dict]]]:
    """(scores, nearest examples) of a string array."""
    scores, notes = np.full(len(texts), ix.empty), [[]] * len(texts)
    found = ix.vectors(*ix.vocabulary.counted(*terms(bare_words(texts))))
    for row, best, sims in ix.search(found):
        notes[row] = [{"doc_id": int(ix.ids[b]), "cosine": float(s), "toxic": int(ix.labels[b])} for b, s in zip(best[:evidence], sims, strict=False)]
        scores[row] = ix.calibrated(ix.vote(best, sims))
    return scores, notes


def score(docs: DataFrame, index: Index, text_col: str = "text", evidence: int = 3) -> DataFrame:
    """``docs`` with score (double), predicted (int) and evidence: the nearest examples with cosine and label."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    near = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
    fields = [pa.field("score", pa.float64()), pa.field("predicted", pa.int32()), pa.field("evidence", near)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                scores, notes = _scores(shared.value, part.column(text_col), evidence)
                yield map_rows(part, fields, [pa.array(scores), pa.array((scores >= LIMIT).astype(np.int32)), pa.array(notes, near)])

    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted", "evidence")]
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", _NEAR)]))


def accepted(docs: DataFrame, index: Index, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is under LIMIT."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                yield part.filter(pa.array(_scores(shared.value, part.column(text_col))[0] < LIMIT))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
