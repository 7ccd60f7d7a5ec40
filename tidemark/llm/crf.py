"""Language identification by a linear-chain conditional random field over words.

A word's emission is a sum of hashed weights: the word itself (lexicon), prefixes and
suffixes of 1 to 3 bytes, and byte pairs and triples. They are
learned by gradient steps on the chains' log-likelihood, start weights likewise, and
transition weights by iterative scaling until expected and labelled switches agree. Forward-backward
gives each word's language probabilities, hence runs of languages in code-switched
text; a document's language has the largest mean probability. A chain is a whole text.
It is worked in blocks of BLOCK words, side by side: a block's product of step matrices
carries the forward and backward messages over it, so that the result is the chain's.

The model is fitted on a bounded sample: of every language among the labelled rows at
most PER_LANGUAGE documents and BYTES of text, chosen by hash, with their whole texts.
A word's label is its document's language, except in runs of RUN or more words that the
sample knows from one other language only: those are labelled with that language, and
so are the switches that the transitions learn from. One switch of each kind is added.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and has no
runs; with no labelled document everything is ``und``; ties go to the language first
by name; of sample rows that share id and language the smallest text is learned; every
row is labelled, repeated ones alike; columns named lang_pred, score or runs are
replaced, others pass through. The model takes ROWS * 4 bytes a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices
from .words import U, Words, map_rows, mix, words

#: Sample bounds, words of a block, rows of weights, training sweeps, their rate, words of a foreign run, ids that may be broadcast, and parts of a language that are ranked apart.
PER_LANGUAGE, BYTES, BLOCK, ROWS, SWEEPS, RATE, RUN, IDS, SALT = 300, 1 << 20, 64, 1 << 17, 25, 0.5, 3, 1_000_000, 64


def word_features(w: Words, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weight rows, offsets) of the words with the given indices."""
    starts, ends = w.starts[of], w.ends[of]
    size = ends - starts
    keys, owner = [mix(w.hashes[of] + U(1))], [np.arange(len(of))]
    for n in (1, 2, 3):
        long = np.flatnonzero(size >= n)
        for tag, a in ((10 + n, starts[long]), (20 + n, ends[long] - n)):
            keys.append(mix(w.spans(a, a + n) + U(tag)))
            owner.append(long)
    wide = w.data.astype(np.uint32)
    for n, tag in ((2, 1 << 26), (3, 1 << 27)):
        count = np.maximum(size - n + 1, 0)
        at = np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(count.sum())
        gram = sum(wide[at + k] << np.uint32(8 * k) for k in range(n)) if len(at) else np.zeros(0, np.uint32)
        keys.append(mix(gram.astype(U) + U(tag)))
        owner.append(np.repeat(np.arange(len(of)), count))
    key, own = np.concatenate(keys), np.concatenate(owner)
    by = np.argsort(own, kind="stable")
    return (key[by] & U(ROWS - 1)).astype(np.int64), np.searchsorted(own[by], np.arange(len(of) + 1))


def _scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of one or two axes) that sum to one, and what they summed to."""
    total = x.sum(tuple(range(1, x.ndim)))
    return x / total.reshape(-1, *[1] * (x.ndim - 1)), total


def _carried(e: np.ndarray, a: np.ndarray, start: np.ndarray, first: np.ndarray, length: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(message into each block, message back into its end, log of the scales); ``parts``: blocks of each text, in order."""
    n = e.shape[1]
    ahead, back = np.tile(start, (len(first), 1)), np.ones((len(first), n), e.dtype)
    if parts.max(initial=0) < 2:
        return ahead, back, 0.0
    to = np.cumsum(parts)
    of = np.flatnonzero(np.repeat(parts > 1, parts))
    by = of[np.argsort(-length[of], kind="stable")]
    product = np.zeros((len(by), n, n), e.dtype)
    product[:, np.arange(n), np.arange(n)] = e[first[by]]
    for t in range(1, int(length[by[0]])):
        k = int(np.searchsorted(-length[by], -t, "left"))
        product[:k] = _scaled((product[:k] @ a) * e[first[by[:k]] + t][:, None, :])[0]
    place = np.empty(len(first), np.int64)
    place[by] = np.arange(len(by))
    texts = np.argsort(-parts, kind="stable")
    texts, begin, logs = texts[parts[texts] > 1], (to - parts)[texts[parts[texts] > 1]], 0.0
    many = parts[texts]
    for k in range(1, int(many[0])):
        at = begin[: int(np.searchsorted(-many, -k, "left"))] + k
        last, _ = _scaled(np.einsum("bi,bij->bj", ahead[at - 1], product[place[at - 1]]))
        ahead[at], total = _scaled(last @ a)
        logs += float(np.log(total, dtype=np.float64).sum())
    for k in range(int(many[0]) - 1, 0, -1):
        at = begin[: int(np.searchsorted(-many, -k, "left"))] + k
        back[at - 1] = _scaled(np.einsum("bij,bj->bi", product[place[at]], back[at]) @ a.T)[0]
    return ahead, back, logs


def forward_backward(emit: np.ndarray, rows: np.ndarray, begin: np.ndarray, trans: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """(posterior of each word, log Z of all chains, expected starts, expected transitions); rows: word offsets of the texts."""
    top = emit.max(1, keepdims=True) if len(emit) else emit
    e, a = np.exp(emit - top), np.exp(trans).astype(emit.dtype)
    sizes = np.diff(rows)
    parts = -(-sizes // block)
    within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(rows[:-1], parts) + within * block
    length = np.minimum(block, np.repeat(rows[1:], parts) - first)
    ahead, back, log_z = _carried(e, a, np.exp(begin).astype(emit.dtype), first, length, parts[parts > 0])
    by = np.argsort(-length, kind="stable")
    first, length, now, beta = first[by], length[by], ahead[by], back[by]
    alpha, behind = np.zeros_like(e), np.zeros_like(e)
    steps = int(length[0]) if len(length) else 0
    active = [int(np.searchsorted(-length, -t, "left")) for t in range(steps)]  # blocks longer than t
    for t in range(steps):
        at = first[: active[t]] + t
        now, total = _scaled(e[at] * (now if t == 0 else now[: active[t]] @ a))
        alpha[at] = now
        log_z += float(np.log(total, dtype=np.float64).sum())
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        behind[at] = beta[:k]
        beta[:k] = _scaled((e[at] * beta[:k]) @ a.T)[0]
    post = alpha * behind
    post /= np.maximum(post.sum(1, keepdims=True), 1e-30)
    follows = np.ones(len(e), bool)
    follows[rows[:-1][sizes > 0]] = False
    at = np.flatnonzero(follows)
    right = e[at] * behind[at]
    norm = ((alpha[at - 1] @ a) * right).sum(1, keepdims=True)
    pairs = a * (alpha[at - 1].T @ (right / np.maximum(norm, 1e-30)))
    return post, log_z + float(top.sum(dtype=np.float64)), post[~follows].sum(0), pairs


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray
    begin: np.ndarray
    trans: np.ndarray

    def posteriors(self, w: Words) -> np.ndarray:
        """Language probabilities of each word."""
        if not len(w.hashes):
            return np.zeros((0, len(self.labels)), np.float32)
        _, one, back = np.unique(w.hashes, return_index=True, return_inverse=True)
        rows, at = word_features(w, one)
        emit = np.add.reduceat(self.weights[rows], at[:-1], axis=0)[back]
        return forward_backward(emit, w.rows, self.begin, self.trans)[0]


def foreign_runs(word: np.ndarray, gold: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Labels of words: ``gold``, but another language's in runs of words that the sample knows from it alone."""
    seen = np.zeros((int(word.max(initial=-1)) + 1, n), np.int64)
    np.add.at(seen, (word, gold), 1)
    home = seen.argmax(1)
    most = seen[np.arange(len(seen)), home]
    sure = (most >= 5) & (most >= 20 * (seen.sum(1) - most))
    other = np.where(sure[word] & (home[word] != gold), home[word], -1)
    cut = np.ones(len(word), bool)
    cut[1:] = other[1:] != other[:-1]
    cut[rows[:-1][np.diff(rows) > 0]] = True
    run = np.cumsum(cut) - 1
    long = (np.bincount(run) >= RUN)[run] if len(run) else np.zeros(0, bool)
    return np.where(long & (other >= 0), other, gold)


def train(texts: list[str], langs: list[str]) -> Crf:
    """Fit on whole labelled texts."""
    labels = sorted(set(langs))
    n = len(labels)
    w = words(pa.array(texts, pa.string()), lower=True)
    crf = Crf(labels, np.zeros((ROWS, n), np.float32), np.zeros(n, np.float32), np.zeros((n, n), np.float32))
    if not len(w.hashes) or n < 2:
        return crf
    _, one, word = np.unique(w.hashes, return_index=True, return_inverse=True)
    name = {x: k for k, x in enumerate(labels)}
    gold = foreign_runs(word, np.array([name[x] for x in langs])[w.row], w.rows, n)
    rows, at = word_features(w, one)
    sizes = np.diff(at)
    starts_at = w.rows[:-1][np.diff(w.rows) > 0]
    starts = np.bincount(gold[starts_at], minlength=n)
    follows = np.ones(len(gold), bool)
    follows[starts_at] = False
    at_follow = np.flatnonzero(follows)
    moves = np.bincount(gold[at_follow - 1] * n + gold[at_follow], minlength=n * n).reshape(n, n)
    balance = (1 / np.maximum(np.bincount(gold, minlength=n), 1))[gold].astype(np.float32)
    balance *= len(gold) / n
    sums = [np.full(ROWS, 1e-3, np.float32) for _ in range(n)]
    for sweep in range(SWEEPS):
        emit = np.add.reduceat(crf.weights[rows], at[:-1], axis=0)[word]
        post, _, start_seen, pair_seen = forward_backward(emit, w.rows, crf.begin, crf.trans)
        rate = RATE / (1 + sweep / 10)
        error = -post
        error[np.arange(len(gold)), gold] += 1
        error *= balance[:, None]
        for k in range(n):
            by_word = np.bincount(word, error[:, k], len(one))
            step = np.bincount(rows, np.repeat(by_word, sizes), ROWS).astype(np.float32) / len(gold)
            sums[k] = 0.9 * sums[k] + 0.1 * np.abs(step) if sweep else np.abs(step) + 1e-9
            crf.weights[:, k] += rate * 0.2 * step / (sums[k] + 1e-5)
        crf.begin += (rate * (starts - start_seen) / len(starts_at)).astype(np.float32)
        crf.trans += (rate * 0.2 * np.log((moves + 1) / (pair_seen + 1))).astype(np.float32)  # an iterative scaling step
    return crf


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Crf:
    """Fit on the bounded sample of rows where ``learn`` holds and the language is not null."""
    rows = docs.where(learn & F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    rows = rows.select(F.col(f"`{id_col}`").alias("d"), F.col(f"`{text_col}`").alias("t"), F.col(f"`{lang_col}`").alias("l"))
    order = Window.partitionBy("l").orderBy(F.xxhash64("d"), "d")
    salted = Window.partitionBy("l", F.pmod(F.xxhash64("d"), F.lit(SALT))).orderBy(F.xxhash64("d"), "d")
    ids = rows.select("l", "d").distinct()
    for each in (salted, order):  # so that a language's last choice is among PER_LANGUAGE * SALT ids at most
        ids = ids.withColumn("n", F.row_number().over(each)).where(F.col("n") <= PER_LANGUAGE).select("d", "l")
    languages = rows.select("l").distinct().count()
    chosen = F.broadcast(ids) if languages * PER_LANGUAGE <= IDS else ids
    sample = rows.join(chosen, ["d", "l"]).groupBy("d", "l").agg(F.min("t").alias("t"))
    bytes_ = F.sum(F.octet_length("t")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    got = sample.withColumn("b", bytes_).where(F.col("b") <= BYTES).select("t", "l").orderBy("l", F.xxhash64("t")).toArrow()
    return train(got["t"].to_pylist(), got["l"].to_pylist())


_RUNS = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("first_word", T.IntegerType()), T.StructField("end_word", T.IntegerType())]))


def label(docs: DataFrame, crf: Crf, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and runs: words [first_word, end_word) of each language."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)
    kind = pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("end_word", pa.int32())])
    fields = [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()), pa.field("runs", pa.list_(kind))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array([*model.labels, "und"])
        for batch in batches:
            for part in slices(batch, text_col, 1 << 18):
                yield map_rows(part.drop_columns(["__td_letter"]), fields, one(model, names, part))

    def one(model: Crf, names: pa.Array, part: pa.RecordBatch) -> list[pa.Array]:
        w = words(part.column(text_col), lower=True)
        n = part.num_rows
        letter = part.column("__td_letter").fill_null(False).to_numpy(zero_copy_only=False) & (np.diff(w.rows) > 0)
        post = model.posteriors(w) if model.labels else np.zeros((len(w.hashes), 1), np.float32)
        sums = np.zeros((n, post.shape[1]))
        full = np.flatnonzero(np.diff(w.rows))
        if len(full):
            sums[full] = np.add.reduceat(post, w.rows[full], axis=0, dtype=np.float64) / np.diff(w.rows)[full, None]
        best = sums.argmax(1)
        known = letter & bool(model.labels)
        lang = np.where(known, best, len(names) - 1)
        score = np.where(known, np.clip(sums[np.arange(n), best], 0, 1), 0.0)
        word, row = post.argmax(1), w.row
        change = np.ones(len(word), bool)
        change[1:] = (word[1:] != word[:-1]) | (row[1:] != row[:-1])
        change &= known[row]
        at = np.flatnonzero(change)
        end = np.append(at[1:], len(word))
        end = np.minimum(end, w.rows[row[at] + 1])
        offsets = np.searchsorted(row[at], np.arange(n + 1))
        base = w.rows[row[at]]
        parts = pa.StructArray.from_arrays([names.take(pa.array(word[at])), pa.array((at - base).astype(np.int32)), pa.array((end - base).astype(np.int32))], fields=list(kind))
        return [names.take(pa.array(lang)), pa.array(score), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts)]

    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("runs", _RUNS)]
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "runs")]
    return docs.withColumn("__td_letter", F.col(text_col).rlike(r"\p{L}")).mapInArrow(run, T.StructType([*kept, *made]))
