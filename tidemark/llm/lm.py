"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

Every word has a place in a tree of classes, LEVELS deep and WAYS wide: the first digit
is a hash of its last two bytes, the others are hashes of the word. A token's probability
is the product of a softmax at each level, given the history and the classes above, and
of the token's share of its last class by smoothed counts. Every softmax has hashed
features: the word before, the two words before, and the word before that one alone (a
skip), each crossed with the class above. With WAYS ** LEVELS last classes a frequent
word has its own nearly for itself, so that features bear on words. The biases of all
softmaxes are the classes' shares of the training tokens.

Token counts cover every training document, and so does the training, in ROUNDS: each
round takes its share of the documents, by a hash of id and text, and deals it to SHARDS
shards by another one, whatever the size of the corpus. A shard is one task, which makes
gradient steps over its own documents from the weights of the round before. A row takes
the mean of the shards' steps, weighed by their uses of it; one that is used less than
SELDOM times takes more of their sum. A larger cluster trains with more shards (an
argument of ``score``).

Counts of the frequent tokens, at most FREQUENT of them by the bound below, are
broadcast; all others meet their documents in a join.

Defined cases: a null text is an empty one, which has the end token only; without
training documents every count is 0; repeated rows are scored each; other columns are
ignored. ``docs`` must be a stable scan (files or a table), as rows are known by their
place in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint
from .common import slices as cut
from .words import U, mix, words

#: Levels of the class tree and classes at each, rows of weights, tokens in a gradient step, its rate, rounds, shards of the training documents, uses of a row from which it counts as used often; and the bound on broadcast tokens: a token is frequent if count * FREQUENT >= all tokens.
LEVELS, WAYS, ROWS, STEP, RATE, ROUNDS, SHARDS, SELDOM, FREQUENT = 3, 16, 1 << 18, 512, 0.6, 2, 4, 200.0, 2_000_000
LEAVES, FEW = WAYS**LEVELS, 8
_END, _START = U(0x1F83D9ABFB41BD6B), U(0x5BE0CD19137E2179)
_NODES = np.cumsum([0, *(WAYS**k for k in range(LEVELS))])  # first softmax of each level, and how many there are


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, last classes, row offsets) of the tokens, each row closed by the end token."""
    w = words(texts, lower=True)
    n = len(w.rows) - 1
    tail = np.maximum(w.starts, w.ends - 2)
    first = mix(w.spans(tail, w.ends)) % U(WAYS)
    leaf = (first * U(LEAVES // WAYS) + mix(w.hashes + U(5)) % U(LEAVES // WAYS)).astype(np.int64)
    at = np.arange(len(w.hashes)) + w.row
    h, c = np.full(len(w.hashes) + n, _END), np.full(len(w.hashes) + n, int(mix(np.array([_END]))[0] % U(LEAVES)), np.int64)
    h[at], c[at] = w.hashes, leaf
    return h, c, w.rows + np.arange(n + 1)


def softmaxes(leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(softmax, digit) on the way to each last class: tokens x LEVELS."""
    over = WAYS ** np.arange(LEVELS - 1, -1, -1)
    down = leaf[:, None] // over
    return _NODES[:-1] + down // WAYS, down % WAYS


def features(h: np.ndarray, rows: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Weight rows of each token's history at each of its softmaxes: 3 x tokens x LEVELS."""
    one, two = np.empty_like(h), np.empty_like(h)
    one[1:], two[2:] = h[:-1], h[:-2]
    begin = rows[:-1]
    one[begin] = _START
    two[begin] = _START
    second = begin[np.diff(rows) > 1] + 1
    two[second] = _START
    past = np.stack([mix(one + U(1)), mix(two + U(2)), mix(mix(two + U(3)) + one)])
    crossed = past[:, :, None] + (node.astype(U) * U(0x9FB21C651E98DF25))[None]
    return (mix(crossed) & U(ROWS - 1)).astype(np.intp)


def logits(weights: np.ndarray, bias: np.ndarray, f: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Logits of the softmaxes: len(node) x WAYS, 80 at most so that their exponents stay finite."""
    z = weights.take(f[0], 0)
    z += weights.take(f[1], 0)
    z += weights.take(f[2], 0)
    z += bias.take(node, 0)
    return np.minimum(z, 80, out=z)


def biases(in_leaf: np.ndarray) -> np.ndarray:
    """Log share of each class among its softmax's classes: softmaxes x WAYS."""
    out = []
    for level in range(LEVELS):
        n = in_leaf.reshape(WAYS ** (level + 1), -1).sum(1).reshape(-1, WAYS) + 0.5
        out.append(np.log(n / n.sum(1, keepdims=True)))
    return np.concatenate(out).astype(np.float32)


class Trainer:
    """Gradient steps with a rate that falls per row as the row is used."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, rate: float):
        self.weights, self.bias, self.rate = weights.copy(), bias, np.float32(rate)
        self.used, self.seen = np.zeros(ROWS, np.float32), 0

    def learn(self, h: np.ndarray, leaf: np.ndarray, rows: np.ndarray) -> None:
        node, digit = softmaxes(leaf)
        f = features(h, rows, node)
        for at in range(0, len(h), STEP):
            some = slice(at, at + STEP)
            self.step(f[:, some].reshape(3, -1), node[some].ravel(), digit[some].ravel())
        self.seen += len(h)

    def step(self, f: np.ndarray, node: np.ndarray, digit: np.ndarray) -> None:
        error = np.exp(logits(self.weights, self.bias, f, node))
        error /= (error @ np.ones(WAYS, np.float32))[:, None]
        error[np.arange(len(node)), digit] -= 1
        row, n, total = summed(f.ravel(), error)
        self.used[row] += n
        total *= (self.rate / np.sqrt(n * self.used[row]))[:, None]
        self.weights[row] = self.weights.take(row, 0) - total


def summed(rows: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct rows, their uses, sums of their errors); use k of ``rows`` has error k modulo len(error)."""
    by = np.argsort(rows)
    ordered, by = rows[by], by % len(error)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    n = np.diff(np.append(first, len(rows)))
    total = error.take(by[first], 0)
    for k in range(1, FEW):  # rows of few uses: one use at a time
        more = np.flatnonzero((n > k) & (n <= FEW))
        if not len(more):
            break
        total[more] += error.take(by[first[more] + k], 0)
    many = np.flatnonzero(n > FEW)
    if len(many):
        size = n[many]
        at = np.repeat(first[many] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        total[many] = np.add.reduceat(error.take(by[at], 0), np.cumsum(size) - size, axis=0)
    return ordered[first], n.astype(np.float32), total


def count_tokens(texts: DataFrame) -> DataFrame:
    """(h, leaf, c): every token with its last class and count, counted in each task first."""

    def merged(parts: list) -> list:
        h, c, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        keys, first, back = np.unique(h, return_index=True, return_inverse=True)
        return [(keys, c[first], np.bincount(back, n, len(keys)).astype(np.int64))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out(part) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1].astype(np.int32)), pa.array(part[2])], ["h", "leaf", "c"])

        for batch in batches:
            for part in cut(batch, "text"):
                h, c, _ = tokens(part.column(0))
                held.append((h, c, np.ones(len(h), np.int64)))
                held[-1:] = merged(held[-1:])
                size += len(held[-1][0])
                if size > 1_000_000:
                    held = merged(held)
                    size = len(held[0][0])
                    if size > 700_000:
                        yield out(held[0])
                        held, size = [], 0
        if held:
            yield out(merged(held)[0])

    found = texts.mapInArrow(run, "h long, leaf int, c long")
    return found.groupBy("h").agg(F.first("leaf").alias("leaf"), F.sum("c").alias("c"))


def train(texts: DataFrame, bias: np.ndarray, shards: int = SHARDS) -> np.ndarray:
    """Weights from gradient steps over all rows of ``texts`` (text, deal), in rounds that each go on from the mean of the last."""
    weights = np.zeros((ROWS, WAYS), np.float32)
    names = [f"w{k}" for k in range(WAYS)]
    for turn in range(ROUNDS):
        share = texts.where(F.pmod("deal", F.lit(ROUNDS)) == turn).repartition(shards, F.shiftright("deal", 8)).coalesce(shards).select("text")
        shared = texts.sparkSession.sparkContext.broadcast((weights, bias))
        found = share.mapInArrow(_trained(shared, RATE / (1 + turn), names), f"row int, used float, {', '.join(f'{n} float' for n in names)}")
        used = F.sum(F.col("used").cast("double"))
        worth = used / F.sqrt(F.sum(F.col("used").cast("double") * F.col("used")))  # square root of how many shares of equal size the shards' are worth
        scale = (1 + (worth - 1) / (1 + used / SELDOM)) / used
        mean = [(F.sum(n) * scale).cast("float").alias(n) for n in names]
        got = found.repartition("row").groupBy("row").agg(*mean).toArrow()  # at most ROWS rows of WAYS numbers; a shard has a row once, so it is added up after the exchange
        row, weights = got["row"].to_numpy(), weights.copy()
        for k, n in enumerate(names):
            weights[row, k] += got[n].to_numpy()
        shared.destroy()
    return weights


def _trained(shared, rate: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Trainer(*shared.value, rate)
        for batch in batches:
            for part in cut(batch, "text", 1 << 19):
                t.learn(*tokens(part.column(0)))
        row = np.flatnonzero(t.used)
        sums = (t.weights[row] - shared.value[0][row]) * t.used[row, None]
        yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int32)), pa.array(t.used[row]), *(pa.array(sums[:, k]) for k in range(WAYS))], ["row", "used", *names])

    return run


def log_probability(h: np.ndarray, leaf: np.ndarray, rows: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each token's last class, in batches."""
    node, digit = softmaxes(leaf)
    out, one = np.empty(len(h)), np.ones(WAYS, np.float32)
    f = features(h, rows, node)
    for at in range(0, len(h), STEP):
        some = slice(at, at + STEP)
        z = logits(weights, bias, f[:, some].reshape(3, -1), node[some].ravel())
        mine = z[np.arange(len(z)), digit[some].ravel()]
        out[some] = (mine - np.log(np.exp(z, out=z) @ one)).reshape(-1, LEVELS).sum(1)
    return out


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), learn.alias("learn"))
    training = rows.where("learn").select("text", F.xxhash64("doc_id", "text").alias("deal"))
    counts = checkpoint(count_tokens(training.select("text")))
    totals = counts.groupBy("leaf").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()  # LEAVES rows at most
    in_leaf, kinds = np.zeros(LEAVES), np.zeros(LEAVES)
    for t in totals:
        in_leaf[t.leaf], kinds[t.leaf] = t.n, t.v
    n_all, v_all = int(in_leaf.sum()), int(kinds.sum())
    frequent = counts.where(F.col("c") * FREQUENT >= n_all).select("h", "c").toArrow()  # at most FREQUENT rows, as counts sum to n_all
    h = frequent["h"].to_numpy().view(U)
    by = np.argsort(h)
    bias = biases(in_leaf)
    weights = train(training, bias, shards)
    shared = docs.sparkSession.sparkContext.broadcast((h[by], frequent["c"].to_numpy()[by], weights, bias, np.log10(in_leaf + 0.5 * (kinds + 1))))
    base = float(np.log10(n_all + 0.5 * (v_all + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, c, weights, bias, scale = shared.value
        logs = np.log10(c + 0.5)
        for batch in batches:
            for part in cut(batch, "text", 1 << 19):
                yield from one(part, keys, logs, weights, bias, scale)

    def one(part, keys, logs, weights, bias, scale):
        h, leaf, rows = tokens(part.column(1))
        model = log_probability(h, leaf, rows, weights, bias) / np.log(10) - scale[leaf]
        at = np.searchsorted(keys, h)
        at[at == len(keys)] = 0
        known = keys[at] == h if len(keys) else np.zeros(len(h), bool)
        mine = np.where(known, logs[at] if len(keys) else 0.0, 0.0)
        begin = rows[:-1]
        info = np.stack([np.diff(rows), np.add.reduceat(known.astype(np.int64), begin), np.add.reduceat(mine, begin), np.add.reduceat(model, begin)], 1)
        row = np.repeat(np.arange(part.num_rows), np.diff(rows))[~known]
        rare = h[~known]
        order = np.lexsort((rare, row))
        rare, row = rare[order], row[order]
        cut = np.flatnonzero(np.concatenate([[True], (rare[1:] != rare[:-1]) | (row[1:] != row[:-1])])) if len(rare) else np.zeros(0, np.int64)
        rid = part.column(0).to_numpy()
        k = len(cut)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([rid, rid[row[cut]]])),
                pa.array(np.concatenate([mix(rid.astype(U)), rare[cut]]).view(np.int64)),
                pa.array(np.concatenate([np.zeros(len(rid), np.int32), np.diff(np.append(cut, len(rare))).astype(np.int32)])),
                pa.array([*(x.tobytes() for x in info), *[None] * k], pa.binary()),
            ],
            ["rid", "h", "tf", "info"],
        )

    numbered = rows.withColumn("rid", F.monotonically_increasing_id())
    found = numbered.select("rid", "text").mapInArrow(run, "rid long, h long, tf int, info binary")
    joined = found.join(counts.select("h", "c"), "h", "left")
    log = F.log10(F.coalesce("c", F.lit(0)) + 0.5) * F.col("tf")
    sums = joined.groupBy("rid").agg(F.sum(log).alias("rare"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("more"), F.max("info").alias("info"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            info = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.float64).reshape(-1, 4)
            rare, more = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            n, counted = info[:, 0], info[:, 2] + rare
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), pa.array(info[:, 1].astype(np.int64) + more), pa.array(counted - n * base), pa.array(counted + info[:, 3])],
                ["rid", "n_tokens", "n_known", "base_score", "score"],
            )

    ready = sums.mapInArrow(finish, "rid long, n_tokens long, n_known long, base_score double, score double")
    return numbered.select("rid", "doc_id").join(ready, "rid").select("doc_id", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score")
