"""Language, top-k, language model, toxicity, near-dedup and WARC against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import bagminhash, components, crf, lm, topk, toxicity, warc
from tidemark.llm import words as wd
from tidemark.llm.common import fold

# ---- language --------------------------------------------------------------------------

ENDS = {"aa": ["ing", "tion", "the"], "bb": ["ung", "keit", "und"], "cc": ["eau", "ment", "les"]}


def word(rng, lang):
    return "".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) + rng.choice(ENDS[lang])


def spoken(spark, rng, n=240):
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(ENDS))
        rows.append((i, " ".join(word(rng, lang) for _ in range(rng.randrange(5, 150))), lang, "src"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")


def test_language(spark):
    docs = spoken(spark, random.Random(2))
    model = crf.fit(docs, fold("doc_id", 4) != 2)
    out = crf.label(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "runs"]
    rows = out.where(fold("doc_id", 4) == 2).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_switching_and_defined_cases(spark):
    rng = random.Random(3)
    model = crf.fit(spoken(spark, rng), F.lit(True))
    mixed = " ".join([word(rng, "aa") for _ in range(90)] + [word(rng, "bb") for _ in range(60)])
    df = spark.createDataFrame([(1, mixed), (2, None), (3, ""), (4, "12 34 !"), (5, mixed)], "doc_id long, text string")
    got = {r.doc_id: r for r in crf.label(df, model).collect()}
    runs = [(x.lang, x.first_word, x.end_word) for x in got[1].runs]
    assert got[1].lang_pred == got[5].lang_pred == "aa"
    assert runs[0][0] == "aa" and runs[-1][0] == "bb" and runs[-1][2] == 150
    assert sum(e - s for lang, s, e in runs if lang == "bb") >= 50
    for k in (2, 3, 4):
        assert (got[k].lang_pred, got[k].score, got[k].runs) == ("und", 0.0, [])
    empty = crf.fit(df.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r.lang_pred for r in crf.label(df, empty).collect()} == {"und"}
    assert crf.label(df.where("false"), model).count() == 0


@pytest.mark.parametrize("block", [1, 2, 64])
def test_forward_backward_by_enumeration(block):
    from itertools import product

    rng = np.random.default_rng(0)
    emit, begin, trans = rng.normal(size=(5, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    post, log_z, _, pairs = crf.forward_backward(emit, np.array([0, 0, 3, 5, 5]), begin, trans, block)
    z_all, want, moves = 0.0, np.zeros((5, 3)), np.zeros((3, 3))
    for start, n in ((0, 3), (3, 2)):
        paths = {p: math.exp(begin[p[0]] + sum(emit[start + t, k] for t, k in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:], strict=False))) for p in product(range(3), repeat=n)}
        z = sum(paths.values())
        z_all += math.log(z)
        for p, v in paths.items():
            for t, k in enumerate(p):
                want[start + t, k] += v / z
            for a, b in zip(p, p[1:], strict=False):
                moves[a, b] += v / z
    assert np.allclose(post, want) and math.isclose(log_z, z_all) and np.allclose(pairs, moves)


def test_messages_cross_the_blocks():
    rng = np.random.default_rng(4)
    emit, begin, trans = rng.normal(size=(700, 3)), rng.normal(size=3), 2 * rng.normal(size=(3, 3))
    rows = np.array([0, 5, 5, 300, 301, 700])
    whole = crf.forward_backward(emit, rows, begin, trans, 1000)
    for block in (1, 7, 64):
        for a, b in zip(crf.forward_backward(emit, rows, begin, trans, block), whole, strict=True):
            assert np.allclose(a, b)


def test_predictions_by_enumeration(spark):
    """lang_pred, score and runs of the query against sums over all label paths."""
    from itertools import product

    model = crf.fit(spoken(spark, random.Random(5), 60), F.lit(True))
    rng = random.Random(6)
    texts = [" ".join(word(rng, rng.choice(sorted(ENDS))) for _ in range(rng.randrange(1, 8))) for _ in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in crf.label(df, model).collect()}
    for i, t in enumerate(texts):
        w = wd.words(pa.array([t]), lower=True)
        rows, at = crf.word_features(w, np.arange(len(w.hashes)))
        emit = [model.weights[rows[a:b]].sum(0).astype(float) for a, b in zip(at[:-1], at[1:], strict=True)]
        total = np.zeros((len(emit), 3))
        for p in product(range(3), repeat=len(emit)):
            v = math.exp(model.begin[p[0]] + sum(e[k] for e, k in zip(emit, p, strict=True)) + sum(model.trans[a, b] for a, b in zip(p, p[1:], strict=False)))
            for k, label in enumerate(p):
                total[k, label] += v
        post = total / total.sum(1, keepdims=True)
        mean = post.mean(0)
        assert got[i].lang_pred == model.labels[mean.argmax()] and got[i].score == pytest.approx(mean.max(), abs=1e-4)
        spelt = [x.lang for x in got[i].runs for _ in range(x.first_word, x.end_word)]
        assert spelt == [model.labels[k] for k in post.argmax(1)]


def test_switches_are_learned_from_foreign_runs():
    word_, gold, rows = np.array([0, 0, 0, 0, 0, 0, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 1, 1, 2]), np.array([0] * 6 + [1] * 13), np.array([0, 6, 12, 19])
    word_ = np.concatenate([np.zeros(100, int), word_])
    gold, rows = np.concatenate([np.zeros(100, int), gold]), np.concatenate([[0], rows + 100])
    got = crf.foreign_runs(word_, gold, rows, 2)
    assert got[112:].tolist() == [0, 0, 0, 0, 1, 1, 1] and (got[:112] == gold[:112]).all()
    rng = random.Random(1)
    plain = [(" ".join(word(rng, x) for _ in range(60)), x) for x in ("aa", "bb") * 30]
    fixed = {x: [word(rng, x) for _ in range(40)] for x in ("aa", "bb")}
    mixed = [(" ".join(rng.choice(fixed[y]) for y in (x * 30 + z * 4 + x * 30).split("|") if y), x) for x, z in (("aa|", "bb|"), ("bb|", "aa|")) * 15]
    pure = [(" ".join(rng.choice(fixed[x]) for _ in range(60)), x) for x in ("aa", "bb") * 30]
    texts, langs = zip(*(plain + pure + [(t, x.strip("|")) for t, x in mixed]), strict=True)
    often = crf.train(list(texts), list(langs)).trans
    texts, langs = zip(*(plain + pure + pure), strict=True)
    never = crf.train(list(texts), list(langs)).trans
    stay = lambda t: float(np.trace(t) - t[0, 1] - t[1, 0])
    assert stay(often) < stay(never)


def test_language_bounds_and_edges(spark, monkeypatch):
    """More than 64 languages, repeated ids, bytes over the bound, clashing names and a very long text."""
    rows = [(k % 70, f"L{k % 70}x L{k % 70}y " * 3, f"l{k % 70:02d}", 0, "x") for k in range(210)] + [(5, "long " * 1000, "l05", 0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, runs string")
    monkeypatch.setattr(crf, "BYTES", 4000)
    model = crf.fit(df, F.lit(True))
    assert len(model.labels) == 70
    out = crf.label(df.unionByName(spark.createDataFrame([(1000, "L3x L3y " * 30000, None, 0, "x")], df.schema)), model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "runs"]
    got = out.collect()
    assert len(got) == len(rows) + 1
    assert sum(r.lang_pred == r.lang for r in got) >= 200
    assert next(r for r in got if r.doc_id == 1000).lang_pred == "l03"


# ---- top-k -----------------------------------------------------------------------------


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(400)]
    rows += [(401, None), (402, [1.0, None]), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (None, [0.0] * 6), (405, [1.0, 2.0]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(topk, "CANDIDATES", 32)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    got = collections.defaultdict(list)
    for r in topk.exact_top_k(df, F.col("vec_id") % 100 == 0, 10).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ints = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v in rows[:400]}
    for q in (0, 100, 200, 300):
        best = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)[:10]
        assert got[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert topk.exact_top_k(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    assert topk.exact_top_k(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).count() == 2


def test_ties_at_the_last_place(spark, monkeypatch):
    """Equal scores across tiles: the smaller ids stay, also under a clashing column name."""
    rows = [(i, [1.0, float(i % 3)], i) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(5)
    monkeypatch.setattr(topk, "CANDIDATES", 4)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    got = [(r.rank, r.vec_id) for r in topk.exact_top_k(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    got = [r.vec_id for r in topk.exact_top_k(df, F.col("vec_id") == 2, 21).orderBy("rank").collect()]
    assert got == [5 + 3 * k for k in range(19)] + [1, 4]


def test_large_products_stay_exact():
    q, c = np.array([[2.0**30, 3.0]]), np.array([[2.0**30, 1.0], [2.0**30, 2.0]])
    assert topk._product(q, c).tolist() == [[2**60 + 3, 2**60 + 6]]


# ---- language model --------------------------------------------------------------------


def tokens(t):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 20])
def test_base_scores(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rng = random.Random(7)
    texts = [" ".join(f"W{int(rng.paretovariate(0.6))}" for _ in range(rng.randrange(40))) for _ in range(120)] + [None, "", "É é", "same", "same"]
    ids = [*range(len(texts) - 1), len(texts) - 2]
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").coalesce(2)
    learn = [zlib.crc32(str(i).encode()) % 5 != 1 for i in ids]
    counts = collections.Counter(w for t, k in zip(texts, learn, strict=True) if k for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6)) for i, t in zip(ids, texts, strict=True))
    rows = lm.score(df, fold("doc_id", 5) != 1).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(r.score < 0 for r in rows)


def test_model_learns_context_and_sums_to_one(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(400):
        side = rng.choice(["ka", "mo"])
        texts.append(" ".join(side * rng.randrange(1, 4) + rng.choice("xyz") + side for _ in range(30)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = lm.score(df, fold("doc_id", 5) != 1).where(fold("doc_id", 5) == 1).collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def plain_language_model(texts, learn, weights):
    """Scores from given weights: a softmax at each level of the class tree, then the token's share of its last class."""
    mask, m64 = lm.ROWS - 1, (1 << 64) - 1
    mixed = lambda x: int(wd.mix(np.array([x & m64], np.uint64))[0])

    def hashed(t):
        h, leaf, rows = lm.tokens(pa.array([t or ""]))
        return [int(x) for x in h], [int(x) for x in leaf]

    toks = [hashed(t) for t in texts]
    counts, of_leaf = collections.Counter(), collections.defaultdict(set)
    below = collections.Counter()
    for (h, leaf), good in zip(toks, learn, strict=True):
        for x, k in zip(h, leaf, strict=True) if good else ():
            counts[x] += 1
            of_leaf[k].add(x)
            path = tuple((k // lm.WAYS ** (lm.LEVELS - 1 - d)) % lm.WAYS for d in range(lm.LEVELS))
            for d in range(lm.LEVELS):
                below[path[: d + 1]] += 1
    out = []
    for h, leaf in toks:
        total = 0.0
        for at, (x, k) in enumerate(zip(h, leaf, strict=True)):
            one = h[at - 1] if at else int(lm._START)
            two = h[at - 2] if at > 1 else int(lm._START)
            past = [mixed(one + 1), mixed(two + 2), mixed(mixed(two + 3) + one)]
            path = [(k // lm.WAYS ** (lm.LEVELS - 1 - d)) % lm.WAYS for d in range(lm.LEVELS)]
            for d in range(lm.LEVELS):
                node = int(lm._NODES[d]) + k // lm.WAYS ** (lm.LEVELS - d)
                n = [below[(*path[:d], w)] + 0.5 for w in range(lm.WAYS)]
                z = [math.log(v / sum(n)) + sum(float(weights[mixed(f + node * 0x9FB21C651E98DF25) & mask][w]) for f in past) for w, v in enumerate(n)]
                total += (z[path[d]] - math.log(sum(math.exp(v) for v in z))) / math.log(10)
            seen = sum(counts[y] for y in of_leaf[k])
            total += math.log10((counts[x] + 0.5) / (seen + 0.5 * (len(of_leaf[k]) + 1)))
        out.append(total)
    return out


def test_scores_are_the_plain_ones(spark, monkeypatch):
    """``score`` of the query's operator against plain Python; nulls, repeated rows, a long text and clashing names."""
    kept = []
    monkeypatch.setattr(lm, "train", lambda *args, f=lm.train: kept.append(f(*args)) or kept[-1])
    rng = random.Random(17)
    texts = [" ".join(f"W{int(rng.paretovariate(0.6)) % 50}" for _ in range(rng.randrange(30))) for _ in range(60)] + [None, "", "same text", "same text", "new words only", "long " * 2000 + "end"]
    rows = [(i, t, 1, "x", False) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h int, score string, learn boolean").coalesce(2)
    learn = [zlib.crc32(str(i).encode()) % 5 != 1 for i in range(len(texts))]
    got = {r.doc_id: r.score for r in lm.score(df, fold("doc_id", 5) != 1).collect()}
    assert np.abs(kept[0]).max() > 0
    assert [got[i] for i in range(len(texts))] == pytest.approx(plain_language_model(texts, learn, kept[0]), rel=1e-4)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    weights, bias = rng.normal(size=(lm.ROWS, lm.WAYS)).astype(np.float32), lm.biases(rng.integers(0, 9, lm.LEAVES).astype(float))
    leaf = np.arange(lm.LEAVES)
    h = np.full(lm.LEAVES * 3, 7, np.uint64)
    rows = np.arange(lm.LEAVES + 1) * 3
    every = np.zeros(lm.LEAVES * 3, np.int64)
    every[2::3] = leaf
    assert np.exp(lm.log_probability(h, every, rows, weights, bias)[2::3]).sum() == pytest.approx(1, abs=1e-4)


def test_empty_model(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = lm.score(df, F.lit(False)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert lm.score(df.where("false"), F.lit(True)).count() == 0


# ---- toxicity --------------------------------------------------------------------------


def toxic_docs(spark, n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        ws = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(5, 60))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(2):
                ws.insert(rng.randrange(len(ws)), rng.choice(["Idiot", "moron,", "scum"]))
        rows.append((i, " ".join(ws), 0.5))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame([*labels, (10**6, 1), (1, None), (2, 7), (None, 1)], "doc_id long, toxic int"), dict(labels)


def test_toxicity(spark):
    docs, labels, truth = toxic_docs(spark)
    index = toxicity.fit(docs, labels, fold("doc_id", 4) != 2)
    out = toxicity.score(docs.unionByName(spark.createDataFrame([(-1, None, 0.0), (-2, "", 0.0)], docs.schema)), index)
    assert out.columns == ["doc_id", "text", "score", "predicted", "evidence"]
    rows = {r.doc_id: r for r in out.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(rows[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    assert rows[-1].score == rows[-2].score == index.empty and rows[-1].evidence == []
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    assert any(e.toxic == 1 for i in held if truth[i] for e in rows[i].evidence)


def plain_terms(text):
    out = collections.Counter()
    for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
        if w := w.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
            out[0, w.encode()] += 1
            for n in (4,):
                if len(w.encode()) >= n:
                    out[n, w.encode()[:n]] += 1
    return out


def plain_scores(rows, labels, learn):
    """{row number: (score, evidence)} from the definition, all cosines computed."""
    share, texts = collections.Counter(y for i, y in labels.items() if learn(i)), {i: t for i, t in rows}
    sample = [i for i in sorted(labels) if learn(i) and i in texts]
    n = [max(1, sum(labels[i] == y for i in sample)) for y in (0, 1)]
    bags = {i: plain_terms(texts[i]) for i in sample}
    count = [collections.Counter(t for i in sample if labels[i] == y for t in bags[i]) for y in (0, 1)]
    df = collections.Counter(t for _, x in rows for t in plain_terms(x))

    def weight(t):
        a, b = count[0][t], count[1][t]
        p = (a + b + 1) / (sum(n) + 2)
        z = (b / n[1] - a / n[0]) / math.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1]))
        return (math.log((1 + len(rows)) / (1 + df[t])) + 1) * z * z / (z * z + toxicity.Z**2) if a + b else 0.0

    weights = {t: weight(t) for t in count[0].keys() | count[1].keys()}

    def vector(bag):
        v = {t: (1 + math.log(c)) * weights[t] for t, c in bag.items() if weights.get(t)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    vectors = {i: vector(bags[i]) for i in sample}
    stands = {y: share[y] / n[y] for y in (0, 1)}
    prior = sum(stands[labels[i]] * labels[i] for i in sample) / sum(stands[labels[i]] for i in sample)

    def vote(v, leave=None):
        near = sorted((-round(sum(x * vectors[i].get(t, 0) for t, x in v.items()), 6), i) for i in sample if i != leave)[: toxicity.NEIGHBOURS]
        near = [(-s, i) for s, i in near if s < -1e-6]
        total = sum(s * s * stands[labels[i]] for s, i in near)
        return (sum(s * s * stands[labels[i]] * labels[i] for s, i in near) + prior) / (total + 1), near

    full = [i for i in sample if vectors[i]]
    x, y = toxicity.isotonic(*(np.array(c, float) for c in zip(*((vote(vectors[i], i)[0], labels[i], stands[labels[i]]) for i in full), strict=True)))
    bare = [i for i in sample if not vectors[i]]
    empty = sum(stands[labels[i]] * labels[i] for i in bare) / sum(stands[labels[i]] for i in bare) if bare else prior
    out = []
    for _, text in rows:
        v = vector(plain_terms(text))
        got, near = vote(v)
        out.append((float(np.interp(got, x, y)), [(i, round(s, 4)) for s, i in near[:3]]) if v else (empty, []))
    return out


def test_toxicity_scores_are_the_plain_ones(spark, monkeypatch):
    """The query's whole result against all cosines; a long text, repeated rows, empty ones and many small blocks."""
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    monkeypatch.setattr(toxicity, "DENSE", 0.2)
    docs, labels, truth = toxic_docs(spark, 160)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rng = random.Random(10)
    rows += [(200, " ".join(f"w{rng.randrange(3000)}" for _ in range(20000))), (201, None), (202, ""), (203, "... --"), (204, rows[3][1]), (205, rows[3][1]), (206, "never-seen")]
    learn = lambda i: zlib.crc32(str(i).encode()) % 4 != 2
    truth = {**truth, 201: 0, 202: 1}
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    marks = spark.createDataFrame(list(truth.items()), "doc_id long, toxic int")
    index = toxicity.fit(df, marks, fold("doc_id", 4) != 2)
    got = {r.doc_id: r for r in toxicity.score(df, index).collect()}
    for (i, _), (want, near) in zip(rows, plain_scores(rows, truth, learn), strict=True):
        assert got[i].score == pytest.approx(want, abs=1e-4), i
        assert [(e.doc_id, pytest.approx(e.cosine, abs=2e-4)) for e in got[i].evidence] == near


def test_sample_bounds(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "EXAMPLES", 5)
    monkeypatch.setattr(toxicity, "BYTES", 30)
    df = spark.createDataFrame([(i, "ten bytes " if i else "x" * 31) for i in range(40)] + [(7, "a")], "doc_id long, text string")
    marks = df.select(F.col("doc_id"), (F.col("doc_id") % 2).cast("int").alias("y")).distinct()
    got = toxicity.sampled(df, marks).to_pylist()
    assert 2 <= len(got) <= 6 and all(sum(r["y"] == y for r in got) <= 3 for y in (0, 1))
    assert all(r["text"] == "a" for r in got if r["doc_id"] == 7)


def test_no_labels(spark):
    docs, labels, _ = toxic_docs(spark, 20)
    index = toxicity.fit(docs, labels.where("false"), F.lit(True))
    assert {r.score for r in toxicity.score(docs, index).collect()} == {0.0}
    assert toxicity.score(docs.where("false"), index).count() == 0


def test_isotonic():
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert np.interp([1, 2.5, 4], x, y).tolist() == [0, 0.5, 1]


# ---- near-dedup ------------------------------------------------------------------------


def plain_classes(rows):
    bags = [collections.Counter(wd.windows(wd.words(pa.array([t])).hashes, 5).tolist()) if len((t or "").split()) >= 5 else collections.Counter([" ".join(t.split())]) if (t or "").strip() else None for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][1] == rows[j][1] and rows[i][1] is not None
            if not same and bags[i] and bags[j]:
                same = sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values())
            if same:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    ids = [i for i, _ in rows]
    members = collections.defaultdict(list)
    for k in range(len(rows)):
        members[root(k)].append(ids[k])
    return {ids[k]: min(members[root(k)]) for k in range(len(rows))}


def test_near_dedup(spark):
    rng = random.Random(11)
    rows = []
    base = [[f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 300))] for _ in range(15)]
    for b in base:
        for _ in range(rng.randrange(1, 12)):
            c = list(b)
            for _ in range(rng.randrange(0, max(1, len(c) // 40))):
                c[rng.randrange(len(c))] = f"x{rng.randrange(10**6)}"
            rows.append((rng.randrange(10**6), " ".join(c)))
    rows += [(2 * 10**6, rows[0][1]), (2 * 10**6 + 1, rows[0][1]), (3 * 10**6, ""), (3 * 10**6 + 1, ""), (3 * 10**6 + 2, None), (4 * 10**6, "a b"), (4 * 10**6 + 1, "a  b"), (5 * 10**6, "z " * 400), (5 * 10**6 + 1, "z " * 380)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    got = {r.doc_id: r.class_id for r in bagminhash.classes(df).collect()}
    want = plain_classes(rows)
    want[3 * 10**6 + 2] = 3 * 10**6 + 2
    assert got == want
    kept = bagminhash.deduplicated(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_star_around_a_late_base(spark):
    """Copies that are near the base but not each other, and the base not the smallest id."""
    rng = random.Random(12)
    b = [f"w{k}" for k in range(300)]
    rows = [(900, " ".join(b))]
    for i in range(40):
        c = list(b)
        for k in rng.sample(range(60), 6):
            c[k * 5] = f"y{i}_{k}"
        rows.append((i, " ".join(c)))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert {r.class_id for r in bagminhash.classes(df).collect()} == set(plain_classes(rows).values()) == {0}


def test_pair_in_a_crowded_bucket(spark):
    """Texts on one template, all under the threshold but two that no hub is near."""
    rows = [(i, " ".join([f"t{k}" for k in range(304)] + [f"o{i}_{k}" for k in range(40)])) for i in range(160)]
    pairs = [(1000 + 2 * p + q, " ".join([f"t{k}" for k in range(304)] + [f"p{p}_{k}" for k in range(4)] + [f"o{p}_{q}_{k}" for k in range(36)])) for p in range(6) for q in range(2)]
    df = spark.createDataFrame(rows + pairs, "doc_id long, text string").coalesce(2)
    want = {i: i - i % 2 if i >= 1000 else i for i, _ in rows + pairs}
    assert want == plain_classes(rows + pairs)
    assert {r.doc_id: r.class_id for r in bagminhash.classes(df).collect()} == want


def test_shared_shingles_of_blocks():
    rng = random.Random(13)
    bags = [bagminhash._bag(zstandard.compress(" ".join(f"w{rng.randrange(3)}" for _ in range(rng.randrange(1, 60))).encode())) for _ in range(30)]
    row = np.repeat(np.arange(30), [len(h) for h, _ in bags])
    both = bagminhash.shared(row, *(np.concatenate(x) for x in zip(*bags, strict=True)), np.arange(12), np.arange(12, 30))
    for x in range(12):
        for y in range(18):
            total = bags[x][1].sum() + bags[12 + y][1].sum()
            assert both[x, y] / (total - both[x, y]) == pytest.approx(bagminhash.overlap(bags[x], bags[12 + y]))


def test_repeated_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "q")], "doc_id long, text string").coalesce(1)
    assert sorted((r.doc_id or 0, r.class_id or 0) for r in bagminhash.classes(df).collect()) == [(0, 0), (0, 1), (1, 1), (1, 1)]
    assert sorted(r.doc_id or 0 for r in bagminhash.deduplicated(df).collect()) == [0, 1]
    assert bagminhash.classes(df.where("false")).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 6, 200)
    b = a.copy()
    b[:60] = rng.integers(0, 9, 60)
    want, got = np.minimum(a, b).sum() / np.maximum(a, b).sum(), []
    for s in range(60):
        h = wd.mix(np.arange(200).astype(np.uint64) + np.uint64(s * 7919))
        sig = bagminhash.signatures(np.repeat([0, 1], [200, int((b > 0).sum())]), np.concatenate([h, h[b > 0]]), np.concatenate([a, b[b > 0]]), 2)
        got.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(got) - want) < 0.02


def test_components(spark):
    edges = [(5, 3), (3, 9), (9, 12), (1, 2), (7, 7), (2, 20), (20, 21), (21, 22), (22, 23)]
    got, links = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.comp for r in got.collect()} == {3: 3, 5: 3, 9: 3, 12: 3, 1: 1, 2: 1, 20: 1, 21: 1, 22: 1, 23: 1}
    assert links.count() == 8


@pytest.mark.parametrize("size", [10**6, 40])
def test_components_by_levels(spark, monkeypatch, size):
    """Paths, stars and cycles, merged by one task or by many in levels, against plain union-find."""
    monkeypatch.setattr(components, "EDGES", size)
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 300) if k % 37] + [(5, k) for k in range(400, 460)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    edges += edges[:20] + [(b, a) for a, b in edges[:20]]
    rng.shuffle(edges)
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got, links = components.components(spark.createDataFrame(edges, "a long, b long").repartition(6))
    assert {r.id: r.comp for r in got.collect()} == {x: root(x) for x in parent}
    assert got.count() == len(parent) and links.count() == len({tuple(sorted(e)) for e in edges if e[0] != e[1]})
    none, _ = components.components(spark.createDataFrame([], "a long, b long"))
    assert none.count() == 0


# ---- WARC ------------------------------------------------------------------------------


def test_warc_round_trip(spark, monkeypatch):
    big = "é<p>x</p>\n" * 5000
    rows = [(1, "http://a/\r\nX: y", big), (2, "http://b", big), (3, None, None), (4, "http://d", "small"), (5, "http://d", "small"), (None, "http://e", big), (2, "http://b", big), (9, "u", "WARC/1.1\r\n\r\n" * 300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id or 0, r.payload_bytes, r.digest, r.type, r.refers_to, r.error) for r in warc.round_trip(df).collect()), key=str)
    digest = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = []
    for i, _, h in rows:
        again = h == big and i != 2
        want.append((i or 0, len((h or "").encode()), digest(h), "revisit" if again else "response", 2 if again else None, None))
    assert got == sorted(want, key=str)
    assert warc.round_trip(df.where("false")).count() == 0


def test_segments_in_any_order_and_broken_ones(spark):
    payload = ("long text " * 9000).encode()
    records = list(warc.records_of("<urn:uuid:1>", 1, "u", payload, hashlib.sha1(payload).hexdigest(), None, 1000))
    assert len(records) > 50
    random.Random(1).shuffle(records)

    def back(parts):
        parsed = [(h, b) for p in parts for h, b, error in warc.parse(p) if error is None]
        rows = [(h["warc-record-id"], h["warc-type"], 1, None, None, h.get("warc-payload-digest", "").rpartition(":")[2] or None, None, h.get("warc-segment-origin-id", h["warc-record-id"]), int(h["warc-segment-number"]), int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, bytearray(b), None) for h, b in parsed]
        return warc.reassemble(spark.createDataFrame(rows, warc._RECORD)).collect()

    (whole,) = back(records)
    assert bytes(whole.payload) == payload and whole.error is None
    (twice,) = back(records + records[:3])
    assert bytes(twice.payload) == payload
    middle = next(k for k, r in enumerate(records) if b"WARC-Segment-Number: 7\r\n" in r)
    (cut,) = back(records[:middle] + records[middle + 1 :])
    assert cut.payload is None and "gap" in cut.error


def test_broken_archives_are_rows_with_an_error(spark, tmp_path):
    import gzip

    body = b"<p>x</p>" * 20
    good = next(warc.records_of("<urn:uuid:1>", 1, "u", body, hashlib.sha1(body).hexdigest(), None))
    again = good.replace(b"urn:uuid:1", b"urn:uuid:2").replace(b"X-Page-Id: 1", b"X-Page-Id: 2")
    archives = {
        "whole": good + again,
        "members": gzip.compress(good) + gzip.compress(again),
        "header cut": good + again[:60],
        "block cut": good + again[:-20],
        "no length": good.replace(b"Content-Length", b"X-Other") + again,
        "no number": good + again.replace(b"X-Page-Id: 2", b"X-Page-Id: two"),
        "garbage": good + b"garbage" + again,
        "cut stream": gzip.compress(good + again)[:-9],
        "bad stream": gzip.compress(good)[:-8] + b"12345678" + b"rest",
        "empty": b"",
        "wrong digest": good.replace(b"<p>x</p>", b"<p>y</p>", 1),
    }
    got = {}
    for name, data in archives.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(data)
        rows = warc.reassemble(warc.read_records(spark, str(tmp_path / name))).collect()
        got[name] = (sorted(r.page_id for r in rows if r.error is None), sorted(r.error for r in rows if r.error))
        assert all(bytes(r.payload) == body for r in rows if r.error is None) and all(r.payload is None for r in rows if r.error)
    assert got["whole"] == got["members"] == ([1, 2], []) and got["empty"] == ([], [])
    assert got["header cut"] == ([1], ["header is cut"]) and got["block cut"] == ([1], ["block is cut"])
    assert got["no length"] == ([2], ["record has no length"]) and got["no number"] == ([1], ["x-page-id is no number"])
    assert got["garbage"] == ([1, 2], ["bytes outside of a record"]) and got["wrong digest"] == ([], ["payload digest differs"])
    assert "archive is cut" in got["cut stream"][1] and got["bad stream"][1][-1].startswith("archive is broken")


def test_chunk_framing():
    assert warc.decode_chunked(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=1\r\nabc\r\n0\r\n\r\n") == b"abc"
    assert warc.decode_chunked(b"HTTP/1.1 200 OK\r\n\r\nplain") == b"plain"
    for bad in (b"none", b"A\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nab\r\n0\r\n\r\n", b"A\r\nTransfer-Encoding: chunked\r\n\r\n5"):
        with pytest.raises(ValueError):
            warc.decode_chunked(bad)
