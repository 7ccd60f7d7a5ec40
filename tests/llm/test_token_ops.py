"""Byte-level BPE, cross-tokenizer groups and ranked search against the libraries and plain Python."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import align, byte_bpe, lexical

PIECES = ["a", "b", "e", "th", "ing", " ", "  ", "\n", "'", "'s", "'re", "'ll", "!", "1", "23", "é", "中", "文", " ", "　", "😀", "<|endoftext|>", "<|endof", "text|>", "\t", "'ve", "x'm", "٣", "Ⅷ", "́", "____", "=-", "\r\n", "\x00"]


def odd_texts(seed, n, alphabet=PIECES, longest=120):
    rng = random.Random(seed)
    return ["".join(rng.choices(rng.sample(alphabet, rng.randrange(1, len(alphabet))), k=rng.randrange(longest))) for _ in range(n)] + [None, ""]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe.default_model())


# ---- byte-level BPE ----------------------------------------------------------------------


@pytest.mark.parametrize(("leaf", "window"), [(16, 8), (64, 8), (16, 32), (4096, 32)])
def test_trees_give_the_tokenizers_ids(monkeypatch, leaf, window):
    monkeypatch.setattr(byte_bpe, "LEAF", leaf)
    monkeypatch.setattr(byte_bpe, "WINDOW", window)
    model = byte_bpe.load(byte_bpe.default_model())
    texts = odd_texts(leaf + window, 1500)
    ids, rows = byte_bpe.encode_array(model, pa.array(texts, pa.string()))
    want = [e.ids for e in library().encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(rows)] == want
    assert byte_bpe.decode_array(model, ids.astype(np.int64), rows).to_pylist() == [t or "" for t in texts]


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 30_000, "中文字" * 9_000, " " * 20_000 + "x", "=-" * 20_000, "'" * 9_999 + "s", "12" * 9_000, "x" * 4_095 + "'s" + "y" * 4_095, "\n" * 5_000])
def test_long_unsplit_texts(text):
    ids, _ = byte_bpe.encode_array(byte_bpe.load(byte_bpe.default_model()), pa.array([text]))
    assert ids.tolist() == library().encode(text, add_special_tokens=False).ids


def test_the_table_of_pre_tokens_is_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT", 10)
    model = byte_bpe.Model(byte_bpe.default_model())
    for k in range(3):
        text = " ".join(f"w{k}{i}" for i in range(50))
        assert byte_bpe.encode_array(model, pa.array([text]))[0].tolist() == library().encode(text, add_special_tokens=False).ids


def test_encode_and_decode_frames(spark, monkeypatch):
    """Long texts are dealt over tasks and joined again; other columns pass, also those with names of its own."""
    monkeypatch.setattr(byte_bpe, "SPREAD", 300)
    rng = random.Random(4)
    long = ["".join(rng.choices(PIECES, k=400)) for _ in range(6)] + ["z" * 3000, "<|endoftext|>" * 60]
    texts = odd_texts(9, 60) + long + long[:2]
    rows = [(i // 2, t, f"kept{i}", i, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, part long, ids int")
    coded = byte_bpe.encode(df)
    assert coded.columns == ["doc_id", "text", "key", "part", "ids"]
    got = {r.part: r for r in byte_bpe.decode(coded).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert (got[i].doc_id, got[i].text, got[i].key, got[i].decoded) == (i // 2, t, f"kept{i}", t)
        assert got[i].ids == (None if t is None else library().encode(t, add_special_tokens=False).ids)
    assert byte_bpe.encode(df.where("false")).count() == 0
    only = byte_bpe.encode(df.select("text").where("length(text) > 300"))
    assert only.count() == sum(len(t or "") > 300 for t in texts)


def test_decoding_of_broken_bytes(spark):
    one = library().encode("é", add_special_tokens=False).ids
    rows = [([library().token_to_id("Ã")],), (one,), ([],), (None,), ([50256, *one],)]
    got = [r.decoded for r in byte_bpe.decode(spark.createDataFrame(rows, "ids array<int>").coalesce(1)).collect()]
    assert got == ["�", "é", "", None, "<|endoftext|>é"]
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([([60_000],)], "ids array<int>")).collect()


def test_other_files_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        byte_bpe.Model(public_tokenizers.path("word_bpe_49k.json"))


# ---- groups of two tokenizers ------------------------------------------------------------


def plain_alignment(texts):
    import sentencepiece

    t, sp = library(), sentencepiece.SentencePieceProcessor(model_file=align.default_piece_model())
    t.encode_special_tokens = True
    alphabet = byte_bpe._alphabet()
    spell_a = lambda i: bytes(alphabet[c] for c in t.id_to_token(i))
    spell_b = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    docs = []
    for text in texts:
        a, b = (t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        raw_a, raw_b = [spell_a(i) for i in a], [spell_b(i) for i in b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            docs.append(None)
            continue
        ends_a, ends_b = list(itertools.accumulate(map(len, raw_a))), list(itertools.accumulate(map(len, raw_b)))
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = i, j
            while i < len(a) and ends_a[i] <= end:
                i += 1
            while j < len(b) and ends_b[j] <= end:
                j += 1
            groups.append((a[p:i], b[q:j]))
        docs.append((a, b, groups))
    counts, best = Counter(), defaultdict(int)
    for d in docs:
        counts.update({(x, y) for p, q in d[2] for x in p for y in q} if d else ())
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for d in docs:
        links = [(x, y) for p, q in d[2] for x in p for y in q] if d else []
        said = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in d[2]) if d else ""
        n = (len(d[0]), len(d[1]), len(d[2])) if d else (0, 0, 0)
        out.append((*n, len(links), said, sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links)))
    return out


@pytest.mark.parametrize(("common", "crowd"), [(1_000_000, 256), (50, 1), (1, 256)])
def test_alignment(spark, monkeypatch, common, crowd):
    """Common pairs, pairs that meet their counts in a join, and groups listed by their distinct ids give the same."""
    monkeypatch.setattr(align, "COMMON", common)
    monkeypatch.setattr(align, "CROWD", crowd)
    monkeypatch.setattr(align, "TEXT", 3000)
    texts = odd_texts(3, 250, [*PIECES, "<s>", "</s>", "<0x41>", "▁", "ﬁ"], 60) + ["a" * 3000, "中" * 900, "one two", "one two"]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, piece int").repartition(3)
    columns = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")
    got = {r.doc_id: tuple(r[c] for c in columns) for r in align.align(df, whole_text=True).collect()}
    want = plain_alignment(texts)
    assert [got[i] for i in range(len(texts))] == want
    digest = {r.doc_id: r.groups for r in align.align(df).collect()} if common == 1 else {}
    assert all(digest[i] == (hashlib.sha256(w[4].encode()).hexdigest() if w[0] else "") for i, w in enumerate(want) if digest)


def test_alignment_of_no_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_groups, r.count_sum) for r in align.align(df).collect()))
    assert got == [(0, 2, 4), (0, 2, 4), (3, 0, 0)]
    assert align.align(df.where("false")).count() == 0


# ---- ranked search -----------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_search(docs, items, k):
    rows = [(i, Counter(plain_terms(t))) for i, t in docs]
    rows = [(i, c) for i, c in rows if c]
    n_docs, n_terms = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in rows:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(plain_terms(text)) if t in c)
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def test_terms():
    texts = ["Ab-cD 12é_x", None, "", "\x00\x7f", "É É", "z" * 9]
    key, at = lexical.terms(pa.array(texts))
    assert np.diff(at).tolist() == [len(plain_terms(t)) for t in texts]
    assert lexical.terms(pa.array(["aB"]))[0][0] == lexical.terms(pa.array(["Ab"]))[0][0] == key[0] and key[4 - 1] != key[0]


@pytest.mark.parametrize(("window", "fan_in", "query_bytes"), [(8192, 64, 8 << 20), (64, 2, 200)])
def test_search(spark, monkeypatch, window, fan_in, query_bytes):
    """Several windows, levels of merging and passes; ties, twins, nulls and rows without terms."""
    for name, value in (("WINDOW", window), ("FAN_IN", fan_in), ("QUERY_BYTES", query_bytes)):
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(window)
    words = [f"{c}{k}" for c in "aBcÉ" for k in range(12)] + ["THE", "the"] * 20
    docs = [(rng.randrange(-50, 10**6), " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for _ in range(500)]
    docs += [(i + 10**7, docs[0][1]) for i in range(15)] + [(7, None), (8, "--"), (9, ""), (None, docs[0][1]), docs[3], docs[3]]
    items = [(i % 9, " ".join(rng.choices(words, k=rng.randrange(0, 9)))) for i in range(12)] + [(None, docs[0][1]), (20, None), (21, "nothing here")]
    df = spark.createDataFrame([(i, t, 1.5) for i, t in docs], "doc_id long, text string, score double").repartition(7)
    got = lexical.ranked(df, spark.createDataFrame(items, "item_id int, text string"), 10)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(docs, items, 10)


def test_search_without_documents_or_items(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked(df.where("false"), items).count() == 0
    assert lexical.ranked(df, items.where("false")).count() == 0
    assert [tuple(r) for r in lexical.ranked(df, items).collect()] == plain_search([(1, "a b")], [(1, "a")], 10)
