"""Line dedup, substring dedup, decontamination and piece encoding against plain Python."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import decontaminate, doubling, line_dedup, pieces_bpe
from tidemark.llm import words as wd

SCHEMA = "doc_id long, text string, n_lines string, __x int"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "kept", 1) for i, t in zip(ids or range(len(texts)), texts, strict=True)], SCHEMA)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def test_words_and_windows():
    w = wd.words(pa.array(["ab cd  ab\n", None, "", "é x ab"]))
    assert np.diff(w.rows).tolist() == [3, 0, 0, 2] and w.hashes[0] == w.hashes[2] == w.hashes[4]
    h = np.arange(50, dtype=np.uint64)
    for n in (1, 2, 5, 13):
        assert [int(x) for x in wd.windows(h, n)] == [int(wd.windows(h[i : i + n], n)[0]) for i in range(50 - n + 1)]
    sliced = wd.words_in_slices(pa.array(["a b", None, "c " * 50, "a"]), 8)
    assert np.array_equal(sliced.hashes, wd.words(pa.array(["a b", None, "c " * 50, "a"])).hashes)
    assert len(wd.bare_words(pa.array(['"The, -- END."'])).hashes) == 2


def plain_line_dedup(rows):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        lines = t.split("\n")
        cut = set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if all(not x.strip(" ") for x in w):
                continue
            if w in seen:
                cut |= {k, k + 1, k + 2}
            seen.add(w)
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in cut), len(lines), len(cut))
    return out


def test_line_dedup(spark):
    rng = random.Random(1)
    texts = ["\n".join(rng.choice("abcd") * rng.randrange(3) for _ in range(rng.randrange(12))) for _ in range(60)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.line_dedup(frame(spark, texts)).collect()}
    assert got == plain_line_dedup(list(enumerate(texts)))


def test_line_dedup_defined_cases(spark):
    same = "a\nb\nc"
    df = frame(spark, [same, None, "", same, same, "a\nb\nc\nd"], [1, 2, 3, 4, 4, None])
    got = line_dedup.line_dedup(df)
    assert got.columns == ["doc_id", "text", "__x", "n_lines", "n_removed"]
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.text, r.n_removed) for r in got.collect()), key=str)
    assert rows == sorted([(False, 1, "", 3), (False, 2, None, 0), (False, 3, "", 0), (False, 4, "", 3), (False, 4, "", 3), (True, 0, "a\nb\nc\nd", 0)], key=str)
    assert line_dedup.line_dedup(df.where("false")).count() == 0


def plain_substrings(rows, n):
    first, docs = {}, [(i, SPACE.findall(t or "")) for i, t in rows]
    for i, ws in docs:
        for k in range(len(ws) - n + 1):
            w = tuple(ws[k : k + n])
            first[w] = min(i, first.get(w, i))
    out = {}
    for i, ws in docs:
        gone = {k + j for k in range(len(ws) - n + 1) if first[tuple(ws[k : k + n])] < i for j in range(n)}
        out[i] = (len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone))
    return out


@pytest.mark.parametrize("n", [4, 13, 30])
def test_substring_dedup(spark, n):
    rng = random.Random(n)
    shared = [prose(rng, 60) for _ in range(4)]
    texts = []
    for _ in range(50):
        a, b = sorted(rng.sample(range(60), 2))
        texts.append(" ".join(prose(rng, rng.randrange(30)) + rng.choice(shared)[a:b] + prose(rng, rng.randrange(9))) + rng.choice(["", "\n\t "]))
    texts += [None, "", texts[0], "x " * 40]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in doubling.substring_dedup(frame(spark, texts), n).collect()}
    assert got == plain_substrings(list(enumerate(texts)), n)


def test_equal_first_hashes_do_not_remove_words(spark, monkeypatch):
    """Where the first hash of all last-level windows is one and the same, the second one tells them apart."""
    piece = doubling._Piece
    texts = [" ".join(f"a{k}" for k in range(13)), " ".join(f"b{k}" for k in range(13)), " ".join(f"a{k}" for k in range(13))]
    from tidemark.llm import blocks

    made = []
    for n, t in enumerate(texts):
        sink = pa.BufferOutputStream()
        table = pa.table({"doc_id": pa.array([n]), "text": [t]})
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        made.append(piece(sink.getvalue().to_pybytes(), [13], 1))
    monkeypatch.setattr(piece, "keys", lambda self, level: np.full(len(self.at), 5, np.uint64))
    asks = []
    for n, p in enumerate(made):
        keys, others, first, bounds, _, _ = p.last_ask()
        asks.append(blocks.asks(n, 0, 1, bounds, lambda a, b, k=keys, o=others, f=first: k[a:b].tobytes() + o[a:b].tobytes() + f[a:b].tobytes()))
    told = doubling._earlier(pa.Table.from_batches(asks)).to_pylist()
    assert [np.unpackbits(np.frombuffer(r["bits"], np.uint8))[0] for r in told] == [0, 0, 1]


def test_substring_defined_cases(spark):
    long = " ".join(f"q{k}" for k in range(20))
    df = frame(spark, [long, long, long, long], [5, 5, None, 9])
    got = sorted((r.doc_id or -1, r.n_removed, [tuple(s) for s in r.spans]) for r in doubling.substring_dedup(df, 13).collect())
    assert got == [(-1, 0, []), (5, 0, []), (5, 0, []), (9, 20, [(0, 20)])]
    assert doubling.substring_dedup(df.where("false"), 13).count() == 0
    assert doubling.levels_of(50) == [6, 12, 25, 50]


def bare(t):
    out = [w.lower().strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in SPACE.findall(t or "")]
    return [w for w in out if w]


def plain_overlap(doc, item):
    d, b = bare(doc), bare(item)
    n = min(13, len(b))
    if n < decontaminate.SHORTEST:
        return False
    near = range(len(d) - n + 1)
    return any(sum(x == y for x, y in zip(d[i : i + n], b[j : j + n], strict=True)) >= n - decontaminate.allowed(n) for i in near for j in range(len(b) - n + 1))


def test_masks_cover_every_three_substitutions():
    from itertools import combinations

    for miss in combinations(range(13), 3):
        assert any(not {m + k for m in mask} & set(miss) for mask in decontaminate.MASKS for k in range(13 - mask[-1]))


def test_decontamination(spark):
    rng = random.Random(4)
    items = [" ".join(prose(rng, n)) for n in (4, 5, 6, 7, 9, 12, 15, 30, 40)] + [None, ""]
    docs = []
    for _ in range(150):
        ws = bare(rng.choice(items[:9]))
        for k in rng.sample(range(len(ws)), min(len(ws), rng.randrange(6))):
            ws[k] = "zz"
        a, b = sorted(rng.sample(range(len(ws) + 1), 2))
        docs.append(" ".join(prose(rng, 10) + [w.upper() + rng.choice(["", ",", "."]) for w in ws[a:b]] + prose(rng, 5)))
    docs += [None, "", " ".join(prose(rng, 3000))]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, docs), bench).collect()}
    want = {(i, j) for i, d in enumerate(docs) for j, t in enumerate(items) if plain_overlap(d, t)}
    assert got == want and len(want) > 20
    clean = decontaminate.decontaminated(frame(spark, docs), bench)
    assert clean.columns == ["doc_id", "text", "n_lines", "__x"]
    assert {r.doc_id for r in clean.collect()} == set(range(len(docs))) - {i for i, _ in want}
    assert decontaminate.contaminated(frame(spark, docs), bench.where("false")).count() == 0
    assert decontaminate.contaminated(frame(spark, docs).where("false"), bench).count() == 0


def plain_spans(doc, item):
    """(first_word, end_word, matched) of the windows that match well enough, or None."""
    d, b = bare(doc), bare(item)
    n = min(13, len(b))
    if n < decontaminate.SHORTEST:
        return None
    good = []
    for i in range(len(d) - n + 1):
        for j in range(len(b) - n + 1):
            m = sum(x == y for x, y in zip(d[i : i + n], b[j : j + n], strict=True))
            if m >= n - decontaminate.allowed(n):
                good.append((i, m))
    return (min(i for i, _ in good), max(i for i, _ in good) + n, max(m for _, m in good)) if good else None


def test_every_column_of_decontamination(spark):
    """The query's whole result against all alignments: repeated words, ties, repeated rows, clashing names."""
    rng = random.Random(14)
    items = [" ".join(prose(rng, 40, 6)), "a " * 30, "a b " * 20, " ".join(prose(rng, 25)), "x " * 6 + "y", " ".join(prose(rng, 25))]
    docs = []
    for _ in range(60):
        ws = bare(rng.choice(items))
        for k in rng.sample(range(len(ws)), min(len(ws), rng.randrange(5))):
            ws[k] = "zz"
        docs.append(" ".join(prose(rng, 8, 6) + ws + prose(rng, 8)))
    docs += [docs[0], docs[0], "a " * 90, "a b " * 50, None, ""]
    bench = spark.createDataFrame([(i, t, 0) for i, t in enumerate([*items, items[3]])], "item_id long, text string, doc_id int")
    df = spark.createDataFrame([(i, t, 1, "m") for i, t in enumerate(docs)], "doc_id long, text string, item_id int, matched string").coalesce(2)
    got = sorted(tuple(r) for r in decontaminate.contaminated(df, bench).collect())
    want = sorted((i, j, *s) for i, d in enumerate(docs) for j, t in enumerate([*items, items[3]]) if (s := plain_spans(d, t)))
    assert got == want and len(want) > 60


def test_repeated_words_cost_their_sum():
    import time

    w = wd.bare_words(pa.array(["one " * 20000, "one two " * 10000, "p q r s t u v " * 3000]))
    tests = decontaminate.Tests([1, 2, 3], ["one " * 400, "one two " * 200, "p q r s t u v " * 60])
    doc, _ = tests.hits(w.hashes, w.row)
    assert len(doc) < 4 * (len(w.hashes) + len(tests.hashes))
    began = time.process_time()
    found = tests.overlaps(w)
    assert {(r, i) for r, i, *_ in found} == {(0, 0), (1, 1), (2, 2)} and time.process_time() - began < 5


def test_decontamination_in_blocks(spark, monkeypatch):
    rng = random.Random(6)
    items = [" ".join(prose(rng, 20)) for _ in range(12)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = frame(spark, items)
    whole = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 200)
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == whole


TEXTS = ["the cat", "", None, " lead and  double  ", "é▁x 😀 中", "a" * 500, "tab\tline\n\nend\n", "<s> </s> <unk> <0x41>", "the cat"]


def test_pieces_round_trip(spark):
    df = frame(spark, TEXTS)
    for dropout in (0.0, 0.1, 0.9):
        made = pieces_bpe.decode(pieces_bpe.encode(df, dropout=dropout)).collect()
        assert len(made) == len(TEXTS)
        for r in made:
            assert r.decoded == r.text and (r.piece_ids is None) == (r.text is None)
    assert pieces_bpe.encode(df.where("false")).count() == 0


def test_pieces_without_dropout_are_the_models(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces_bpe.default_model())
    texts = [t for t in TEXTS if t and "▁" not in t]
    got = {r.text: list(r.piece_ids) for r in pieces_bpe.encode(frame(spark, texts), dropout=0.0).collect()}
    assert got == {t: sp.encode(t) for t in texts}


def test_dropout_varies_and_repeats():
    m = pieces_bpe.load(pieces_bpe.default_model())
    texts = pa.array(["internationalisation of the whole vocabulary"] * 20)
    keys = np.arange(20).astype(np.uint64)
    ids, rows = pieces_bpe.encode_array(m, texts, keys, 1, 0.3)
    again, _ = pieces_bpe.encode_array(m, texts, keys, 1, 0.3)
    other, _ = pieces_bpe.encode_array(m, texts, keys, 2, 0.3)
    assert np.array_equal(ids, again) and not np.array_equal(ids, other)
    assert len({tuple(ids[a:b]) for a, b in zip(rows[:-1], rows[1:], strict=True)}) > 5


def plain_pieces(m, text, key, seed, dropout):
    """Piece ids by the definition, one occurrence of a word at a time and one merge at a time."""
    m64, k = (1 << 64) - 1, [int(x) for x in pieces_bpe._K]
    mixed = lambda x: int(wd.mix(np.array([x & m64], np.uint64))[0])
    t = " " + text
    cut = lambda i: (m.cut_spaces and t[i] == " " != t[i - 1]) or (m.cut_lines and "\n" in t[i - 1 : i + 1])
    begin = [0, *(i for i in range(1, len(t)) if cut(i))]
    raw = str(key).encode()
    row = int(wd.hash_spans(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]))[0])
    out = []
    for n, (a, b) in enumerate(zip(begin, [*begin[1:], len(t)], strict=True)):
        draw = mixed(mixed(row + seed) + n * k[1])
        word = [(int(m.char[ord(c)]) if m.char[ord(c)] >= 0 else -ord(c), at) for at, c in enumerate(t[a:b])]
        while True:
            best = None
            for i, ((x, p), (y, q)) in enumerate(zip(word, word[1:], strict=False)):
                new = m.merges.get((x << 20) | y) if min(x, y) >= 0 else None
                if new is not None and not (dropout and mixed(draw + p * k[0] + q * k[1] + new * k[2]) < int(dropout * 2.0**64)):
                    best = min(best or (1 << 40, 0, 0), (int(m.rank[new]), i, new))
            if best is None:
                break
            _, i, new = best
            word[i : i + 2] = [(new, word[i][1])]
        out += [y for x, _ in word for y in ([x] if x >= 0 else m.byte[list(chr(-x).encode())].tolist())]
    return out


def test_pieces_with_dropout_are_the_plain_ones(spark):
    """The query's operator against one agenda an occurrence; frequent words, long words, odd characters, a long text."""
    m, rng = pieces_bpe.load(pieces_bpe.default_model()), random.Random(21)
    words = ["the", "of", "internationalisation", "a", "governing", "é▁x😀", "schaft", "x" * 70, "  ", "\n", "tion\t"]
    texts = [" ".join(rng.choice(words[:4] * 3 + words) for _ in range(rng.randrange(1, 60))) for _ in range(25)] + ["the " * 600, "same of the same", "same of the same"]
    rows = [(i, t, "kept", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece_ids string, x int").coalesce(2)
    for p in (0.0, 0.1, 0.5):
        out = pieces_bpe.encode(df, dropout=p, seed=5)
        assert out.columns == ["doc_id", "text", "x", "piece_ids"]
        for r in out.collect():
            assert r.piece_ids == plain_pieces(m, r.text, r.doc_id, 5, p), (p, r.text)


def test_each_occurrence_has_its_own_draw():
    m = pieces_bpe.load(pieces_bpe.default_model())
    ids, rows = pieces_bpe.encode_array(m, pa.array(["internationalisation"] * 300), np.arange(300).astype(np.uint64), 1, 0.5)
    assert len({tuple(ids[a:b]) for a, b in zip(rows[:-1], rows[1:], strict=True)}) > 100


def test_agenda_agrees_with_the_joint_run():
    m = pieces_bpe.load(pieces_bpe.default_model())
    for p in (0.0, 0.2, 0.6):
        for d in range(25):
            symbols, _ = pieces_bpe._symbols(m, b" ererthandonwhinternational")
            draw = np.array([d * 7919 + 1], np.uint64)
            one, _ = pieces_bpe.segment(m, symbols, np.array([0, len(symbols)]), draw, p)
            assert one.tolist() == pieces_bpe.agenda(m, symbols.tolist(), int(draw[0]), p)


def test_query_digest(spark, tmp_path):
    from tidemark.llm.queries import QUERIES

    frame(spark, ["a b", None]).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.kept_sha256 for r in QUERIES["op8_substring_dedup"](spark, str(tmp_path)).collect()}
    assert got == {0: hashlib.sha256(b"a b").hexdigest(), 1: hashlib.sha256(b"").hexdigest()}
