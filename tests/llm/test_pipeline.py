"""The pipeline's stages keep the contract of documents and take effect."""

import os
import random
import zlib

import pytest
from test_model_ops import plain_classes, plain_scores
from test_text_ops import plain_line_dedup, plain_overlap, plain_pieces, prose

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture():
    """(documents, labels, benchmark) with what each stage looks for, and the odd cases: nulls, empty and long texts, repeated rows."""
    rng = random.Random(31)
    bench = [" ".join(prose(rng, 20)) for _ in range(3)] + [None]
    shared = ["\n".join(" ".join(prose(rng, 6)) for _ in range(4)) for _ in range(3)]
    docs, labels = [], {}
    for i in range(90):
        lines = [" ".join(prose(rng, rng.randrange(4, 12), 4000)) for _ in range(rng.randrange(3, 9))]
        if rng.random() < 0.25:
            lines[rng.randrange(len(lines))] += " " + " ".join(rng.choice(["Idiot", "moron,", "scum"]) for _ in range(3))
            labels[i] = 1
        elif rng.random() < 0.7:
            labels[i] = 0
        if i % 6 == 1:
            lines.insert(1, rng.choice(shared))
        if i % 13 == 2:
            lines.append(rng.choice(bench[:3]))
        docs.append((i, "\n".join(lines)))
    for k, i in enumerate((3, 10, 10, 44)):
        ws = docs[i][1].split(" ")
        ws[len(ws) // 2] = f"other{k}"
        docs.append((100 + k, " ".join(ws)))
    docs += [(200, None), (201, None), (202, ""), (203, " \n "), (204, "tail " * 15000), docs[5], docs[5], (205, docs[7][1]), (206, "é▁x 😀")]
    labels |= {200: 0, 202: 1}
    return docs, labels, bench


def written(spark, folder, docs, labels, bench, schema=SCHEMA, extra=()):
    rows = [(i, t, "en", "s", len(t) if t else 0, *extra) for i, t in docs]
    spark.createDataFrame(rows, schema).coalesce(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels.items()), "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def plain_pipeline(docs, labels, bench):
    """{(doc_id, text, piece ids)} that the five stages leave, by their definitions."""
    from tidemark.llm import pieces_bpe

    told = plain_scores(docs, labels, lambda i: zlib.crc32(str(i).encode()) % 4 != 2)
    kept = [d for d, (score, _) in zip(docs, told, strict=True) if score < 0.3]
    cut = plain_line_dedup(sorted({d for d in kept if d[1] is not None}))
    kept = [(i, t if t is None else cut[i][0]) for i, t in kept]
    classes = plain_classes([(i, "\0 null" if t is None else t) for i, t in kept])
    kept = [(i, t) for i, t in dict(kept).items() if classes[i] == i]
    kept = [(i, t) for i, t in kept if not any(plain_overlap(t, b) for b in bench)]
    model = pieces_bpe.load(pieces_bpe.default_model())
    return sorted((i, t, None if t is None else tuple(plain_pieces(model, t, i, 17, 0.1)) if t else ()) for i, t in kept)


def test_run_is_the_plain_pipeline(spark, tmp_path):
    docs, labels, bench = fixture()
    out = cp.run(spark, written(spark, tmp_path, docs, labels, bench))
    rows = out.collect()
    assert out.columns == [*cp.COLUMNS, "piece_ids"]
    got = sorted((r.doc_id, r.text, None if r.piece_ids is None else tuple(r.piece_ids)) for r in rows)
    want = plain_pipeline(docs, labels, bench)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert got == want
    assert 30 < len(want) < len(docs) - 20
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)


def test_each_stage_on_odd_tables(spark, tmp_path):
    """Empty tables, all-null columns, and extra columns whose names the operators use themselves."""
    docs, labels, bench = fixture()
    names = ["score", "predicted", "n_lines", "class_id", "rid", "y", "item_id", "piece_id"]
    schema = SCHEMA + "".join(f", {n} string" for n in names)
    sf = written(spark, tmp_path / "a", docs, labels, bench, schema, tuple("kept" for _ in names))
    full = spark.read.parquet(f"{sf}/documents.parquet")
    empty = written(spark, tmp_path / "b", [], {}, [])
    nothing = spark.createDataFrame([(None, None, None, None, None)] * 3, SCHEMA).coalesce(1)
    nothing.write.parquet(f"{tmp_path}/nulls.parquet")
    nothing = spark.read.parquet(f"{tmp_path}/nulls.parquet")
    for n, (_, stage) in enumerate(cp.STAGES):
        more = ["piece_ids"] if n == len(cp.STAGES) - 1 else []
        out = stage(spark, full, sf)
        assert out.columns == full.columns + more
        assert {r.score for r in out.collect()} == {"kept"}
        assert stage(spark, spark.read.parquet(f"{empty}/documents.parquet"), sf).count() == 0
        assert stage(spark, full, empty).count() > 0
        rows = stage(spark, nothing, sf).collect()
        assert len(rows) == 3 and all(r.text is None for r in rows)



@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for n, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        assert docs.columns == cp.COLUMNS + (["piece_ids"] if n == len(cp.STAGES) - 1 else [])
        sizes.append(docs.count())
    assert sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[3] <= sizes[2] and sizes[4] < sizes[3] and sizes[5] == sizes[4]
    assert docs.select("doc_id").distinct().count() == docs.count()
    assert docs.where("n_chars <> length(text)").count() == 0
    from tidemark.llm import bagminhash, decontaminate, pieces_bpe

    assert pieces_bpe.decode(docs).where("not decoded <=> text").count() == 0
    assert decontaminate.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    assert bagminhash.classes(docs).where("doc_id <> class_id").count() == 0
