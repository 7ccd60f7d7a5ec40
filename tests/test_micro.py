"""Literal fixtures with hand-computed results."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions import time as tm
from tidemark.operators import folds as fo
from tidemark.operators import frames as fr
from tidemark.operators import intervals as iv
from tidemark.operators import matching as ma
from tidemark.operators import quality as ql
from tidemark.operators import scoring as sc
from tidemark.operators import sessions as se
from tidemark.operators import tracking as tk


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("f", "seconds", "said"),
    [
        (tm.readable, 3665.123, "1:01:05"), (tm.readable, 65.9, "1:05"), (tm.srt, 0.0, "00:00:00,000"), (tm.srt, 5.0, "00:00:05,000"),
        (tm.srt, 1.001, "00:00:01,000"), (tm.vtt, 3661.5, "01:01:01.500"), (tm.vtt_rounded, 59.9996, "00:00:60.000"), (tm.compact, 185.0, "3m5s"), (tm.duration, 3723.0, "1h 2m 3s"),
    ],
)
def test_time(spark, f, seconds, said):
    assert one(spark, f(F.lit(seconds))) == said


@pytest.mark.parametrize(("text", "value"), [("00:01:05", 65.0), ("1:2", 0.0), ("a:b:c", 0.0), (None, 0.0)])
def test_parse_clock(spark, text, value):
    assert one(spark, tm.parse_clock(F.lit(text).cast("string"))) == value


def test_names(spark):
    said = {0: "Unknown", 1: "A", 2: "A and B", 3: "A, B, and C"}
    for n, v in said.items():
        assert one(spark, tx.names_list(F.array(*[F.lit(x) for x in "ABC"[:n]]).cast("array<string>"))) == v


def test_html_escape(spark):
    assert one(spark, tx.html_escape(F.lit("<a b='c'>&\"</a>"))) == "&lt;a b=&#x27;c&#x27;&gt;&amp;&quot;&lt;/a&gt;"


def test_json_in_text(spark):
    schema = "array<struct<a:int>>"
    for text, n in (('so: [{"a": 1}] done', 1), ("no json", 0), ("[{bad", 0)):
        assert len(one(spark, tx.json_array(F.lit(text), schema))) == n


def test_unknown_emotions_align(spark):
    assert one(spark, tx.emotions_align(F.lit("x"), F.lit("y"))) is True
    assert one(spark, tx.emotions_align(F.lit("sad"), F.lit("fear"))) is True
    assert one(spark, tx.emotions_align(F.lit("sad"), F.lit("happy"))) is False


@pytest.mark.parametrize(("size", "mark", "share"), [(180, ",", 7), (350, ",", 7), (90, ",", 7), (350, ".", 6), (90, ".", 6)])
def test_a_mark_at_the_limit_is_not_late(spark, size, mark, share):
    """A cut text of ``size`` letters with its last mark exactly at 6 or 7 tenths, and one letter later (as doubles, 180 * 0.7 is below 126)."""
    for late in (0, 1):
        at = size * share // 10 + late
        cut = "a " * 10 + "b" * (at - 20) + mark + "c" * (size - at - 1)
        got = spark.createDataFrame([(cut + " more words",)], "t string").select(tx.summary(F.col("t"), 11).alias("v")).first().v
        assert got == ((cut[: at + 1] if mark == "." else cut[:at] + "...") if late else cut + "...")


def test_template():
    assert tx.template("narr") == tx.TEMPLATES["narrative"]
    with pytest.raises(KeyError):
        tx.template("x")


def test_merge_tolerance(spark):
    rows = spark.createDataFrame([(1, 0, 0.0, 10.0, "Hello"), (1, 1, 10.1, 20.0, "World"), (1, 2, 30.0, 40.0, "Test")], "video_id long, ord long, start double, end double, text string")
    got = se.merged(rows, ["video_id"], 0.1, "text").orderBy("start").collect()
    assert [(r.start, r.end, r.text) for r in got] == [(0.0, 20.0, "Hello World"), (30.0, 40.0, "Test")]


def test_boundaries(spark):
    ts = spark.createDataFrame([(1, t) for t in (0.0, 0.3, 1.0, 1.4, 2.0)], "video_id long, t double")
    assert sorted(r.t for r in se.boundaries_kept(ts, ["video_id"], "t", 0.5).collect()) == [0.0, 1.0, 2.0]
    got = se.boundaries_to_spans(ts.where("t in (0, 1, 2)"), ["video_id"], "t", F.lit(3.0)).orderBy("start").collect()
    assert [(r.start, r.end) for r in got] == [(0, 1), (1, 2), (2, 3)]


def test_gap_of_exactly_the_limit_stays(spark):
    pts = spark.createDataFrame([(1, 0.0), (1, 2.0), (1, 4.5)], "video_id long, t double")
    assert sorted((r.start, r.end) for r in se.islands(pts, ["video_id"], "t", 2.0).collect()) == [(0.0, 2.0), (4.5, 4.5)]


def test_interval_join_against_brute_force(spark):
    rng = np.random.default_rng(3)
    a = [(int(v), i, float(s), float(s + d)) for i, (v, s, d) in enumerate(zip(rng.integers(0, 3, 80), rng.integers(0, 300, 80), rng.integers(0, 90, 80), strict=True))]
    b = [(int(v), i, float(s), float(s + d)) for i, (v, s, d) in enumerate(zip(rng.integers(0, 3, 80), rng.integers(0, 300, 80), rng.integers(0, 9, 80), strict=True))]
    left, right = spark.createDataFrame(a, "video_id long, i long, s double, e double"), spark.createDataFrame(b, "video_id long, j long, t0 double, t1 double")
    want = {(x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] <= y[3] and y[2] <= x[3]}
    for width in (7.0, 60.0, 1000.0):
        got = iv.interval_join(left, right, ["video_id"], ("s", "e"), ("t0", "t1"), width).select("i", "j").collect()
        assert len(got) == len(want) and {(r.i, r.j) for r in got} == want
    outer = iv.interval_join(left, right.where("false"), ["video_id"], ("s", "e"), ("t0", "t1"), 60.0, how="left")
    assert outer.count() == len(a)


def test_half_open_and_closed_bounds(spark):
    p = spark.createDataFrame([(1, 10.0)], "video_id long, at double")
    s = spark.createDataFrame([(1, 0.0, 10.0)], "video_id long, s0 double, s1 double")
    assert iv.point_join(p, s, "at", ("s0", "s1"), 5.0).count() == 1
    assert iv.point_join(p, s, "at", ("s0", "s1"), 5.0, closed=False).count() == 0


def test_resize_never_enlarges(spark):
    w, h = ql.resized(F.lit(100.0), F.lit(50.0), 640, 480)
    assert spark.range(1).select(w.alias("w"), h.alias("h")).first() == (100, 50)


def test_audio_slice(spark):
    samples = F.sequence(F.lit(1), F.lit(1000)).cast("array<double>")
    assert one(spark, F.size(ql.audio_slice(samples, F.lit(0.01), F.lit(0.01), 1000))) == 0
    assert one(spark, F.size(ql.audio_slice(samples, F.lit(0.0), F.lit(0.5), 1000))) == 500
    assert one(spark, F.size(ql.audio_slice(samples, F.lit(0.1), F.lit(0.11), 1000))) == 400


def test_temporal(spark):
    assert one(spark, sc.temporal(F.lit(0.0))) == 0.5
    assert one(spark, sc.temporal(F.lit(0.25))) == 0.25
    assert math.isclose(one(spark, sc.temporal(F.lit(1.0))), math.exp(-2) * 0.15)


def test_assignment_is_optimal():
    from itertools import permutations

    rng = np.random.default_rng(5)
    for n, m in ((1, 1), (3, 3), (2, 4), (4, 2), (5, 5)):
        c = rng.random((n, m))
        best = min(sum(c[i, j] for i, j in zip(range(n), p, strict=True)) for p in permutations(range(m), n)) if n <= m else min(sum(c[i, j] for i, j in zip(p, range(m), strict=True)) for p in permutations(range(n), m))
        assert math.isclose(sum(c[i, j] for i, j in tk.assign(c)), best)
    assert tk.assign(np.zeros((0, 3))) == []


def test_clusters():
    v = np.array([[1, 0], [0.99, 0.1], [0, 1], [0.1, 0.99], [-1, -1]])
    assert fo.dbscan(v, 0.1, 2).tolist() == [0, 0, 1, 1, -1]
    assert fo.average_linkage(v, 0.1).tolist() == [0, 0, 1, 1, 2]
    assert fo.greedy(v, 0.9).tolist() == [0, 0, 2, 2, 4]


def test_matching_in_order(spark):
    """Scores by hand: time 0.3, continuity 0.1 from the end of the last match, position 0.1, emotion 0.1, speaker 0.3 once learned."""
    cols = "video_id long, segment_id string, ord long, start double, end double, speaker_id string, character_id string, distance double, window double, position double, emotion_score double"
    rows = [
        (1, "a", 0, 0.0, 10.0, "s", "X", 0.0, 30.0, 0.8, 0.5),
        (1, "a", 0, 0.0, 10.0, "s", "Y", 15.0, 30.0, 1.0, 1.0),
        (1, "b", 1, 14.0, 15.0, "s", "X", 30.0, 30.0, 0.8, None),
        (1, "c", 2, 60.0, 61.0, "s", None, None, 30.0, None, None),
    ]
    got = {r.segment_id: r for r in ma.match_in_order(spark.createDataFrame(rows, cols)).collect()}
    first = (0.3 * 1 + 0.1 * 0.5 + 0.1 * 0.8 + 0.1 * 0.5) / 0.6
    assert (got["a"].character_id, got["a"].continuity) == ("X", 0.5) and math.isclose(got["a"].score, first)
    second = (0.3 * 0 + 0.3 * first + 0.1 * 0.9 + 0.1 * 0.8) / 0.8
    assert (got["b"].character_id, got["b"].continuity) == ("X", 0.9) and math.isclose(got["b"].score, second)
    assert got["c"].second_pass and math.isclose(got["c"].score, 0.8 * (first + second) / 2)
    bare = spark.createDataFrame([r[:9] for r in rows], cols.partition(", position")[0])
    assert math.isclose({r.segment_id: r.score for r in ma.match_in_order(bare).collect()}["a"], (0.3 + 0.05) / 0.4)


def test_budgets(spark):
    rows = spark.createDataFrame([(v, i, i % 2 == 0) for v, n in ((1, 10), (2, 40)) for i in range(n)], "video_id long, ord long, said boolean")
    kept = lambda b: {v: sorted(r.ord for r in fr.budgeted(rows, ["video_id"], F.col("said"), b, "ord").collect() if r.video_id == v) for v in (1, 2)}
    assert kept(5) == {1: [0, 2, 4, 6, 8], 2: [0, 8, 16, 24, 32]}
    assert kept(7)[1] == [0, 1, 2, 4, 5, 6, 8]
    assert len(kept(25)[2]) == 25


def test_enhancement():
    rng = np.random.default_rng(2)
    flat = fr.enhanced(np.full((8, 8), 100.0), least=16)
    assert flat.shape == (16, 16) and flat.std() == 0
    image = np.clip(rng.normal(120, 20, (24, 24)), 0, 255)
    assert fr.enhanced(image, denoise=False, sharpen=False, least=8).std() > image.std()
    plain = fr.enhanced(image, contrast=False, denoise=False, least=8)
    i, v = np.round(image), np.clip(9 * np.round(image)[5, 5] - (np.round(image)[4:7, 4:7].sum() - np.round(image)[5, 5]), 0, 255)
    assert plain[5, 5] == v and i.shape == plain.shape
    dark = fr.enhanced(np.full((8, 8), 10.0), contrast=False, least=8)
    assert (dark == 45).all()


def test_average_hash(spark):
    import hashlib

    row = [1.0, 2.0, 3.0, 10.0]
    want = hashlib.md5(b"0001").hexdigest()[:16]
    df = spark.createDataFrame([(2, 5, row), (1, 3, row), (3, 9, [9.0, 0.0, 0.0, 0.0])], "video_id long, ord long, p array<double>")
    assert one(spark, fr.average_hash(F.array(*[F.lit(x) for x in row]))) == want
    assert sorted(r.ord for r in fr.first_of_hash(df, "p", "ord").collect()) == [3, 9]


def test_short_scenes_are_merged_once(spark):
    rows = spark.createDataFrame([(1, k + 1, a, b) for k, (a, b) in enumerate([(0.0, 1.0), (1.0, 2.0), (2.0, 9.0), (9.0, 9.5)])], "video_id long, id long, start double, end double")
    assert [(r.start, r.end) for r in fo.short_merged(rows, 2.0).orderBy("id").collect()] == [(0, 2), (2, 9), (9, 9.5)]


def test_continuity():
    assert ma.continuity([], 1, "a") == 0.5
    assert ma.continuity([(0, "a")], 3, "a") == 0.9
    assert ma.continuity([(0, "a")], 20, "a") == 0.7
    assert ma.continuity([(0, "a"), (1, "b")], 90, "a") == 0.65


def test_peaks():
    assert fo.peaks(np.array([0, 5, 0, 5, 0, 5, 0.0])).tolist() == [1, 3, 5]
    assert fo.peaks(np.zeros(2)).tolist() == []


def test_smoothing_is_in_place(spark):
    rows = spark.createDataFrame([(1, 0, "a", 1.0), (1, 1, "a", 0.0)], "video_id long, ord long, character_id string, score double")
    assert [round(r.score, 6) for r in fo.smoothed_in_place(rows).orderBy("ord").collect()] == [0.7, 0.21]
