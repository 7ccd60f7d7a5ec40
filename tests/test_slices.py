"""Segmented scans against plain windows, and one very long video dealt over tasks."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import intervals as iv
from tidemark.operators import sessions as se
from tidemark.operators.slices import Scan

SCHEMA = "video_id long, ord long, start double, end double, speaker string"


def spans(spark, seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = None if rng.random() < 0.02 else round(rng.random() * 300, 1) + (1000 if rng.random() < 0.3 else 0)
        rows.append((rng.choice([1, 1, 1, 2, None]), i, start, None if start is None or rng.random() < 0.02 else start + rng.choice([0.0, 1.5, 40.0]), rng.choice(["a", "b", None])))
    return spark.createDataFrame(rows, SCHEMA)


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


@pytest.mark.parametrize("width", [3.0, 50.0, 1e6])
def test_scans_are_plain_windows(spark, width):
    df = spans(spark, int(width))
    w = Window.partitionBy("video_id").orderBy("start", "ord")
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    got = Scan(df, ["video_id"], "start", "ord", width=width).last_before("b", F.col("speaker")).last_before("k", F.col("speaker"), skip_nulls=True).first_after("n", F.col("end")).greatest_before("g", F.col("end"))
    got = got.with_column("v", F.length(F.coalesce("b", F.lit("xyz")))).total_before("t", "v").done()
    want = df.withColumns({"b": F.lag("speaker").over(w), "k": F.last("speaker", ignorenulls=True).over(upto), "n": F.lead("end").over(w), "g": F.max("end").over(upto)})
    want = want.withColumn("v", F.length(F.coalesce("b", F.lit("xyz")))).withColumn("t", F.coalesce(F.sum("v").over(upto), F.lit(0)))
    same(got, want)


@pytest.mark.parametrize("width", [3.0, 50.0])
def test_ordered_operators_do_not_depend_on_the_slice(spark, width):
    df = spans(spark, 7)
    for run in (
        lambda w: se.islands(df, ["video_id"], "start", 2.0, "ord", width=w),
        lambda w: se.merged(df.withColumn("word", F.col("speaker")), ["video_id", "speaker"], 1.0, "word", width=w),
        lambda w: se.with_gaps(df, ["video_id"], width=w),
        lambda w: se.transitions(df, ["video_id"], "speaker", False, "start", "ord", width=w),
        lambda w: iv.as_of(df.select("video_id", "ord", "start"), df.select("video_id", "end", F.col("ord").alias("mark")), "start", "end", "mark", width=w),
    ):
        same(run(width), run(1e9))


def test_empty_tables(spark):
    df = spans(spark, 1, 5).where("false")
    assert se.islands(df, ["video_id"], "start", 2.0, "ord").count() == se.merged(df, ["video_id"], 1.0).count() == se.boundaries_kept(df, ["video_id"], "start", 1.0).count() == 0


def plain_kept(ts, least):
    out = []
    for t in sorted(ts):
        if not out or t - out[-1] >= least:
            out.append(t)
    return out


@pytest.mark.parametrize("least,width", [(0.3, 1.0), (5.0, 1.0), (0.0, 50.0), (2.5, 1e6)])
def test_boundaries_are_the_plain_fold(spark, least, width):
    rng = random.Random(int(width))
    points = [(v, round(rng.random() * 200, 1) + (2000 if rng.random() < 0.2 else -50)) for v in (1, 1, 1, 2) for _ in range(150)] + [(3, 4.0), (1, None)]
    got = se.boundaries_kept(spark.createDataFrame(points, "video_id long, t double"), ["video_id"], "t", least, width).collect()
    for v in (1, 2, 3):
        assert sorted(r.t for r in got if r.video_id == v) == plain_kept([t for u, t in points if u == v and t is not None], least)


def test_a_video_of_a_million_rows_is_shared_out(spark):
    n = 1_000_000
    rows = spark.range(n).select(F.lit(1).alias("video_id"), F.col("id").alias("ord"), (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 10.0).alias("start"))
    rows = rows.withColumn("end", F.col("start") + 0.05)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scan = Scan(rows, ["video_id"], "start", "ord").greatest_before("reach", F.col("end"))
        most = scan.rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most <= n / 10
        got = se.merged(rows, ["video_id"], 0.0).agg(F.sum("pieces"), F.count("*")).first()
        ts = np.unique([r.start for r in rows.select("start").distinct().collect()])
        assert got[0] == n and got[1] == int((np.diff(ts) > 0.05 + 1e-9).sum()) + 1
        kept = sorted(r.start for r in se.boundaries_kept(rows.where("ord % 20 = 0"), ["video_id"], "start", 1.0).collect())
        assert kept == plain_kept([r.start for r in rows.where("ord % 20 = 0").select("start").collect()], 1.0)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
