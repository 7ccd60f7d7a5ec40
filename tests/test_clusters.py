"""Density clusters dealt over tasks, and average linkage by chains, against tables of all pairs."""

import resource
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from tidemark.operators import density
from tidemark.operators import folds as fo


def faces(seed, n, d=8, people=6, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(people, d))
    x = centres[rng.integers(0, people, n)] + rng.normal(size=(n, d)) * spread
    x[:: max(1, n // 15)] = rng.normal(size=(len(x[:: max(1, n // 15)]), d))  # noise
    x[n // 3 : n // 3 + n // 4] = x[n // 3]  # a third of a scene may be one face
    return x


@pytest.mark.parametrize(("eps", "least", "cell"), [(0.02, 3, 20), (0.1, 2, 20), (0.35, 5, 7), (1.2, 2, 30)])
def test_dealt_clusters_are_the_plain_ones(spark, monkeypatch, eps, least, cell):
    monkeypatch.setattr(density, "CELL", cell)
    monkeypatch.setattr(density, "DEALT", 100)
    monkeypatch.setattr(density, "TILE", (16, 64))
    monkeypatch.setattr(fo, "DENSE", 50)
    scenes = {(v, s): faces(v * 10 + s + int(eps * 100), n) for v, s, n in ((1, 1, 300), (1, 2, 220), (2, 1, 40), (2, 2, 2), (3, 1, 51))}
    rows = [(v, s, k * 3 + 1, x.tolist()) for (v, s), m in scenes.items() for k, x in enumerate(m)]
    df = spark.createDataFrame(rows, "video_id long, scene_id long, ord long, embedding array<double>").repartition(6)
    got = {(r.video_id, r.scene_id, r.ord): r.cluster for r in fo.clustered(df, least * 2, eps).collect()}
    want = {}
    for (v, s), m in scenes.items():
        label = np.zeros(len(m), int) if len(m) < least * 2 else fo.dbscan(m, eps, least)
        want |= {(v, s, k * 3 + 1): int(c) for k, c in enumerate(label) if c >= 0}
    assert got == want


def test_a_large_scene(spark):
    """100,000 faces of one scene, more than any table of pairs can hold."""
    n, people, d = 100_000, 40, 16
    x = F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda i: F.sin(F.pmod("id", F.lit(people)) * (i + 1) * 1.7 + i) + F.sin(F.col("id") * (i + 2) * 0.37) * 0.01)
    df = spark.range(n).select(F.lit(1).cast("long").alias("video_id"), F.lit(1).cast("long").alias("scene_id"), F.col("id").alias("ord"), x.alias("embedding"))
    got = fo.clustered(df, 6, 0.01).groupBy("cluster").agg(F.count("*").alias("n"), F.min(F.pmod("ord", F.lit(people))).alias("a"), F.max(F.pmod("ord", F.lit(people))).alias("b")).collect()
    assert sorted((r.cluster, r.n, r.a, r.b) for r in got) == [(k, n // people, k, k) for k in range(people)]


def test_components():
    rng = np.random.default_rng(1)
    for n, m in ((1, 0), (30, 20), (200, 150)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        label = np.arange(n)
        for _ in range(n):
            for i, j in zip(a, b, strict=True):
                label[[i, j]] = min(label[i], label[j])
        assert density.lowest(n, a, b).tolist() == label.tolist()


@pytest.mark.parametrize("most", [1e-9, 0.05, 0.3, 0.8, 2.0])
def test_chains_cut_the_same_tree(most):
    for seed in range(12):
        m = faces(seed, 5 + seed * 9, 3 + seed % 4)
        m[1::5] = m[0]  # equal faces are ties
        assert fo.average_linkage(m, most).tolist() == plain.average_linkage(m, most).tolist()
    assert fo.average_linkage(np.zeros((0, 3)), most).tolist() == []


def test_linkage_of_many_faces():
    start, before = time.time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    label = fo.average_linkage(faces(3, 20_000, 16, 300, 0.1), 0.1)
    assert len(np.unique(label)) > 100 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000
    assert time.time() - start < 300
