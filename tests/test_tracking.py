"""Tracks of many parts in step against one tracker a video, frame by frame."""

import math
import random

import numpy as np
import pytest

from plain import Tracker
from tidemark.operators import tracking as tk

BOX = "struct<x1 double, y1 double, x2 double, y2 double>".replace(" double", ": double")


def gappy(seed, videos=6, frames=160, faces=False):
    """Videos of a few moving boxes that come and go, with gaps of empty frames."""
    rng = random.Random(seed)
    rows = []
    for v in range(videos):
        at, things, n = rng.randrange(50), [], 0
        while n < frames:
            at += rng.choice([1, 1, 1, 1, 2, 3, 9, 40]) if rng.random() < 0.3 else 1
            if len(things) < 4 and rng.random() < 0.2:
                things.append([rng.uniform(0, 300), rng.uniform(0, 200), rng.uniform(-4, 4), rng.uniform(-3, 3), rng.uniform(30, 60)])
            things = [t for t in things if rng.random() < 0.97]
            for t in things:
                t[0], t[1] = t[0] + t[2] + rng.gauss(0, 1), t[1] + t[3] + rng.gauss(0, 1)
                if rng.random() < 0.85:
                    face = [rng.gauss(math.cos(k + t[4]), 0.1) for k in range(3)] if faces else None
                    rows.append((v, at, len(rows), (t[0], t[1], t[0] + t[4], t[1] + t[4] * 1.2), face))
            n += 1
    return rows


def plain(rows, max_age, min_hits, faces):
    out = []
    for v in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == v]
        tracker = Tracker(max_age, min_hits)
        for frame in range(min(r[1] for r in mine), max(r[1] for r in mine) + 1):
            now = [r for r in mine if r[1] == frame]
            boxes = np.array([r[3] for r in now], float).reshape(-1, 4)
            vectors = np.array([r[4] for r in now], float).reshape(-1, 3) if faces else None
            out += [(v, frame, now[j][2], i) for j, i in tracker.step(boxes, vectors)]
    return sorted(out)


@pytest.mark.parametrize(("max_age", "min_hits", "faces"), [(5, 3, False), (30, 1, False), (2, 6, False), (5, 1, True), (12, 3, True)])
def test_parts_in_step_are_the_plain_tracks(spark, monkeypatch, max_age, min_hits, faces):
    rows = gappy(max_age, faces=faces)
    monkeypatch.setattr(tk, "FRAMES", 50)
    df = spark.createDataFrame(rows, f"video_id long, frame long, ord long, box {BOX}, face array<double>")
    got = sorted((r.video_id, r.frame, r.ord, r.track_id) for r in tk.tracked(df.repartition(5), max_age, min_hits, "face" if faces else None).collect())
    assert got == plain(rows, max_age, min_hits, faces)


def test_no_rows(spark):
    df = spark.createDataFrame([], f"video_id long, frame long, ord long, box {BOX}")
    assert tk.tracked(df).count() == 0


def test_a_moving_box_keeps_its_track():
    t = tk.Tracks(1, max_age=3, min_hits=1)
    ids = [t.step(np.array([[10.0 + k, 10, 50 + k, 50]]), np.zeros(1, np.int64))[1].tolist() for k in range(6)]
    assert ids == [[0]] * 6
    t.skip(np.array([5]))
    assert len(t.ids) == len(t.x) == 0


def test_a_long_gap_moves_no_track_that_ends_in_it(monkeypatch):
    """Two sequences; only tracks that outlive their gap are moved on, frame by frame."""
    moved = []
    monkeypatch.setattr(tk.Tracks, "_advance", lambda self, some, f=tk.Tracks._advance: (moved.append(len(some)), f(self, some))[1])
    t = tk.Tracks(2, max_age=30, min_hits=1)
    t.step(np.array([[10.0, 10, 50, 50], [10, 10, 50, 50]]), np.array([0, 1]))
    moved.clear()
    t.skip(np.array([1000, 3]))
    assert moved == [1, 1, 1] and t.seq.tolist() == [1] and t.age.tolist() == [3] and t.frames.tolist() == [1001, 4]


def test_faces_and_boxes_weigh_the_same():
    """Two faces that swap their boxes: by overlap alone the tracks swap with them, by vectors they do not."""
    near, of = np.array([[0.0, 0, 40, 40], [8, 0, 48, 40]]), np.zeros(2, np.int64)
    faces = np.array([[1.0, 0], [0, 1]])
    boxes_only, both = tk.Tracks(1, 5, 1), tk.Tracks(1, 5, 1)
    for b, v in ((near, faces), (near, faces), (near[::-1], faces)):
        last = [dict(zip(*(x.tolist() for x in got), strict=True)) for got in (boxes_only.step(b, of), both.step(b, of, v))]
    assert last == [{0: 1, 1: 0}, {0: 0, 1: 1}]
    fresh = tk.Tracks(1, 5, 1)
    fresh.step(near, of, faces)
    cost = fresh.pairs(near, of, faces)[2].reshape(2, 2)
    assert math.isclose(cost[0, 0], 0.0, abs_tol=0.01) and math.isclose(cost[1, 0], 0.5 * (1 - 32 / 48) + 0.5, abs_tol=0.01)
