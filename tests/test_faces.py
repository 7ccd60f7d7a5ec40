"""Attribute profiles, exact medians, lip histories, active speakers and progress against plain Python."""

import random
import statistics
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import faces as fc
from tidemark.plans import progress as pg


@pytest.mark.parametrize("bins", [2, 4096])
def test_exact_median(spark, monkeypatch, bins):
    monkeypatch.setattr(fc, "BINS", bins)
    rng = random.Random(bins)
    rows = [(k, v) for k in range(8) for v in ([rng.choice([1.0, 2.0, 1e9]) for _ in range(k * 5 + 1)] if k % 2 else [rng.random() * 10 ** rng.randrange(-6, 6) for _ in range(k * 20 + 2)])]
    rows += [(20, None), (21, -3.0), (21, None), (22, 0.5), (22, 0.5000000001)]
    got = {r.k: r.median for r in fc.exact_median(spark.createDataFrame(rows, "k long, v double"), ["k"], "v").collect()}
    want = defaultdict(list)
    for k, v in rows:
        if v is not None:
            want[k].append(v)
    assert got == {k: statistics.median(v) for k, v in want.items()}


def test_profiles(spark):
    rng = random.Random(2)
    rows = []
    for i in range(200):
        emotions = None if i % 17 == 0 else {e: rng.random() for e in rng.sample(["joy", "fear", "calm"], rng.randrange(4))}
        rows.append((rng.choice("AAAB"), float(rng.randrange(20, 60)), rng.choice(["f", "m", None]), rng.random(), emotions, {"x": rng.random(), "y": 0.5}))
    got = {r.who: r for r in fc.profiles(spark.createDataFrame(rows, "who string, age double, gender string, gender_confidence double, emotions map<string,double>, races map<string,double>"), ["who"]).collect()}
    for who in "AB":
        mine = [r for r in rows if r[0] == who]
        ages, n = [r[1] for r in mine], len(mine)
        assert (got[who].n, got[who].age_min, got[who].age_max, got[who].age_median) == (n, min(ages), max(ages), statistics.median(ages))
        assert got[who].age_mean == pytest.approx(np.mean(ages)) and got[who].age_std == pytest.approx(np.std(ages))
        genders = Counter(r[2] for r in mine if r[2])
        assert {g: v.frequency for g, v in got[who].genders.items()} == pytest.approx({g: c / n for g, c in genders.items()})
        assert got[who].dominant_gender == min(genders, key=lambda g: (-genders[g], g))
        scores = {e: [r[4][e] for r in mine if r[4] and e in r[4]] for e in ("joy", "fear", "calm")}
        for e, s in scores.items():
            assert tuple(got[who].emotions[e]) == pytest.approx((np.mean(s), max(s), sum(x > 0.1 for x in s) / n))
        assert got[who].dominant_emotion == max(scores, key=lambda e: np.mean(scores[e]))
        assert got[who].races["y"].mean == 0.5 and got[who].races["y"].frequency == 1.0


def plain_regular(x):
    if len(x) < 5:
        return False
    peaks, i, high = [], 1, np.mean(x) + 0.5 * np.std(x)
    while i < len(x) - 1:
        if x[i - 1] < x[i]:
            j = i + 1
            while j < len(x) - 1 and x[j] == x[i]:
                j += 1
            if x[j] < x[i]:
                if x[i] >= high:
                    peaks.append((i + j - 1) // 2)
                i = j
        i += 1
    gaps = np.diff(peaks)
    return bool(len(gaps) and np.std(gaps) / np.mean(gaps) < 0.5)


def test_regular_peaks():
    rng = np.random.default_rng(4)
    for width in (2, 5, 9, 15):
        x = rng.integers(0, 4, (400, width)) / 8
        assert fc.regular(x).tolist() == [plain_regular(r) for r in x]


def test_lip_decisions_and_active_speakers(spark):
    rng = random.Random(6)
    rows = []
    for c in "ABC":
        for f in range(60):
            if rng.random() < 0.8:
                rows.append((1, c, float(f), f, len(rows), round(0.15 + 0.1 * float(np.sin(f * (1 + ord(c) % 3))) * rng.random(), 3), rng.random() * 0.25))
    df = spark.createDataFrame(rows, "video_id long, character_id string, ts double, frame long, ord long, mar double, movement double")
    decisions = fc.lip_decisions(df)
    got = {r.ord: r for r in decisions.collect()}
    want = {}
    for c in "ABC":
        mine = [r for r in rows if r[1] == c]
        for k, r in enumerate(mine):
            h = mine[max(0, k - 14) : k + 1]
            mars, moves = [x[5] for x in h], [x[6] for x in h]
            score = 0.3 * (np.std(mars) > 0.02) + 0.2 * (np.mean(mars) > 0.15) + 0.3 * (np.mean(moves) > 0.1) + 0.2 * plain_regular(mars) if len(h) >= 3 else 0.0
            want[r[4]] = (round(float(score), 9), bool(score > 0.5), h[0][2])
    assert {o: (round(r.score, 9), r.speaking, r.since) for o, r in got.items()} == want
    best = {}
    for r in sorted(rows, key=lambda r: r[1]):
        score, speaking, since = want[r[4]]
        if speaking and score > best.get(r[3], (0,))[0]:
            best[r[3]] = (score, r[1], since, r[2])
    speakers = {r.frame: (round(r.score, 9), r.character_id, r.start, r.end) for r in fc.active_speakers(decisions).collect()}
    assert speakers == best and len(best) > 5


def test_batch_progress_rises(spark):
    told = []

    def slow(batches):
        for b in batches:
            time.sleep(0.3)
            yield b

    with pg.Progress(spark, lambda done, failed: told.append((done, failed)), 0.05) as p:
        rows = spark.range(0, 2000, 1, 16).mapInArrow(slow, "id long")
        assert p.watch(rows, F.col("id") % 100 == 0).count() == 2000
    assert p.total == (2000, 20)
    assert len(told) >= 3 and [t[0] for t in told] == sorted(t[0] for t in told) and told[0][0] < 2000


def test_stream_progress_rises(spark, tmp_path):
    told = []
    listener = pg.StreamProgress("faces", lambda done, failed: told.append((done, failed)))
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    spark.streams.addListener(listener)
    try:
        s = pg.observed(spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), "faces", F.col("id") < 5)
        q = s.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
        for _ in range(100):
            if told and told[-1][0] == 30:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert [t[0] for t in told] == [10, 20, 30] and told[-1] == (30, 5)
