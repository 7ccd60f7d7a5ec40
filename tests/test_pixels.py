"""Clips read back frame by frame, and cuts on pixels against plain Python."""

import numpy as np
import pytest

from tidemark.sources import pixels as px


def clip(seed, n, shape=(6, 8)):
    rng = np.random.default_rng(seed)
    out, level = [], 0
    for _ in range(n):
        level = rng.integers(0, 200) if rng.random() < 0.12 else level
        out.append(np.clip(level + rng.integers(0, 8, shape), 0, 255).astype(np.uint8))
    return out


@pytest.fixture
def made(spark, tmp_path):
    films = {f"v{k}.y4m": clip(k, n) for k, n in ((1, 90), (2, 1), (3, 40), (4, 0))}
    for k, (name, f) in enumerate(films.items()):
        (tmp_path / name).write_bytes(px.y4m_bytes(f, 10, ("420", "mono", "444", "422")[k]) + (b"FRAME\nhalf" if k == 0 else b""))
    (tmp_path / "notes.txt").write_text("x")
    return films, px.read_clips(spark, str(tmp_path))


@pytest.mark.parametrize(("start", "end", "step"), [(0, None, 1), (3, 50, 4), (39, 41, 1), (500, None, 1)])
def test_frames(made, monkeypatch, start, end, step):
    monkeypatch.setattr(px, "RANGE", 7)
    films, clips = made
    got = {(r.name, r.frame): r for r in px.frames(clips, start, end, step).collect()}
    want = {(v, k): f[k] for v, f in films.items() for k in range(len(f))[start:end:step]}
    assert got.keys() == want.keys()
    for (v, k), f in want.items():
        r = got[v, k]
        assert (bytes(r.luma), r.time, r.width, r.height) == (f.tobytes(), k / 10, 8, 6)


def plain_cuts(diff, rule, least):
    out, last = [], 0
    for k in range(1, len(diff)):
        if rule(k) and k - last >= least:
            out.append(k)
            last = k
    return out


def test_scores_and_cuts(made, monkeypatch):
    monkeypatch.setattr(px, "RANGE", 16)
    films, clips = made
    scored = px.scores(clips)
    rows = {(r.name, r.frame): r for r in scored.collect()}
    content = {(r.name, r.frame) for r in px.content_cuts(scored, 20.0, 5).collect()}
    adaptive = {(r.name, r.frame) for r in px.adaptive_cuts(scored, 3.0, 5).collect()}
    want_content, want_adaptive = set(), set()
    for v, f in films.items():
        diff = [None, *(np.abs(a.astype(int) - b).mean() for a, b in zip(f[1:], f, strict=False))]
        for k in range(len(f)):
            assert rows[v, k].mean == pytest.approx(f[k].mean()) and sum(rows[v, k].hist) == 48 and rows[v, k].hist[int(f[k][0, 0]) // 16] > 0
            assert rows[v, k].diff is None if k == 0 else rows[v, k].diff == pytest.approx(diff[k])
        near = lambda k: 3 <= k < len(f) - 2 and diff[k] >= 15 and diff[k] / ((sum(diff[k - 2 : k + 3]) - diff[k]) / 4) >= 3.0  # noqa: B023, E731
        want_content |= {(v, k) for k in plain_cuts(diff, lambda k: diff[k] >= 20.0, 5)}  # noqa: B023
        want_adaptive |= {(v, k) for k in plain_cuts(diff, near, 5)}
    assert content == want_content and adaptive == want_adaptive and len(adaptive) > 3


def test_other_contents(spark):
    df = spark.createDataFrame([("a", None), ("b", b"RIFF....")], "name string, content binary")
    assert px.frames(df.where("name = 'a'")).count() == px.scores(df.where("name = 'a'")).count() == 0
    with pytest.raises(Exception, match="b: not a Y4M clip"):
        px.frames(df).collect()
    assert px.adaptive_cuts(px.scores(df.where("false"))).count() == 0
