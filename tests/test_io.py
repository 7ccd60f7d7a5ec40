"""Readers, sinks, configuration, pipeline, registry and streaming."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.plans import config, registry, stages
from tidemark.sources import media
from tidemark.sources import readers as rd
from tidemark.sources import sinks as sk
from tidemark.streaming import online


def test_documents(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"video_id": "v", "shots": [{"shot_id": 1, "start_time": 0, "end": 2.0}, {"id": 2, "start": 2.0, "end_time": 5}]}))
    got = rd.require(spark, f"{tmp_path}/s.json", "shots").orderBy("ord").collect()
    assert [(r.shot_id, r.start, r.end, r.duration) for r in got] == [(1, 0, 2, 2), (2, 2, 5, 3)]
    assert rd.read_or_empty(spark, f"{tmp_path}/none.json", "scenes").count() == 0
    with pytest.raises(FileNotFoundError):
        rd.require(spark, f"{tmp_path}/none.json", "a")
    (tmp_path / "bad.json").write_text("{nope")
    assert rd.read_document(spark, f"{tmp_path}/bad.json", "a").first()._corrupt_record is not None


def test_characters_map(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"video_id": "v", "characters": {"1": {"character_id": "1", "num_appearances": 3, "scene_appearances": {"2": 5}}}}))
    row = rd.characters_of(rd.read_document(spark, f"{tmp_path}/c.json", "c")).first()
    assert row.num_appearances == 3 and row.scene_appearances == {2: 5}


def test_sessions_and_listing(spark, tmp_path):
    for name in ("session_20240101_000000", "session_20240301_120000", "other"):
        (tmp_path / name).mkdir()
    (tmp_path / "a.srt").write_text("")
    assert rd.latest_session(spark, str(tmp_path)).endswith("session_20240301_120000")
    assert rd.listing(spark, str(tmp_path)) == ["a.srt"]
    assert rd.first_existing(spark, [f"{tmp_path}/no", f"{tmp_path}/a.srt"]).endswith("a.srt")


def test_keyframes(spark, tmp_path):
    for name in ("shot_0007.jpg", "x.jpg"):
        (tmp_path / name).write_bytes(b"1")
    assert [r.shot_id for r in rd.keyframes(spark, str(tmp_path)).collect()] == [7]


def test_fallback_scenes_end_empty_on_a_multiple(spark):
    got = rd.fallback_scenes(spark.createDataFrame([(1, 60.0)], "video_id long, duration double")).orderBy("scene_id").collect()
    assert [(r.start, r.end) for r in got] == [(0, 30), (30, 60), (60, 60)]


def test_writers(spark, tmp_path):
    caps = spark.createDataFrame([(1, 1, 0.0, 5.0, "Hi", ["A", "B", "C"], True), (1, 2, 5.0, 6.0, "<x>", [], True)], "video_id long, scene_id long, start double, end double, caption string, characters array<string>, has_dialogue boolean")
    assert sk.srt_file(caps).first().body == "1\n00:00:00,000 --> 00:00:05,000\n[A, B] Hi\n\n2\n00:00:05,000 --> 00:00:06,000\n<x>\n\n"
    assert "&lt;x&gt;" in sk.html_file(caps).first().body
    said = sk.write_all(caps, str(tmp_path), ["srt", "nope", "json"])
    assert said == {"srt": "written", "nope": "unknown", "json": "written"}


def test_failures_can_fail_the_job(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(sk.FORMATS, "bad", lambda c: c.select("no such column"))
    caps = spark.createDataFrame([(1, 1, 0.0, 5.0, "Hi", ["A"], True)], "video_id long, scene_id long, start double, end double, caption string, characters array<string>, has_dialogue boolean")
    said = sk.write_all(caps, str(tmp_path), ["bad", "json"])
    assert said["json"] == "written" and said["bad"].startswith("failed")
    with pytest.raises(RuntimeError):
        sk.raise_failures(said)


def test_headers_and_samples(spark, tmp_path):
    (tmp_path / "a.mp4").write_bytes(media.mp4_bytes(1280, 720, 100, 30, "hvc1"))
    (tmp_path / "b.mp4").write_bytes(media.mp4_bytes(1280, 720, 100, 30)[:-40])
    (tmp_path / "c.mp4").write_bytes(b"\0\0\0\x08ftyp")
    got = {r.path[-5]: r for r in media.videos(spark, str(tmp_path)).collect()}
    assert (got["a"].width, got["a"].height, got["a"].frame_count, got["a"].codec, got["a"].error) == (1280, 720, 100, "hvc1", None)
    assert round(got["a"].fps, 6) == 30 and round(got["a"].duration, 6) == round(100 / 30, 6)
    assert "cut" in got["b"].error and "no video track" in got["c"].error
    tone = np.sin(np.arange(4000) / 4000 * 2 * np.pi * 440) * 0.5
    assert np.allclose(media.wav_samples(media.wav_bytes(tone, 4000))[2], tone, atol=1e-3)
    assert len(media.resampled(tone, 4000, 16000)) == 16000 and media.pitch(tone, 4000) == pytest.approx(440, abs=2)
    assert media.bursts(np.concatenate([tone, np.zeros(2000), tone]), 4000) == [(0.0, 1.0), (1.5, 2.5)]
    (tmp_path / "d.wav").write_bytes(b"RIFF1234WAVEfmt ")
    assert media.audio(spark, str(tmp_path)).first().error is not None


def test_speech_models_fail_by_row(spark, tmp_path):
    def make():
        def model(samples, rate):
            raise OSError("no model")

        return model

    registry.TRANSCRIBERS["broken"] = make
    (tmp_path / "a.wav").write_bytes(media.wav_bytes(np.zeros(100), 8000))
    rows = registry.transcribed(media.audio(spark, str(tmp_path)), "broken").collect()
    assert len(rows) == 1 and rows[0].error == "OSError: no model" and rows[0].text is None
    assert registry.diarized(media.audio(spark, str(tmp_path))).count() == 0


def test_resume_reads_what_was_written(spark, tmp_path):
    first = stages.Pipeline({"video": lambda s, t: {"shots": s.range(3)}}, str(tmp_path))
    first.run(spark, {}, ["video"])
    again = stages.Pipeline({"video": lambda s, t: {"shots": s.range(9)}}, str(tmp_path))
    assert again.run(spark, {}, ["video"])[0]["shots"].count() == 3


def test_config(tmp_path, monkeypatch):
    monkeypatch.setenv("TM_X", "7")
    (tmp_path / "a.json").write_text('{"a": {"b": 1, "c": "${TM_X}"}, "profiles": {"p": {"overrides": {"a": {"b": 2}}}}}')
    c = config.Config.load(str(tmp_path / "a.json"), profile="p")
    assert (c.get("a.b"), c.get("a.c"), c.get("a.z", 9)) == (2, "7", 9)
    c.set("q.r", 1)
    assert c.get("q.r") == 1
    with pytest.raises(KeyError):
        config.Config.load(str(tmp_path / "a.json"), profile="none")


def test_commands(spark, tmp_path, capsys):
    from tidemark.__main__ import main

    assert main(["verify"]) == 0 and "pyspark: yes" in capsys.readouterr().out
    (tmp_path / "c.json").write_text('{"a": 1, "profiles": {"p": {"overrides": {"a": 2}}}}')
    assert main(["config", str(tmp_path / "c.json"), "--profile", "p"]) == 0 and '"a": 2' in capsys.readouterr().out
    assert main(["config"]) == 0 and '"dark"' in capsys.readouterr().out
    assert main(["download-models"]) == 0 and "caption: mock" in capsys.readouterr().out
    assert main(["list"]) == 0 and "src_video" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["no such query", "x"])


def test_pipeline(spark, tmp_path):
    def fails(spark, tables):
        raise ValueError("no")

    p = stages.Pipeline({"video": lambda s, t: {"shots": s.range(3)}, "audio": fails, "caption": lambda s, t: {"caps": t["shots"]}}, str(tmp_path))
    out, status = p.run(spark, {})
    assert status["video"] == status["caption"] == "ok" and status["audio"].startswith("failed: ValueError")
    assert out["caps"].count() == 3
    assert stages.Pipeline({"video": fails, "caption": fails}).run(spark, {}, ["video", "caption"])[1]["caption"] == "skipped"


def test_model_errors_are_rows(spark):
    registry.MODELS["broken"] = lambda: lambda p: 1 / 0
    got = registry.captioned(spark.createDataFrame([("x",)], "prompt string"), "broken").first()
    assert got.caption == "A scene." and "ZeroDivisionError" in got.error
    with pytest.raises(KeyError):
        registry.backend("none")


def _stream(spark, tmp_path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    return spark.readStream.schema(schema).parquet(f"{tmp_path}/in")


def _all(spark, df, tmp_path, mode):
    q = df.writeStream.format("memory").queryName("out").outputMode(mode).option("checkpointLocation", f"{tmp_path}/ck").start()
    q.processAllAvailable()
    q.stop()
    return spark.table("out").collect()


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    online.keep_state_in_rocksdb(spark)
    yield
    spark.conf.set(name, before)


def test_streamed_tracks(spark, tmp_path, rocksdb):
    rows = [(1, f, f * 2, 10.0 + f, 10.0, 50.0 + f, 50.0) for f in range(4)] + [(1, f, f * 2 + 1, 200.0, 200.0, 240.0, 240.0) for f in range(4)]
    s = _stream(spark, tmp_path, rows, "video_id long, frame long, ord long, x1 double, y1 double, x2 double, y2 double")
    got = _all(spark, online.tracks(s), tmp_path, "append")
    assert {(r.ord % 2, r.track_id) for r in got} == {(0, 0), (1, 1)}


def test_idle_state_goes_and_late_rows_are_dropped(spark, tmp_path, rocksdb):
    """Files one by one: a video that is idle past the watermark starts anew; a row behind the watermark is dropped and counted."""
    from datetime import datetime, timedelta

    t0 = datetime(2024, 1, 1)
    schema = "video_id long, frame long, ord long, ts timestamp, x1 double, y1 double, x2 double, y2 double"
    box = (10.0, 10.0, 50.0, 50.0)
    folder = f"{tmp_path}/in"
    spark.createDataFrame([], schema).write.parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    parts = [(1, 0, 0, 0), (1, 1, 1, 1), (2, 0, 2, 3600), (2, 1, 3, 3700), (1, 2, 4, 7300), (2, 2, 5, 60)]
    q = online.tracks(stream, at="ts", idle="10 minutes").writeStream.format("memory").queryName("idle").outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").start()
    try:
        for v, f, o, s in parts:
            spark.createDataFrame([(v, f, o, t0 + timedelta(seconds=s), *(box if o != 4 else (300.0, 300.0, 340.0, 340.0)))], schema).coalesce(1).write.mode("append").parquet(folder)
            q.processAllAvailable()
        late = online.dropped(q)
    finally:
        q.stop()
    got = {r.ord: r.track_id for r in spark.table("idle").collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0} and late == 1  # 4 is elsewhere: it would be track 1 if video 1 were not forgotten


def test_one_of_a_bucket_is_forgotten(spark, tmp_path, rocksdb):
    """The timer of a bucket drops the video that is idle, and the other goes on."""
    from datetime import datetime, timedelta

    t0, schema = datetime(2024, 1, 1), "video_id long, frame long, ord long, ts timestamp, x1 double, y1 double, x2 double, y2 double"
    for n, part in enumerate([[(1, 0, 0, 0), (2, 0, 1, 500)], [(2, 1, 2, 900)], [(1, 1, 3, 1000), (2, 2, 4, 1000)]]):
        rows = [(v, f, o, t0 + timedelta(seconds=s), *((10.0, 10.0, 50.0, 50.0) if n < 2 else (300.0, 300.0, 340.0, 340.0))) for v, f, o, s in part]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        s = online.tracks(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), at="ts", idle="10 minutes", buckets=1)
        s.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    got = {r.ord: r.track_id for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1}


def test_a_cut_resets_the_tracks(spark, tmp_path, rocksdb):
    rows = [(1, f, f, "cut" if f == 2 else "face", 10.0, 10.0, 50.0, 50.0) for f in range(4)]
    s = _stream(spark, tmp_path, rows, "video_id long, frame long, ord long, kind string, x1 double, y1 double, x2 double, y2 double")
    got = _all(spark, online.tracks(s, reset=("cut",)), tmp_path, "append")
    assert [r.track_id for r in sorted(got, key=lambda r: r.ord)] == [0, 0, 1, 1]


@pytest.mark.parametrize(("min_hits", "faces"), [(1, False), (3, True)])
def test_tracks_of_a_bucket_are_the_plain_ones(spark, tmp_path, rocksdb, monkeypatch, min_hits, faces):
    """Videos of one bucket with resets and long gaps, cut into deliveries anywhere, against a tracker a video; stale rows are not told."""
    from plain import Tracker
    from test_tracking import gappy

    rows = [(v, f, o, "cut" if f % 13 == 0 else "face", *box, face) for v, f, o, box, face in gappy(5, videos=5, frames=70, faces=faces)]
    schema = "video_id long, frame long, ord long, kind string, x1 double, y1 double, x2 double, y2 double, face array<double>"
    want = []
    for v in range(5):
        tracker, mine = Tracker(5, min_hits), [r for r in rows if r[0] == v]
        for frame in range(min(r[1] for r in mine), max(r[1] for r in mine) + 1):
            now = [r for r in mine if r[1] == frame]
            if any(r[3] == "cut" for r in now):
                for state in ("x", "p", "ids", "age", "streak", *(["vectors"] if tracker.vectors is not None else [])):
                    setattr(tracker, state, getattr(tracker, state)[:0])
            told = tracker.step(np.array([r[4:8] for r in now], float).reshape(-1, 4), np.array([r[8] for r in now], float).reshape(-1, 3) if faces else None)
            want += [(v, frame, now[j][2], i) for j, i in told]
    folder = f"{tmp_path}/in"
    for lo, hi in ((0, 60), (60, 61), (61, 10**6)):
        part = [r for r in rows if lo <= r[1] < hi] + [(2, 10, -1, "cut", 0.0, 0.0, 9.0, 9.0, [1.0, 0.0, 0.0])] * (lo == 61)
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        s = online.tracks(spark.readStream.schema(schema).parquet(folder), 5, min_hits, reset=("cut",), vector="face" if faces else None, buckets=1)
        s.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("video_id", "frame", "ord", "track_id").collect()))
    assert got == sorted(want) and len(got) > 100


@pytest.mark.parametrize("faces", [False, True])
def test_streamed_tracks_are_those_of_the_batch(spark, tmp_path, rocksdb, faces):
    """Row by row, with the video cut into batches anywhere between two frames."""
    from test_tracking import BOX, gappy
    from tidemark.operators import tracking as tk

    rows = gappy(11, videos=3, frames=60, faces=faces)
    df = spark.createDataFrame(rows, f"video_id long, frame long, ord long, box {BOX}, face array<double>")
    flat = df.select("video_id", "frame", "ord", "box.*", "face")
    folder = f"{tmp_path}/in"
    stream = lambda: spark.readStream.schema(flat.schema).parquet(folder)
    for lo, hi in ((0, 40), (40, 41), (41, 90), (90, 10**6)):
        flat.where(F.col("frame").between(lo, hi - 1)).write.mode("append").parquet(folder)
        q = online.tracks(stream(), 5, 2, vector="face" if faces else None).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("video_id", "frame", "ord", "track_id").collect()))
    assert got == sorted(map(tuple, tk.tracked(df, 5, 2, "face" if faces else None).collect())) and len(got) > 100


def test_window_state_goes_with_the_watermark(spark, tmp_path):
    """Windows are told once and leave the state; rows that come too late are dropped and counted."""
    from datetime import datetime, timedelta

    schema, t0 = "video_id long, value double, ts timestamp", datetime(2024, 1, 1)
    at = lambda m, v=1: (v, 1.0, t0 + timedelta(minutes=m))
    told, state, late, removed = {}, [], 0, 0
    for n, minutes in enumerate(([0, 1, 2, 10, 11], [20, 21, 3], [40, 41], [0, 60])):
        spark.createDataFrame([at(m) for m in minutes], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        s = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        q = online.coverage(s, width="5 minutes", late="1 minute").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
        batches = online.progress(q)
        state.append(batches[-1][2])
        late, removed = late + sum(b[4] for b in batches), removed + sum(b[3] for b in batches)
        told[n] = sorted((r.window.start.minute, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert told[0] == [(0, 3)] and told[1] == [(0, 3), (10, 2)] and told[3] == [(0, 3), (10, 2), (20, 2), (40, 2)]
    assert state == [1, 1, 1, 1] and late == 2 and removed == 4


def test_streamed_sessions(spark, tmp_path):
    schema = "video_id long, character_id string, ts timestamp"
    from datetime import datetime, timedelta

    t0 = datetime(2024, 1, 1)
    rows = [(1, "a", t0 + timedelta(seconds=s)) for s in (0, 1, 2, 10, 11)]
    got = _all(spark, online.appearances(_stream(spark, tmp_path, [*rows, (1, "b", t0 + timedelta(seconds=40))], schema)), tmp_path, "append")
    assert sorted((r.start.second, r.end.second, r.points) for r in got) == [(0, 2, 3), (10, 11, 2)]
    assert F is not None
