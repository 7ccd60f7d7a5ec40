"""Queries of sessions, files, audio, frames and streams that go through real folders."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vector as vc
from ..operators import frames as fr
from ..operators import intervals as iv
from ..operators import quality as ql
from ..operators import matching as ma
from ..operators import scoring as sc
from ..operators import sessions as se
from ..operators import tracking as tk
from ..sources import media
from ..sources import pixels as px
from ..sources import readers as rd
from ..sources import sinks as sk
from ..streaming import online
from . import mapping as mp
from . import registry
from .mapping import sql
from .queries import query
from .queries_io import ARRIVED, Streamed, shared_folder
from .queries_joins import dialogues

_V = ["video_id"]

# ---- sessions and listings -------------------------------------------------------------


def _sessions(spark: SparkSession, sf: str, documents: dict[str, DataFrame]) -> str:
    """A folder with a session for each region; the latest holds the documents."""
    root = shared_folder(spark)
    keys = sorted(r[0] for r in mp.table(spark, sf, "region").select("r_regionkey").collect())  # five regions
    for k in keys:
        sk.put(spark, f"{root}/session_{20240101 + k}_{k:06d}/note.json", b'{"video_id": "none"}')
    for kind, rows in documents.items():
        sk.write_document(rows, f"{root}/session_{20240101 + keys[-1]}_{keys[-1]:06d}/{kind}")
    return root


def _document(rows: DataFrame, name: str, entry, order: str) -> DataFrame:
    listed = F.transform(F.array_sort(F.collect_list(F.struct(order, entry.alias("e")))), lambda x: x["e"])
    return rows.groupBy(F.col("video_id").cast("string").alias("video_id")).agg(listed.alias(name))


def _latest(spark, sf):
    root = _sessions(spark, sf, {})
    found = rd.latest_session(spark, root)
    return spark.read.option("multiLine", True).schema("video_id string").json(found).select(F.lit(rd.session_name(found)).alias("session"), rd.session_stamp(F.lit(found)).alias("stamp"), "video_id")


query("src_latest_session", "SELECT 'session_' || (20240101 + max(r_regionkey)) || '_' || lpad(max(r_regionkey)::VARCHAR, 6, '0') AS session, (20240101 + max(r_regionkey)) || '_' || lpad(max(r_regionkey)::VARCHAR, 6, '0') AS stamp, 'none' AS video_id FROM region")(_latest)


def _fusion(spark, sf):
    a = _document(mp.segments(spark, sf), "segments", F.struct("segment_id", "text"), "ord")
    c = _document(mp.detections(spark, sf), "detections", F.struct(F.col("ts").alias("timestamp"), "character_id"), "ord")
    docs = rd.session_documents(spark, _sessions(spark, sf, {"a": a, "c": c}))
    said = docs["a"].groupBy("video_id").agg(F.count("*").alias("segments"))
    seen = docs["c"].groupBy("video_id", "character_id").agg(F.count("*").alias("detections"))
    absent = docs["b"].select("video_id").unionByName(docs["d"].select("video_id")).groupBy("video_id").agg(F.count("*").alias("others"))
    out = seen.join(said, "video_id", "left").join(absent, "video_id", "left")
    return out.select(F.col("video_id").cast("bigint").alias("video_id"), F.concat(F.lit("Character_"), "character_id").alias("name"), "detections", F.coalesce("segments", F.lit(0)).alias("segments"), F.coalesce("others", F.lit(0)).alias("others"))


query("src_fusion_docs", sql("SELECT d.video_id, 'Character_' || character_id AS name, count(*) AS detections, coalesce(any_value(s.n), 0) AS segments, 0::BIGINT AS others FROM det d LEFT JOIN (SELECT video_id, count(*) AS n FROM seg GROUP BY ALL) s USING (video_id) GROUP BY ALL", "seg", "det"))(_fusion)


def _packaged(spark, sf):
    root = shared_folder(spark)
    sk.write_document(_document(mp.shots(spark, sf), "shots", F.struct("id", F.col("start").alias("start_time"), "end"), "id"), f"{root}/shots")
    shots = rd.read_or_empty(spark, f"{root}/shots", "shots", lines=True).select(F.lit("shots").alias("k"))
    scenes = rd.read_or_empty(spark, f"{root}/scenes", "scenes", lines=True).select(F.lit("scenes").alias("k"))
    return shots.unionAll(scenes).agg(F.count_if(F.col("k") == "shots").alias("shots"), F.count_if(F.col("k") == "scenes").alias("scenes"))


query("src_packaged", sql("SELECT count(*) AS shots, 0::BIGINT AS scenes FROM shot", "shot"))(_packaged)


def _keyframes(spark, sf):
    root = shared_folder(spark)
    for k in sorted(r[0] for r in mp.table(spark, sf, "region").select("r_regionkey").collect()):  # five regions
        sk.put(spark, f"{root}/shot_{7 * k:04d}.jpg", b"x" * (3 + k))
        sk.put(spark, f"{root}/cover{k}.jpg", b"x")
    return rd.keyframes(spark, root).select("shot_id", F.regexp_extract("path", "[^/]+$", 0).alias("name"), "length")


query("src_keyframes", "SELECT (7 * r_regionkey)::INTEGER AS shot_id, printf('shot_%04d.jpg', 7 * r_regionkey) AS name, (3 + r_regionkey)::BIGINT AS length FROM region")(_keyframes)


def _listing(spark, sf):
    root = shared_folder(spark)
    for k in sorted(r[0] for r in mp.table(spark, sf, "region").select("r_regionkey").collect()):  # five regions
        sk.put(spark, f"{root}/r{k}.{('json', 'srt', 'vtt', 'html', 'txt')[k % 5]}", b"{}")
    return spark.createDataFrame([(n,) for n in rd.listing(spark, root)], "name string")


query("snk_listing", "SELECT 'r' || r_regionkey || '.' || ['json', 'srt', 'vtt', 'html', 'txt'][(r_regionkey % 5 + 1)::INT] AS name FROM region WHERE r_regionkey % 5 <> 4")(_listing)
query("snk_http", "SELECT string_agg('<li><a href=\"r' || r_regionkey || '.html\">r' || r_regionkey || '.html</a></li>', chr(10) ORDER BY r_regionkey) AS items FROM region")(lambda s, d: _served(s, d))


def _served(spark, sf):
    """What a client of the result server is told."""
    import tempfile
    import threading
    import urllib.request
    from pathlib import Path

    names = [f"r{r[0]}.html" for r in mp.table(spark, sf, "region").select("r_regionkey").collect()]  # five regions
    with tempfile.TemporaryDirectory() as folder:  # the server's own pages, on the driver only
        for n in names:
            Path(folder, n).write_text("<p>")
        server = sk.serve(folder)
        thread = threading.Thread(target=server.serve_forever, daemon=True)
        thread.start()
        try:
            with urllib.request.urlopen(f"http://127.0.0.1:{server.server_address[1]}/") as reply:
                page = reply.read().decode()
        finally:
            server.shutdown()
            server.server_close()
    return spark.createDataFrame([("\n".join(x for x in page.splitlines() if x.startswith("<li>")),)], "items string")


query("snk_transcode", "SELECT r_regionkey AS k, 'ffmpeg -y -i in.avi -vf scale=' || (((640 + 7 * r_regionkey) * 720 // 480) // 2 * 2) || ':720 -c:v libx264 -crf 23 -c:a aac out.mp4' AS command FROM region")(
    lambda s, d: s.createDataFrame([(r[0], " ".join(sk.transcode_command("in.avi", "out.mp4", 640 + 7 * r[0], 480, 720))) for r in mp.table(s, d, "region").select("r_regionkey").collect()], mp.table(s, d, "region").select(F.col("r_regionkey").alias("k"), F.lit("").alias("command")).schema)  # five regions
)

# ---- containers, speech and speakers ---------------------------------------------------


def _clips(spark, sf) -> str:
    """Per region k: a video of 50 + k frames and a sound file of k + 1 tones, half a second each, high and low in turn."""
    import numpy as np

    root = shared_folder(spark)
    for k in sorted(r[0] for r in mp.table(spark, sf, "region").select("r_regionkey").collect()):  # five regions
        sk.put(spark, f"{root}/r{k}.mp4", media.mp4_bytes(640 + k, 480, 50 + k, 25))
        t = np.arange(8000 * (k + 1)) / 8000
        sound = np.where(t % 1 < 0.5, 0.5 * np.sin(2 * np.pi * np.where(t % 2 < 1, 800, 300) * t), 0.0)
        sk.put(spark, f"{root}/r{k}.wav", media.wav_bytes(sound, 8000))
    sk.put(spark, f"{root}/bad.mp4", b"\0\0\0\x20moovcut")
    sk.put(spark, f"{root}/bad.wav", b"RIFFnone")
    return root




def _key():
    return F.regexp_extract("path", r"r(\d+)\.\w+$", 1).try_cast("bigint").alias("k")


def _span():
    return F.round("start", 1).alias("start"), F.round("end", 1).alias("end")


query("src_video", "SELECT r_regionkey::BIGINT AS k, 25.0::DOUBLE AS fps, (640 + r_regionkey)::INTEGER AS width, 480::INTEGER AS height, (50 + r_regionkey)::BIGINT AS frame_count, (50 + r_regionkey) / 25.0::DOUBLE AS duration, 'avc1' AS codec, false AS failed FROM region UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, true")(
    lambda s, d: media.videos(s, _clips(s, d)).select(_key(), F.round("fps", 9).alias("fps"), "width", "height", "frame_count", "duration", "codec", F.col("error").isNotNull().alias("failed"))
)
query("src_audio", "SELECT r_regionkey::BIGINT AS k, 16000::INTEGER AS rate, (r_regionkey + 1)::DOUBLE AS duration, (16000 * (r_regionkey + 1))::INTEGER AS n, false AS failed FROM region UNION ALL SELECT NULL, NULL, NULL, NULL, true")(
    lambda s, d: media.audio(s, _clips(s, d)).select(_key(), "rate", "duration", F.when(F.col("samples").isNotNull(), F.size("samples")).alias("n"), F.col("error").isNotNull().alias("failed"))
)
_TONES = "FROM (SELECT r_regionkey AS r, unnest(range(0, r_regionkey + 1)) AS j FROM region)"
_FAILED = " UNION ALL SELECT NULL, NULL, NULL, NULL, {}true"
query("src_asr", f"SELECT r::BIGINT AS k, printf('SEG_%04d', j) AS segment_id, j::DOUBLE AS start, j + 0.5::DOUBLE AS \"end\", (r + 0.5)::DOUBLE AS duration, false AS failed {_TONES}" + _FAILED.format("NULL, "))(
    lambda s, d: registry.transcribed(media.audio(s, _clips(s, d))).select(_key(), "segment_id", *_span(), F.round("duration", 1).alias("duration"), F.col("error").isNotNull().alias("failed"))
)
query("src_asr_file", f"SELECT r::BIGINT AS k, printf('SEG_%04d', j) AS segment_id, '0.5 seconds of sound' AS text, (r + 1)::DOUBLE AS duration, false AS failed {_TONES}" + _FAILED.format(""))(
    lambda s, d: registry.transcribed(media.audio(s, _clips(s, d)), whole=True).select(_key(), "segment_id", "text", F.round("duration", 1).alias("duration"), F.col("error").isNotNull().alias("failed"))
)
query("src_diar", f"SELECT r::BIGINT AS k, j::DOUBLE AS start, j + 0.5::DOUBLE AS \"end\", printf('SPEAKER_%02d', j % 2) AS speaker_id, false AS failed {_TONES}" + _FAILED.format(""))(lambda s, d: registry.diarized(media.audio(s, _clips(s, d))).select(_key(), *_span(), "speaker_id", F.col("error").isNotNull().alias("failed")))
query("src_diar_video", f"SELECT r::BIGINT AS k, count(*) AS turns, count(DISTINCT j % 2) AS speakers, ((50 + r) / 25.0)::DOUBLE AS duration {_TONES} GROUP BY ALL")(lambda s, d: _diarized_videos(s, d))


def _diarized_videos(spark, sf):
    """Turns from the sound beside each video, with the container's duration."""
    root = _clips(spark, sf)
    turns = registry.diarized(media.audio(spark, root), "pitch").where("error is null").groupBy(_key()).agg(F.count("*").alias("turns"), F.count_distinct("speaker_id").alias("speakers"))
    return turns.join(media.videos(spark, root).where("error is null").select(_key(), "duration"), "k")


# ---- frames ----------------------------------------------------------------------------

_HASH = "left(md5(array_to_string(list_transform(e, lambda x: CASE WHEN x > list_reduce(list_prepend(0.0::DOUBLE, e), lambda s, y: s + y) / len(e) THEN '1' ELSE '0' END), '')), 16)"
query("set_frame_dedup", f"SELECT label::BIGINT AS label, min_by(vec_id, vec_id) AS vec_id, hash FROM (SELECT vec_id, label, {_HASH} AS hash, row_number() OVER (PARTITION BY {_HASH} ORDER BY vec_id) AS k FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)) WHERE k = 1 GROUP BY ALL")(
    lambda s, d: fr.first_of_hash(mp.table(s, d, "embeddings"), "embedding", "vec_id").select(F.col("label").cast("bigint").alias("label"), "vec_id", "hash")
)
_NUM = "q AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ord) - 1 AS i, count(*) OVER (PARTITION BY video_id) AS n, decis // 100 AS hash FROM det)"
query("win_samplers", sql(_NUM + """, b AS (SELECT *, row_number() OVER (PARTITION BY video_id, hash ORDER BY ord) AS h FROM q WHERE i % greatest(1, n // 30) = 0),
g AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY confidence DESC, ord) AS r FROM b WHERE h = 1), c AS (SELECT *, abs(confidence - lag(confidence) OVER (PARTITION BY video_id ORDER BY ord)) AS d FROM q WHERE i % 2 = 0)
SELECT 'uniform' AS sampler, video_id, ord FROM q WHERE i % greatest(1, n // 10) = 0 UNION ALL SELECT 'best', video_id, ord FROM g WHERE r <= 10 UNION ALL SELECT 'changes', video_id, ord FROM c WHERE d > 0.25""", "det"))(lambda s, d: _samplers(s, d))  # fmt: skip


def _samplers(spark, sf):
    f = mp.detections(spark, sf).withColumn("hash", F.floor(F.col("decis") / 100))
    made = {"uniform": fr.uniform(f, _V, 10, "ord"), "best": fr.best_sampled(f, _V, 10, "confidence", "hash", "ord"), "changes": fr.at_changes(f, _V, 10.0, "confidence", 0.25, "ord")}
    parts = [rows.select(F.lit(name).alias("sampler"), "video_id", "ord") for name, rows in made.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


query("win_budget", sql("""b AS (SELECT *, count(*) FILTER (ord % 3 = 0) OVER (PARTITION BY video_id) AS d, count(*) OVER w AS m, row_number() OVER (w ORDER BY ord) - 1 AS i FROM det WINDOW w AS (PARTITION BY video_id, ord % 3 = 0)),
c AS (SELECT *, CASE WHEN ord % 3 = 0 THEN 12 ELSE 12 - d END AS room FROM b), e AS (SELECT *, CASE WHEN room > 0 THEN greatest(1, m // room) ELSE 1 END AS step FROM c)
SELECT video_id, ord FROM e WHERE (ord % 3 = 0 AND d <= 12) OR (room > 0 AND i % step = 0 AND i // step < room)""", "det"))(lambda s, d: fr.budgeted(mp.detections(s, d), _V, F.col("ord") % 3 == 0, 12, "ord").select("video_id", "ord"))  # fmt: skip
query("win_gap_trigger", sql("""h AS (SELECT s.video_id, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM det d WHERE d.video_id = s.video_id AND d.ts BETWEEN s.start AND s."end")) AS said FROM seg s GROUP BY ALL),
c AS (SELECT video_id, count(DISTINCT character_id) AS who FROM det GROUP BY ALL)
SELECT h.video_id, coalesce(who, 0) AS who, round(said / n, 6) AS coverage FROM h LEFT JOIN c USING (video_id) WHERE coalesce(who, 0) < 2 OR said / n < 0.7""", "seg", "det"))(lambda s, d: _gap_trigger(s, d))  # fmt: skip


def _gap_trigger(spark, sf):
    """Videos whose gaps are to be filled: under two characters, or under 70 % of the dialogues seen."""
    seg = dialogues(spark, sf)
    seen = iv.interval_join(seg.select("video_id", "segment_id", "start", "end"), mp.detections(spark, sf).select("video_id", "ts"), _V, ("start", "end"), ("ts", "ts"), 60.0).groupBy("video_id", "segment_id").agg(F.lit(1).alias("hit"))
    share = seg.join(seen, ["video_id", "segment_id"], "left").groupBy("video_id").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("coverage"))
    who = mp.detections(spark, sf).groupBy("video_id").agg(F.count_distinct("character_id").alias("who"))
    return share.join(who, "video_id", "left").select("video_id", F.coalesce("who", F.lit(0)).alias("who"), F.round("coverage", 6).alias("coverage"), F.col("coverage").alias("c")).where("who < 2 or c < 0.7").drop("c")


query("prj_enhance")(lambda s, d: _enhanced(s, d))


def _enhanced(spark, sf):
    """Embeddings as 8 x 8 grey images, cleaned up and four times as wide."""
    grey = F.transform("embedding", lambda x: F.least(F.lit(255.0), F.greatest(F.lit(0.0), x.cast("double") * 400 + 128)))
    got = mp.table(spark, sf, "embeddings").select("vec_id", fr.enhanced_pixels(8, least=32)(grey).alias("m"))
    return got.select("vec_id", "m.width", F.size("m.pixels").alias("n"), F.round(F.aggregate("m.pixels", F.lit(0.0), lambda s, x: s + x), 3).alias("light"), "m.error")


# ---- faces, lips and speakers ----------------------------------------------------------


def _points(n: int):
    """Landmarks (x, y) out of neighbouring components."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(F.get("embedding", i % 64).cast("double").alias("x"), F.get("embedding", (i + 1) % 64).cast("double").alias("y")))


def _gap_sql(i: int, j: int) -> str:
    a, b, c, e = (k % 64 + 1 for k in (i, j, i + 1, j + 1))
    return f"sqrt((e[{a}] - e[{b}]) * (e[{a}] - e[{b}]) + (e[{c}] - e[{e}]) * (e[{c}] - e[{e}]))"


_MAR = f"({_gap_sql(61, 67)} + {_gap_sql(62, 66)} + {_gap_sql(63, 65)}) / ({_gap_sql(60, 64)} * 3)"
_EMB = "(SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)"
query("sc_mar", f"SELECT vec_id, round({_MAR}, 6) AS v FROM {_EMB}")(lambda s, d: mp.table(s, d, "embeddings").select("vec_id", F.round(vc.mouth_ratio(_points(68)), 6).alias("v")))


def _landmarks():
    """68 points, five or none, by the row's label."""
    return F.when(F.col("label") % 3 == 0, _points(68)).when(F.col("label") % 3 == 1, _points(5))


query("prj_lip_rows", f"SELECT vec_id, CASE WHEN label % 3 = 0 THEN round({_MAR}, 6) ELSE 0.15 END::DOUBLE AS mar FROM {_EMB} WHERE label % 3 <> 2")(lambda s, d: mp.table(s, d, "embeddings").withColumn("landmarks", _landmarks()).where("landmarks is not null").select("vec_id", F.round(vc.mouth_ratio(F.col("landmarks")), 6).alias("mar")))
query("sc_lip_dispatch", f"SELECT vec_id, CASE label % 3 WHEN 0 THEN round({_MAR}, 6) WHEN 1 THEN 0.15 ELSE 0 END::DOUBLE AS v FROM {_EMB}")(lambda s, d: mp.table(s, d, "embeddings").select("vec_id", F.round(vc.mouth_ratio(F.coalesce(_landmarks(), F.slice(_points(5), 1, 0))), 6).alias("v")))
query("sc_lip", sql("""p AS (SELECT s.video_id, s.segment_id, d.character_id, max(d.confidence) FILTER (d.ts BETWEEN s.start AND s."end") AS c, count(*) FILTER (d.ts BETWEEN s.start AND s."end") AS moves
  FROM seg s JOIN det d ON d.video_id = s.video_id AND d.ts BETWEEN greatest(0, s.start - 30) AND s."end" + 30 GROUP BY ALL)
SELECT video_id, segment_id, character_id, round(CASE WHEN character_id IN ('C0', 'C1') THEN 0.1 WHEN moves = 0 THEN 0 WHEN c > 0.3 THEN 0.9 * c ELSE 0.05 END, 6)::DOUBLE AS v FROM p""", "seg", "det"))(lambda s, d: _lips(s, d))  # fmt: skip


def _lips(spark, sf):
    """Lip data of all characters but two: a movement's confidence, and speech where the best is over 0.3."""
    seg = dialogues(spark, sf).select("video_id", "segment_id", "start", "end", F.greatest(F.lit(0.0), F.col("start") - sc.WINDOW).alias("w0"), (F.col("end") + sc.WINDOW).alias("w1"))
    near = iv.interval_join(seg, mp.detections(spark, sf).select("video_id", "character_id", "ts", "confidence"), _V, ("w0", "w1"), ("ts", "ts"), 60.0)
    inside = F.col("ts").between(F.col("start"), F.col("end"))
    p = near.groupBy("video_id", "segment_id", "character_id").agg(F.max(F.when(inside, F.col("confidence"))).alias("c"), F.count_if(inside).alias("moves"))
    return p.select("video_id", "segment_id", "character_id", F.round(sc.lip_evidence(F.lit(True), ~F.col("character_id").isin("C0", "C1"), F.col("moves"), F.col("c") > 0.3, F.col("c")), 6).alias("v"))


query("sc_speaker_lookup", sql("""a AS (SELECT speaker, 'C' || (ord % 5) AS character_id, avg(confidence) AS v FROM seg WHERE ord % 5 <> 3 GROUP BY ALL)
SELECT s.video_id, s.ord, round(coalesce(a.v, 0), 6)::DOUBLE AS v FROM seg s LEFT JOIN a ON a.speaker = s.speaker AND a.character_id = 'C' || (s.ord % 5)""", "seg"))(lambda s, d: _associations(s, d))  # fmt: skip


def _associations(spark, sf):
    """What a speaker's association with a character is, 0 where there is none."""
    seg = mp.segments(spark, sf).withColumn("character_id", F.concat(F.lit("C"), (F.col("ord") % 5).cast("string")))
    known = seg.where("ord % 5 <> 3").groupBy("speaker", "character_id").agg(F.avg("confidence").alias("v"))
    return seg.join(known, ["speaker", "character_id"], "left").select("video_id", "ord", F.round(F.coalesce("v", F.lit(0.0)), 6).alias("v"))


query("udf_progress", sql("""o AS (SELECT *, decis // 40 AS frame, row_number() OVER (PARTITION BY video_id ORDER BY ord) - 1 AS i, count(*) OVER (PARTITION BY video_id) AS n FROM det), p AS (SELECT *, row_number() OVER (PARTITION BY video_id, frame ORDER BY ord) AS k FROM o WHERE i % 10 = 0)
SELECT video_id, ord, frame, round(100.0 * (i + 1) / n, 6)::DOUBLE AS progress FROM p WHERE k = 1""", "det"))(lambda s, d: _progress(s, d))  # fmt: skip


def _progress(spark, sf):
    """Every tenth detection by place, the first of each frame, and how far each is."""
    rows = fr.numbered(mp.detections(spark, sf).withColumn("frame", F.floor(F.col("decis") / 40)), _V, "ord").where("i % 10 = 0")
    return iv.first_by(rows, ["video_id", "frame"], "ord").select("video_id", "ord", "frame", F.round(100.0 * (F.col("i") + 1) / F.col("n"), 6).alias("progress"))


def _attributes(spark, sf):
    """The faces' model calls: padded boxes as prompts, a stand-in model that fails on faint ones."""

    def make():
        def model(prompt: str) -> str:
            faint, box = prompt.split("|")
            if faint == "true":
                raise ValueError("too faint")
            return f"a face in {box}"

        return model

    registry.MODELS["faces"] = make
    a, b = F.greatest(F.lit(0.0), F.col("box.x1") - 10), F.least(F.lit(640.0), F.col("box.x2") + 10)
    rows = mp.detections(spark, sf).select("ord", a.alias("a"), b.alias("b"), F.concat((F.col("confidence") < 0.01).cast("string"), F.lit("|"), a.cast("int").cast("string"), F.lit("-"), b.cast("int").cast("string")).alias("prompt"))
    return registry.captioned(rows, "faces", "unknown").select("ord", "a", "b", "caption", F.regexp_extract("error", r"^\w+", 0).alias("error"))


query("udf_face", sql("SELECT ord, greatest(0, x1 - 10) AS a, least(640, x2 + 10) AS b, CASE WHEN confidence < 0.01 THEN 'unknown' ELSE 'a face in ' || trunc(greatest(0, x1 - 10))::INTEGER || '-' || trunc(least(640, x2 + 10))::INTEGER END AS caption, CASE WHEN confidence < 0.01 THEN 'ValueError' END AS error FROM det", "det"))(_attributes)


def _refined(spark, sf):
    """One scene of each video is described again from its middle frame."""
    scenes = mp.scenes(spark, sf).where("id = 1").withColumn("at", ql.keyframe_time(F.col("start"), F.col("end"), F.lit("middle")))
    rows = scenes.select("video_id", "id", F.concat(F.lit("Characters: Frame "), F.col("at").cast("string")).alias("prompt"))
    return registry.captioned(rows).select("video_id", "id", F.col("caption").alias("summary"))


query("udf_refine", sql("SELECT video_id, id, 'Frame ' || ((start + \"end\") / 2)::DOUBLE || ' in a scene described from 3 words.' AS summary FROM scene WHERE id = 1", "scene"))(_refined)


def _extracted(spark, sf):
    """One keyframe a shot by a reader that fails on every fifth."""

    def make():
        def reader(prompt: str) -> str:
            n = int(prompt)
            if n % 5 == 0:
                raise OSError("no frame")
            return f"shot_{n:04d}.jpg"

        return reader

    registry.MODELS["frames"] = make
    rows = mp.shots(spark, sf).select("video_id", "id", F.col("id").cast("string").alias("prompt"))
    got = rows.withColumn("m", registry.model_column("frames", 1, 0)(F.col("prompt")))
    return got.select("video_id", "id", F.col("m.text").alias("path"), F.col("m.error").alias("error"))


query("src_keyframe_extract", sql("SELECT video_id, id, CASE WHEN id % 5 = 0 THEN NULL ELSE printf('shot_%04d.jpg', id) END AS path, CASE WHEN id % 5 = 0 THEN 'OSError: no frame' END AS error FROM shot", "shot"))(_extracted)

# ---- pixels ----------------------------------------------------------------------------

CLIP = 100  # frames of a clip


def _films(spark, sf) -> DataFrame:
    """A Y4M clip of each video, written to the shared folder and read back: frames as light as the events so far in their quarter make them, the lower half inverted."""
    levels = mp.detections(spark, sf).groupBy("video_id", F.floor(F.col("decis") / 40).alias("frame")).agg(F.sum("ord").alias("s"))

    def clip(pdf: pd.DataFrame) -> pd.DataFrame:
        level = np.zeros(CLIP, np.int64)
        level[pdf["frame"].to_numpy()] = pdf["s"].to_numpy() * 37 % 256
        held = np.maximum.accumulate(np.where(np.arange(CLIP) % 4 == 0, np.arange(CLIP), 0))  # a level lasts four frames
        films = [np.concatenate([np.full((3, 8), v), np.full((3, 8), 255 - v)]) for v in level[held]]
        return pd.DataFrame({"name": [str(pdf["video_id"].iloc[0])], "content": [px.y4m_bytes(films)]})

    path = shared_folder(spark)
    levels.groupBy("video_id").applyInPandas(clip, "name string, content binary").write.parquet(path)
    return spark.read.parquet(path)


_LEVELS = f"""l AS (SELECT video_id, decis // 40 AS k, sum(ord)::BIGINT * 37 % 256 AS v FROM det GROUP BY ALL), n AS (SELECT DISTINCT video_id FROM det),
f AS (SELECT n.video_id, k.k, coalesce(l.v, 0) AS v FROM n CROSS JOIN range({CLIP}) k(k) LEFT JOIN l ON l.video_id = n.video_id AND l.k = k.k // 4 * 4)"""
query("src_pixel_frames", sql(_LEVELS + f" SELECT video_id, k AS frame, v AS first, 255 - v AS last FROM f WHERE k >= 10 AND k < {CLIP - 10} AND (k - 10) % 3 = 0", "det"))(
    lambda s, d: px.frames(_films(s, d), 10, CLIP - 10, 3).select(F.col("name").cast("long").alias("video_id"), "frame", F.conv(F.hex(F.substring("luma", 1, 1)), 16, 10).cast("long").alias("first"), F.conv(F.hex(F.substring("luma", 48, 1)), 16, 10).cast("long").alias("last"))
)
_DIFFS = _LEVELS + """, d AS (SELECT video_id, k, abs(v - lag(v) OVER (PARTITION BY video_id ORDER BY k))::DOUBLE AS diff FROM f),
a AS (SELECT *, count(diff) OVER w AS n, (sum(diff) OVER w - diff) / 4 AS around FROM d WINDOW w AS (PARTITION BY video_id ORDER BY k ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
c AS (SELECT video_id, k FROM a WHERE n = 5 AND diff >= 15 AND (around <= 1e-5 OR diff / around >= 3)), o AS (SELECT video_id, list([k] ORDER BY k) AS l FROM (SELECT * FROM c UNION ALL SELECT DISTINCT video_id, 0 FROM d) GROUP BY video_id)
"""
query("src_pixel_cuts", sql(_DIFFS + "SELECT video_id, frame FROM (SELECT video_id, unnest(list_reduce(l, lambda x, y: CASE WHEN y[1] - x[len(x)] >= 15 THEN list_concat(x, y) ELSE x END)) AS frame FROM o) WHERE frame > 0", "det"))(
    lambda s, d: px.adaptive_cuts(px.scores(_films(s, d))).select(F.col("name").cast("long").alias("video_id"), "frame")
)
query("src_pixel_scores", sql(_LEVELS + " SELECT video_id, k AS frame, abs(v - lag(v) OVER (PARTITION BY video_id ORDER BY k))::DOUBLE AS diff, 127.5::DOUBLE AS mean FROM f", "det"))(
    lambda s, d: px.scores(_films(s, d)).select(F.col("name").cast("long").alias("video_id"), "frame", "diff", "mean")
)

# ---- tracking and matching -------------------------------------------------------------


def _vector():
    """A face vector of four components by character."""
    k = F.substring("character_id", 2, 1).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.cos(k * 1.3 + i * 0.7))


query("jn_assign")(lambda s, d: tk.tracked(mp.detections(s, d).select("video_id", F.floor(F.col("decis") / 40).alias("frame"), "ord", "box", _vector().alias("face")), 5, 1, "face"))
_POS = "1 - least(1, 2 * sqrt(pow((x1 + x2) / 2 / 640 - 0.5, 2) + pow((y1 + y2) / 2 / 480 - 0.5, 2)))"
query("sc_comprehensive", sql(f"""t AS (SELECT ord, confidence AS a, CASE WHEN ord % 2 = 0 THEN confidence / 2 ELSE 0 END AS s, {_POS} AS p, CASE WHEN ord % 3 = 0 THEN NULL WHEN emotion IN ('angry', 'fear') THEN 1 - ({_POS}) WHEN emotion IN ('happy', 'surprise') THEN {_POS} ELSE 0.5 END AS e FROM det)
SELECT ord, round((0.3 * a + 0.3 * s + 0.1 * 0.5 + 0.1 * p + 0.1 * coalesce(e, 0)) / (0.5 + CASE WHEN s > 0 THEN 0.3 ELSE 0 END + CASE WHEN e IS NULL THEN 0 ELSE 0.1 END), 10) AS v FROM t""", "det"))(lambda s, d: _comprehensive(s, d))  # fmt: skip


def _comprehensive(spark, sf):
    place = sc.position(F.col("box"))
    felt = F.when(F.col("ord") % 3 != 0, sc.emotion_position(F.col("emotion"), place))
    speaker = F.when(F.col("ord") % 2 == 0, F.col("confidence") / 2).otherwise(0.0)
    return mp.detections(spark, sf).select("ord", F.round(sc.comprehensive(F.col("confidence"), speaker, F.lit(0.5), place, felt), 10).alias("v"))


def _candidates(spark, sf):
    """Each dialogue with the characters that appear within its video's window, their mean place and how its emotion goes with that."""
    seen = se.islands(mp.detections(spark, sf), ["video_id", "character_id"], "ts", 2.0, "ord").select("video_id", "character_id", F.col("start").alias("t0"), F.col("end").alias("t1"))
    said = mp.segments(spark, sf).select("video_id", "segment_id", "ord", "start", "end", "emotion", F.col("speaker").alias("speaker_id"))
    near = ma.candidates(said, seen, ma.contexts(said, seen, mp.videos(spark, sf)))
    mean = [F.avg(f"box.{k}").alias(k) for k in ("x1", "y1", "x2", "y2")]
    place = mp.detections(spark, sf).groupBy("video_id", "character_id").agg(*mean).select("video_id", "character_id", sc.position(F.struct("x1", "y1", "x2", "y2")).alias("position"))
    return near.join(place, ["video_id", "character_id"], "left").withColumn("emotion_score", sc.emotion_position(F.col("emotion"), F.col("position")))


query("win_match_adv")(lambda s, d: ma.match_chain(_candidates(s, d)))
query("win_match_context", sql("""a AS (SELECT video_id, count(DISTINCT character_id) AS seen FROM det GROUP BY video_id),
c AS (SELECT vid.video_id, duration, coalesce(seen, 0) / (duration / 60) AS cd, segments / (duration / 60) AS dd FROM vid LEFT JOIN a USING (video_id))
SELECT video_id, CASE WHEN dd > 20 THEN 10 WHEN dd < 5 THEN 60 ELSE 30 END::DOUBLE AS window, round(0.3::DOUBLE * CASE WHEN cd < 1 THEN 0.9 WHEN cd > 10 THEN 1.2 ELSE 1.0 END, 6) AS least, CASE WHEN duration > 600 THEN 0.3 ELSE 0.1 END::DOUBLE AS continuity_weight FROM c""", "vid", "det"))(
    lambda s, d: ma.contexts(mp.segments(s, d), mp.detections(s, d), mp.videos(s, d)).withColumn("least", F.round("least", 6))
)
_PAST = """p AS (SELECT video_id, ord, start, speaker, list({e: "end", w: speaker}) OVER (PARTITION BY video_id ORDER BY ord ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS l FROM seg),
m AS (SELECT *, list_filter(l, lambda x: x.w = speaker) AS mine, start - list_filter(l, lambda x: x.w = speaker)[-1].e AS since FROM p)
"""
query("win_continuity", sql(_PAST + "SELECT video_id, ord, round(CASE WHEN coalesce(len(l), 0) = 0 THEN 0.5 WHEN since < 5 THEN 0.9 WHEN since < 30 THEN 0.7 ELSE 0.5 + 0.3 * len(mine) / len(l) END, 6) AS continuity FROM m", "seg"))(
    lambda s, d: ma.history_scores(mp.segments(s, d).withColumn("character_id", F.col("speaker"))).select("video_id", "ord", F.round("continuity", 6).alias("continuity"))
)
_LEARNED = """s AS (SELECT video_id, ord, segment_id, speaker AS speaker_id, confidence AS score, 'C' || (ord % 3)::VARCHAR AS character_id FROM seg),
a AS (SELECT video_id, speaker_id, character_id, list_reduce(list(score ORDER BY ord), lambda x, y: (x + y) / 2) AS strength FROM s WHERE score > 0.3 GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY video_id, speaker_id ORDER BY strength DESC, character_id) AS k FROM a WHERE strength > 0.5)
"""
query("win_second_pass", sql(_LEARNED + "SELECT s.video_id, s.segment_id, b.character_id, round(b.strength * 0.8, 6) AS score FROM s JOIN b USING (video_id, speaker_id) WHERE s.score <= 0.3 AND b.k = 1", "seg"))(lambda s, d: _second(s, d))


def _second(spark, sf):
    """Dialogues of low confidence by what those of higher confidence teach of their speakers."""
    rows = mp.segments(spark, sf).select("video_id", "ord", "segment_id", F.col("speaker").alias("speaker_id"), F.col("confidence").alias("score"), F.concat(F.lit("C"), (F.col("ord") % 3).cast("string")).alias("character_id"))
    left = rows.where("score <= 0.3").select("video_id", "speaker_id", "segment_id")
    return ma.second_pass(left, ma.associations(rows.where("score > 0.3"))).select("video_id", "segment_id", "character_id", F.round("score", 6).alias("score"))


# ---- streams ---------------------------------------------------------------------------


def _boxes(rows: DataFrame) -> DataFrame:
    k = F.col("ord")
    x, y = F.pmod(k * 13, F.lit(500)).cast("double"), F.pmod(k * 17, F.lit(350)).cast("double")
    return rows.select("video_id", "ts", k.alias("frame"), "ord", x.alias("x1"), y.alias("y1"), (x + 20 + F.pmod(k * 7, F.lit(100))).alias("x2"), (y + 20 + F.pmod(k * 11, F.lit(100))).alias("y2"), "character_id", "kind")


def _tracks(spark, sf, **how) -> DataFrame:
    online.keep_state_in_rocksdb(spark)
    return Streamed(spark, sf).rows(lambda r: online.tracks(_boxes(r).withColumn("kind", F.lit("cut")), at="ts", idle="60 days", **how))


query("st_tracks", f"WITH {ARRIVED} SELECT user_id AS video_id, count(*) AS n, true AS from_zero FROM e GROUP BY ALL")(lambda s, d: _tracks(s, d).groupBy("video_id").agg(F.count("*").alias("n"), (F.min("track_id") == 0).alias("from_zero")))
query("st_reset", f"WITH {ARRIVED} SELECT user_id AS video_id, event_id AS ord, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS track_id FROM e")(lambda s, d: _tracks(s, d, reset=("cut",)).select("video_id", "ord", "track_id"))
query("drv_resume", sql("SELECT video_id, count(*) AS n FROM shot GROUP BY ALL", "shot"))(lambda s, d: _resumed(s, d))


def _resumed(spark, sf):
    """A second run over the same folder reads what the first has written, and its own stage is not run."""
    from .stages import Pipeline

    folder = shared_folder(spark)
    Pipeline({"video": lambda a, t: {"n": mp.shots(a, sf).groupBy("video_id").agg(F.count("*").alias("n"))}}, folder).run(spark, {}, ["video"])
    again = Pipeline({"video": lambda a, t: {"n": a.range(0).select(F.col("id").alias("video_id"), F.raise_error(F.lit("ran again")).cast("bigint").alias("n"))}}, folder)
    return again.run(spark, {}, ["video"])[0]["n"]
