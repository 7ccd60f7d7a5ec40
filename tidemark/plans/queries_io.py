"""Queries that go through files, streams, configuration and plug-ins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vector as vc
from ..operators import intervals as iv
from ..operators import quality as ql
from ..sources import readers as rd
from ..sources import sinks as sk
from ..streaming import online
from . import mapping as mp
from . import registry, stages
from .config import Config
from .mapping import sql
from .queries import query


def shared_folder(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder that the cluster names; a local one only where there is no cluster."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
    return f"{sc.getCheckpointDir()}/io-{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """Rows written as JSON documents to the shared folder and read back."""
    path = shared_folder(rows.sparkSession)
    sk.write_document(rows, path)
    return rows.sparkSession.read.schema(rows.schema).json(path)


def through_json(rows: DataFrame, kind: str, name: str, entry, order: str) -> DataFrame:
    """Rows nested into documents, written as JSON, read back with the declared schema and flattened."""
    spark, path = rows.sparkSession, shared_folder(rows.sparkSession)
    listed = F.transform(F.array_sort(F.collect_list(F.struct(order, entry.alias("e")))), lambda x: x["e"])
    sk.write_document(rows.groupBy(F.col("video_id").cast("string").alias("video_id")).agg(listed.alias(name)), path)
    return rd.rows_of(rd.read_document(spark, path, kind, lines=True), kind).withColumn("video_id", F.col("video_id").cast("bigint"))


query("src_json_a", sql("SELECT video_id, segment_id, start AS start_time, text, emotion FROM seg", "seg"))(
    lambda s, d: through_json(mp.segments(s, d), "a", "segments", F.struct("segment_id", F.col("start").alias("start_time"), F.col("end").alias("end_time"), "text", "confidence", "emotion"), "ord").select("video_id", "segment_id", "start_time", "text", "emotion")
)
query("src_json_b", sql("SELECT video_id, speaker_id, start AS start_time FROM turn", "turn"))(lambda s, d: through_json(mp.turns(s, d), "b", "segments", F.struct("speaker_id", F.col("start").alias("start_time"), F.col("end").alias("end_time")), "ord").select("video_id", "speaker_id", "start_time"))
query("src_json_c", sql("SELECT video_id, ts AS timestamp, character_id, x1 FROM det", "det"))(
    lambda s, d: through_json(mp.detections(s, d), "c", "detections", F.struct(F.col("ts").alias("timestamp"), "character_id", F.array("box.x1", "box.y1", "box.x2", "box.y2").alias("bbox")), "ord").select("video_id", "timestamp", "character_id", F.get("bbox", F.lit(0)).alias("x1"))
)
query("src_json_d", sql("SELECT video_id, speaker AS character_id, segment_id FROM seg", "seg"))(
    lambda s, d: through_json(mp.segments(s, d), "d", "matches", F.struct(F.col("speaker").alias("character_id"), F.struct("segment_id", "text").alias("dialogue_segment")), "ord").select("video_id", "character_id", "dialogue.segment_id")
)
query("src_schemas_abc", sql("SELECT video_id, count(*) AS n FROM seg GROUP BY ALL", "seg"))(lambda s, d: through_json(mp.segments(s, d), "a", "segments", F.struct("segment_id", "text"), "ord").groupBy("video_id").agg(F.count("*").alias("n")))
query("src_shots", sql('SELECT video_id, id::INTEGER AS shot_id, start, "end" - start AS duration FROM shot', "shot"))(lambda s, d: through_json(mp.shots(s, d), "shots", "shots", F.struct("id", F.col("start").alias("start_time"), "end"), "id").select("video_id", "shot_id", "start", "duration"))
query("src_scenes", sql('SELECT video_id, id::INTEGER AS scene_id, "end", id::INTEGER AS shot FROM scene', "scene"))(lambda s, d: through_json(mp.scenes(s, d), "scenes", "scenes", F.struct(F.col("id").alias("scene_id"), "start", F.col("end").alias("end_time"), F.array(F.col("id").cast("int")).alias("contained_shots")), "id").select("video_id", "scene_id", "end", F.get("shots", F.lit(0)).alias("shot")))
query("src_scene_doc", sql("SELECT video_id, count(*) AS n FROM scene GROUP BY ALL", "scene"))(lambda s, d: through_json(mp.scenes(s, d), "scenes", "scenes", F.struct("id", "start", "end"), "id").groupBy("video_id").agg(F.count("*").alias("n")))
query("src_scene_detector", sql("SELECT video_id, id::INTEGER AS scene_id, start FROM scene", "scene"))(lambda s, d: through_json(mp.scenes(s, d), "scenes", "scenes", F.struct("id", F.col("start").alias("start_time"), "end"), "id").select("video_id", "scene_id", "start"))
query("snk_clusters", "SELECT label::BIGINT AS video_id, count(*)::INTEGER AS n FROM embeddings GROUP BY ALL")(lambda s, d: stored(sk.nested(mp.table(s, d, "embeddings").select(F.col("label").cast("bigint").alias("video_id"), "vec_id"), "faces", "vec_id")).select("video_id", F.col("total_faces").alias("n")))
query("snk_scenes", sql("SELECT video_id, count(*)::INTEGER AS n FROM scene GROUP BY ALL", "scene"))(lambda s, d: stored(sk.nested(mp.scenes(s, d), "scenes", "id", "start", "end")).select("video_id", F.col("total_scenes").alias("n")))
query("snk_frames_meta", sql("SELECT ord, printf('frame_%06d.jpg', ord) AS file, ts FROM det", "det"))(lambda s, d: stored(mp.detections(s, d).select("ord", F.format_string("frame_%06d.jpg", "ord").alias("file"), "ts")))
query("snk_visual_results", sql("SELECT video_id, character_id, count(*) AS n FROM det GROUP BY ALL", "det"))(lambda s, d: _written(mp.detections(s, d)).groupBy("video_id", "character_id").agg(F.count("*").alias("n")))
query("snk_format_router", sql("SELECT format, CASE WHEN format = 'none' THEN 'unknown' ELSE 'written' END AS status, CASE WHEN format <> 'none' THEN (SELECT count(*) FROM vid) END AS files FROM (VALUES ('json'), ('none'), ('srt')) t(format)", "vid"))(lambda s, d: _routed(s, d))


def _written(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _routed(spark, sf):
    """What became of each format, and how many bodies can be read back."""
    from .queries_more import captions

    folder = shared_folder(spark)
    said = sk.raise_failures(sk.write_all(captions(spark, sf), folder, ["srt", "json", "none"]))
    found = [(k, v, spark.read.schema("video_id long, body string").json(f"{folder}/{k}").where("body is not null").count() if v == "written" else None) for k, v in sorted(said.items())]
    return spark.createDataFrame(found, "format string, status string, files long")


# ---- frames and faces ------------------------------------------------------------------

query("src_frames", sql("SELECT video_id, unnest(range(0, duration::BIGINT + 1, 25)) AS frame FROM vid", "vid"))(lambda s, d: mp.videos(s, d).select("video_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("duration").cast("bigint"), F.lit(25).cast("bigint"))).alias("frame")))
_FQ = "confidence * (0.5 + 0.5 * least((x2 - x1) / 112, 1.0))"


def _faces(spark, sf):
    size = F.col("box.x2") - F.col("box.x1")
    return mp.detections(spark, sf).where(size >= 40).select("video_id", "ord", F.floor(F.col("decis") / 40).alias("frame"), F.round(ql.face_quality(F.col("confidence"), (F.lit(0.0),) * 3, size), 9).alias("q"))


query("src_faces", sql(f"SELECT video_id, ord, decis // 40 AS frame, round({_FQ}, 9) AS q FROM det WHERE x2 - x1 >= 40", "det"))(_faces)
query("fn_face_batch", sql(f"SELECT video_id, frame, ord FROM (SELECT *, row_number() OVER (PARTITION BY video_id, frame ORDER BY q DESC, ord) AS k FROM (SELECT video_id, ord, decis // 40 AS frame, round({_FQ}, 9) AS q FROM det WHERE x2 - x1 >= 40)) WHERE k = 1", "det"))(lambda s, d: iv.first_by(_faces(s, d), ["video_id", "frame"], F.desc("q"), "ord").select("video_id", "frame", "ord"))
query("flt_char_dialogue", sql("SELECT video_id, ord FROM seg WHERE speaker = 'user'", "seg"))(lambda s, d: mp.segments(s, d).where("speaker = 'user'").select("video_id", "ord"))

# ---- configuration and plug-ins --------------------------------------------------------

query("src_config", "SELECT * FROM (VALUES ('a.b', '2'), ('a.c', 'kept'), ('a.z', 'none')) t(path, value)")(lambda s, d: _config(s))
query("fn_template_lookup", "SELECT * FROM (VALUES ('desc', 'Describe what can be seen in this scene.'), ('narrative', 'Tell what happens in this scene.')) t(name, head)")(lambda s, d: s.createDataFrame([(n, tx.template(n).split("\n")[0]) for n in ("desc", "narrative")], "name string, head string"))
query("set_components", "SELECT * FROM (VALUES ('audio', 'ok'), ('video', 'ok')) t(component, status)")(lambda s, d: s.createDataFrame(sorted(stages.Pipeline({"video": lambda a, t: {}, "audio": lambda a, t: {}}).run(s, {}, ["video", "audio", "caption"], ("caption",))[1].items()), "component string, status string"))
query("drv_stage_drivers", sql("SELECT video_id, count(*) AS n FROM shot GROUP BY ALL", "shot"))(lambda s, d: stages.Pipeline({"video": lambda a, t: {"n": mp.shots(a, d).groupBy("video_id").agg(F.count("*").alias("n"))}}, shared_folder(s)).run(s, {}, ["video"])[0]["n"])
query("drv_verify", "SELECT unnest(['java', 'numpy', 'pandas', 'pyarrow', 'pyspark']) AS library, true AS found")(lambda s, d: s.createDataFrame([(k, v) for k, v in sorted(stages.verify().items()) if k not in ("yaml", "ffmpeg")], "library string, found boolean"))
query("drv_cli", "SELECT 'caption: mock' AS line UNION ALL SELECT 'transcribe: energy' UNION ALL SELECT 'diarize: pitch'")(lambda s, d: _told(s, "list-models"))


def _told(spark, *argv: str):
    """What a command of the program prints about the built-in parts."""
    import contextlib
    import io

    from ..__main__ import main

    with contextlib.redirect_stdout(io.StringIO()) as out:
        main(list(argv))
    lines = [x for x in out.getvalue().splitlines() if x.endswith((": mock", ": energy", ": pitch"))]
    return spark.createDataFrame([(x,) for x in lines], "line string")
query("udf_retry", sql("SELECT video_id, ord, speaker AS prompt, 'A caption of ' || length(speaker) || ' letters.' AS caption, NULL::VARCHAR AS error FROM seg", "seg"))(lambda s, d: _flaky(s, d))
query("udf_template", sql("SELECT video_id, ord, speaker || ' / ' || n AS v FROM seg", "seg"))(lambda s, d: mp.segments(s, d).select("video_id", "ord", tx.prompt(F.col("speaker"), F.col("n").cast("string"), F.lit(""), "custom", "%s / %s%s").alias("v")))
query("udf_backend", sql("SELECT video_id, speaker_id, count(*) AS n FROM turn GROUP BY ALL", "turn"))(lambda s, d: _backend(s, d))
query("udf_formats", "SELECT unnest(['html', 'json', 'srt', 'txt', 'vtt']) AS format")(lambda s, d: s.createDataFrame([(k,) for k in sorted(sk.FORMATS)], "format string"))


def _config(spark):
    c = Config({"a": {"b": 1, "c": "kept"}})
    c.set("a.b", 2)
    return spark.createDataFrame([(p, str(c.get(p, "none"))) for p in ("a.b", "a.c", "a.z")], "path string, value string")


def _flaky(spark, sf):
    """A model that fails on every first call still answers at the second attempt."""

    def make():
        calls = {"n": 0}

        def model(prompt: str) -> str:
            calls["n"] += 1
            if calls["n"] % 2:
                raise ValueError("busy")
            return f"A caption of {len(prompt)} letters."

        return model

    registry.MODELS["flaky"] = make
    return registry.captioned(mp.segments(spark, sf).select("video_id", "ord", F.col("speaker").alias("prompt")), "flaky")


def _backend(spark, sf):
    registry.BACKENDS["turns"] = mp.turns
    return registry.backend("auto", spark, sf).groupBy("video_id", "speaker_id").agg(F.count("*").alias("n"))


# ---- streams ---------------------------------------------------------------------------


#: A stream's deliveries, days of each, and how many deliveries a late row comes after its own.
DELIVERIES, DAYS, LATER = 5, 6, 3


class Streamed:
    """Append streams over the events, which come in deliveries of some days; some rows of the first two come late.

    After each delivery the stream runs to its end from its checkpoint, with the state and
    the watermark of the one before. Each micro-batch's rows go to a folder of its own, so
    that a batch that runs twice counts once.
    """

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.folder = spark, shared_folder(spark)
        events = mp.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
        first = events.agg(F.min("ts")).first()[0]
        own = F.least(F.floor((F.unix_micros("ts") - F.unix_micros(F.lit(first))) / (DAYS * 86_400_000_000)), F.lit(DELIVERIES - 1))
        late = (F.col("event_id") % 97 == 0) & (own < 2)
        rows = events.select(F.col("user_id").alias("video_id"), "ts", "value", F.col("event_id").alias("ord"), F.concat(F.lit("C"), F.pmod(F.floor(F.col("event_id") / 3), F.lit(5)).cast("string")).alias("character_id"), F.col("event_type").alias("kind"), F.when(late, own + LATER).otherwise(own).cast("int").alias("delivery"))
        rows.write.partitionBy("delivery").parquet(f"{self.folder}/events")
        self.schema, self.progress = rows.drop("delivery").schema, []

    def rows(self, make) -> DataFrame:
        """All rows of an append stream."""
        out = f"{self.folder}/out"

        def keep(df: DataFrame, batch: int) -> None:
            df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

        for n in range(DELIVERIES):
            self.spark.read.schema(self.schema).parquet(f"{self.folder}/events/delivery={n}").write.mode("append").parquet(f"{self.folder}/in")
            q = make(self.spark.readStream.schema(self.schema).parquet(f"{self.folder}/in")).writeStream.foreachBatch(keep).outputMode("append").option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start()
            q.awaitTermination()
            self.progress += [(n, *p) for p in online.progress(q)]
        return self.spark.read.parquet(out).drop("batch")


def _streamed(spark: SparkSession, sf: str, make) -> DataFrame:
    return Streamed(spark, sf).rows(make)


#: The rows that are not late, and the time of the last watermark less its delay.
ARRIVED = f"""e0 AS (SELECT *, least(floor((epoch_us(ts) - epoch_us(min(ts) OVER ())) / ({DAYS} * 86400000000)), {DELIVERIES - 1})::INTEGER AS own FROM events), m AS (SELECT max(ts) AS top FROM events),
e AS (SELECT e0.*, m.top FROM e0, m WHERE NOT (event_id % 97 = 0 AND own < 2))"""
_DAY = "floor(unix_timestamp(window.start) / 86400)"

query("st_tumbling", f"WITH {ARRIVED} SELECT video_id, day, n FROM (SELECT user_id AS video_id, floor(epoch(ts) / 86400)::BIGINT AS day, count(*) AS n, min(epoch(top)) AS top FROM e GROUP BY 1, 2) WHERE (day + 1) * 86400 <= top - 600")(
    lambda s, d: _streamed(s, d, lambda r: online.coverage(r, width="1 day", late="10 minutes")).selectExpr("video_id", f"{_DAY} AS day", "n")
)
query("st_sliding", f"WITH {ARRIVED} SELECT video_id, day, n, mean FROM (SELECT user_id AS video_id, floor(epoch(ts) / 86400)::BIGINT - k AS day, count(*) AS n, round(avg(value), 6) AS mean, min(epoch(top)) AS top FROM e, range(2) r(k) GROUP BY 1, 2) WHERE (day + 2) * 86400 <= top - 600")(
    lambda s, d: _streamed(s, d, lambda r: online.sliding(r, width="2 days", step="1 day", late="10 minutes")).selectExpr("video_id", f"{_DAY} AS day", "n", "round(mean, 6) AS mean")
)
query("st_session", f"""WITH {ARRIVED}, f AS (SELECT *, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM f)
SELECT user_id AS video_id, floor(epoch(min(ts)))::BIGINT AS start, floor(epoch(max(ts)))::BIGINT AS "end", count(*) AS points FROM g GROUP BY user_id, k HAVING max(ts) + INTERVAL 6 HOUR <= min(top) - INTERVAL 10 MINUTE""")(
    lambda s, d: _streamed(s, d, lambda r: online.appearances(r.withColumn("character_id", F.lit("one")), gap="6 hours", late="10 minutes")).selectExpr("video_id", "unix_timestamp(start) AS start", "unix_timestamp(end) AS end", "points")
)


def _slots(rows: DataFrame) -> DataFrame:
    return online.frames_of_slot(rows.withColumns({"hash": F.floor("value"), "slot": F.date_trunc("day", "ts")}), late="1 day")


query("st_dedup", f"WITH {ARRIVED} SELECT DISTINCT user_id AS video_id, floor(value)::BIGINT AS hash, floor(epoch(ts) / 86400)::BIGINT AS day FROM e")(lambda s, d: _streamed(s, d, _slots).selectExpr("video_id", "hash", "floor(unix_timestamp(slot) / 86400) AS day"))
query("st_late", f"SELECT own + {LATER} AS delivery, count(*) AS late FROM (SELECT *, least(floor((epoch_us(ts) - epoch_us(min(ts) OVER ())) / ({DAYS} * 86400000000)), {DELIVERIES - 1})::BIGINT AS own FROM events) WHERE event_id % 97 = 0 AND own < 2 GROUP BY ALL")(lambda s, d: _late(s, d))


def _late(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that came too late, by delivery, as the stream's operators count them."""
    stream = Streamed(spark, sf)
    stream.rows(_slots)
    batches = spark.createDataFrame(stream.progress, "delivery long, batch long, rows long, state long, removed long, late long")  # a row a micro-batch
    return batches.groupBy("delivery").agg(F.sum("late").alias("late")).where("late > 0")
