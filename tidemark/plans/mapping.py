"""Domain tables (segments, turns, detections, scenes, shots, ...) laid over the test tables.

Every view is a pure projection or window over one table, and SQL states the same view
for an oracle. Times are whole or tenth ticks, so both engines add them exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import EMOTIONS, word_count


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _emotion(k: Column) -> Column:
    return F.get(F.array(*[F.lit(e) for e in EMOTIONS]), F.pmod(k, F.lit(len(EMOTIONS))).cast("int"))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """Transcript segments: one per turn, as long as it has words."""
    t = table(spark, sf, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("ord"), F.col("role").alias("speaker"), "text")
    order = Window.partitionBy("video_id").orderBy("ord")
    n = word_count(F.col("text"))
    end = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return t.withColumn("n", n).select(
        "video_id", "ord", F.format_string("SEG_%04d", F.col("ord")).alias("segment_id"), "speaker", "text", "n",
        (end - F.col("n")).cast("double").alias("start"), end.cast("double").alias("end"),
        (F.pmod(F.col("ord") * 37 + F.col("video_id") * 11, F.lit(100)) / F.lit(100.0)).alias("confidence"),
        _emotion(F.col("video_id") + F.col("ord") * 3).alias("emotion"),
        (F.pmod(F.col("ord") * 53 + F.col("video_id") * 7, F.lit(100)) / F.lit(100.0)).alias("emotion_confidence"),
    )


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Speaker turns: the segments, shifted against them by a few ticks."""
    s = segments(spark, sf)
    return s.select("video_id", "ord", F.col("speaker").alias("speaker_id"), (F.col("start") + F.pmod("ord", F.lit(3)) * 4).alias("start"), (F.col("end") + F.pmod("ord", F.lit(2)) * 5).alias("end"), "confidence")


def detections(spark: SparkSession, sf: str) -> DataFrame:
    """Face detections: one per event; the user is the video."""
    e = table(spark, sf, "events")
    k = F.col("event_id")
    left, top = F.pmod(k * 13, F.lit(500)).cast("double"), F.pmod(k * 17, F.lit(350)).cast("double")
    box = F.struct(left.alias("x1"), top.alias("y1"), (left + 20 + F.pmod(k * 7, F.lit(100))).alias("x2"), (top + 20 + F.pmod(k * 11, F.lit(100))).alias("y2"))
    return e.select(
        F.col("user_id").alias("video_id"), k.alias("ord"), F.concat(F.lit("C"), F.pmod(F.floor(k / 3), F.lit(5)).cast("string")).alias("character_id"),
        F.pmod(k * 7919, F.lit(4000)).alias("decis"), (F.pmod(k * 7919, F.lit(4000)) / F.lit(10.0)).alias("ts"),
        (F.col("value") / 500).alias("confidence"), box.alias("box"), _emotion(k).alias("emotion"), F.col("event_type").alias("kind"),
    )


def videos(spark: SparkSession, sf: str) -> DataFrame:
    """One row per video: its duration, segments and words."""
    return segments(spark, sf).groupBy("video_id").agg(F.max("end").alias("duration"), F.count("*").alias("segments"), F.sum("n").alias("words"))


def tiles(spark: SparkSession, sf: str, width: int) -> DataFrame:
    """Spans of ``width`` ticks that cover each video, the last one clipped."""
    v = videos(spark, sf).withColumn("k", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("duration") / width).cast("int") - 1))))
    return v.select("video_id", (F.col("k") + 1).cast("bigint").alias("id"), (F.col("k") * width).cast("double").alias("start"), F.least((F.col("k") + 1) * width, F.col("duration")).cast("double").alias("end"))


def scenes(spark: SparkSession, sf: str) -> DataFrame:
    return tiles(spark, sf, 60)


def shots(spark: SparkSession, sf: str) -> DataFrame:
    return tiles(spark, sf, 20)


_EMO = "['" + "', '".join(EMOTIONS) + "']"
#: The same views in DuckDB SQL.
SQL = {
    "seg": f"""seg0 AS (SELECT conv_id AS video_id, turn AS ord, role AS speaker, text, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''))::BIGINT AS n FROM conversations),
seg AS (SELECT *, printf('SEG_%04d', ord) AS segment_id, (sum(n) OVER w - n)::DOUBLE AS start, (sum(n) OVER w)::DOUBLE AS "end", ((ord * 37 + video_id * 11) % 100) / 100.0::DOUBLE AS confidence,
  {_EMO}[((video_id + ord * 3) % 7 + 1)::INT] AS emotion, ((ord * 53 + video_id * 7) % 100) / 100.0::DOUBLE AS emotion_confidence FROM seg0 WINDOW w AS (PARTITION BY video_id ORDER BY ord))""",
    "turn": """turn AS (SELECT video_id, ord, speaker AS speaker_id, start + (ord % 3) * 4 AS start, "end" + (ord % 2) * 5 AS "end", confidence FROM seg)""",
    "det": f"""det AS (SELECT user_id AS video_id, event_id AS ord, 'C' || ((event_id // 3) % 5)::VARCHAR AS character_id, (event_id * 7919) % 4000 AS decis, ((event_id * 7919) % 4000) / 10.0::DOUBLE AS ts, value / 500 AS confidence,
  ((event_id * 13) % 500)::DOUBLE AS x1, ((event_id * 17) % 350)::DOUBLE AS y1, ((event_id * 13) % 500 + 20 + (event_id * 7) % 100)::DOUBLE AS x2, ((event_id * 17) % 350 + 20 + (event_id * 11) % 100)::DOUBLE AS y2,
  {_EMO}[(event_id % 7 + 1)::INT] AS emotion, event_type AS kind FROM events)""",
    "vid": """vid AS (SELECT video_id, max("end") AS duration, count(*) AS segments, sum(n)::BIGINT AS words FROM seg GROUP BY video_id)""",
    "scene": """scene AS (SELECT video_id, k + 1 AS id, (k * 60)::DOUBLE AS start, least((k + 1) * 60, duration)::DOUBLE AS "end" FROM (SELECT *, unnest(range(0, greatest(1, ceil(duration / 60)::BIGINT))) AS k FROM vid))""",
    "shot": """shot AS (SELECT video_id, k + 1 AS id, (k * 20)::DOUBLE AS start, least((k + 1) * 20, duration)::DOUBLE AS "end" FROM (SELECT *, unnest(range(0, greatest(1, ceil(duration / 20)::BIGINT))) AS k FROM vid))""",
}


def sql(body: str, *names: str) -> str:
    """A query over some of the views, with those that they need."""
    needs = {"turn": ["seg"], "vid": ["seg"], "scene": ["seg", "vid"], "shot": ["seg", "vid"]}
    order: list[str] = []
    for name in names:
        order += [x for x in [*needs.get(name, []), name] if x not in order]
    return "WITH " + ",\n".join(SQL[x] for x in order) + ("\n" if body.lstrip().upper().startswith("SELECT") else ",\n") + body
