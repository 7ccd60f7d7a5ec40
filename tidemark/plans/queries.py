"""Registered queries of the operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import time as tm
from ..functions import vector as vc
from ..operators import intervals as iv
from ..operators import quality as ql
from ..operators import scoring as sc
from ..operators import sessions as se
from ..sources import readers as rd
from . import mapping as mp
from .mapping import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f

    return keep


def columns(name: str, view: Callable, exprs: Callable[[], dict], keys: list[str], body: str, *views: str) -> None:
    """Register a projection of a view: the same keys and columns on both sides."""
    query(name, sql(body, *views))(lambda spark, sf: view(spark, sf).select(*keys, *[e.alias(c) for c, e in exprs().items()]))


_K = ["video_id", "ord"]


def _s():
    return F.col("start") * 7 + 0.25


def _e():
    return F.col("end") * 7 + 0.75


def _clk():
    return F.format_string("%02d:%02d:%02d", F.col("video_id") % 5, F.col("ord") * 7 % 60, F.col("n") % 60)


def _codec():
    return F.element_at(F.array(*[F.lit(c) for c in ("h264", "av1", "vp8", "vp9", "xvid")]), (F.col("ord") % 5 + 1).cast("int"))



# ---- scalar functions ------------------------------------------------------------------

_T = 'SELECT video_id, ord, start * 7 + 0.25 AS s, "end" * 7 + 0.75 AS e, trunc(start * 7 + 0.25)::BIGINT AS t, trunc("end" * 7 + 0.75)::BIGINT AS u FROM seg'
_CLOCK = "printf('%02d:%02d:%02d{m}%03d', {t} // 3600, ({t} % 3600) // 60, {t} % 60, trunc(({s} - {t}) * 1000)::BIGINT)"
_READ = "CASE WHEN {t} >= 3600 THEN printf('%d:%02d:%02d', {t} // 3600, ({t} % 3600) // 60, {t} % 60) ELSE printf('%d:%02d', {t} // 60, {t} % 60) END"
_COMP = "CASE WHEN {t} >= 3600 THEN printf('%dh%dm%ds', {t} // 3600, ({t} % 3600) // 60, {t} % 60) WHEN {t} >= 60 THEN printf('%dm%ds', {t} // 60, {t} % 60) ELSE printf('%ds', {t}) END"
columns("fn_hms", mp.segments, lambda: {"v": tm.readable(_s())}, _K, f"SELECT video_id, ord, {_READ.format(t='t')} AS v FROM ({_T})", "seg")
columns("fn_srt", mp.segments, lambda: {"v": tm.srt(_s())}, _K, f"SELECT video_id, ord, {_CLOCK.format(m=',', t='t', s='s')} AS v FROM ({_T})", "seg")
columns("fn_vtt", mp.segments, lambda: {"v": tm.vtt(_s())}, _K, f"SELECT video_id, ord, {_CLOCK.format(m='.', t='t', s='s')} AS v FROM ({_T})", "seg")
columns("fn_srt_pkg", mp.segments, lambda: {"v": F.concat(tm.srt(_s()), F.lit(" --> "), tm.srt(_e()))}, _K, f"SELECT video_id, ord, {_CLOCK.format(m=',', t='t', s='s')} || ' --> ' || {_CLOCK.format(m=',', t='u', s='e')} AS v FROM ({_T})", "seg")
columns("fn_vtt_pkg", mp.segments, lambda: {"v": tm.vtt_rounded(_s())}, _K, f"SELECT video_id, ord, printf('%02d:%02d:%06.3f', t // 3600, (t % 3600) // 60, s - floor(s / 60) * 60) AS v FROM ({_T})", "seg")
columns("fn_compact", mp.segments, lambda: {"v": tm.compact(_s())}, _K, f"SELECT video_id, ord, {_COMP.format(t='t')} AS v FROM ({_T})", "seg")
columns("fn_duration", mp.segments, lambda: {"v": tm.duration(_s())}, _K, f"SELECT video_id, ord, concat_ws(' ', CASE WHEN t >= 3600 THEN printf('%dh', t // 3600) END, CASE WHEN t >= 60 THEN printf('%dm', (t % 3600) // 60) END, printf('%ds', t % 60)) AS v FROM ({_T})", "seg")
columns("fn_range", mp.segments, lambda: {"a": tm.time_range(_s(), _e(), "readable"), "b": tm.time_range(_s(), _e(), "srt"), "c": tm.time_range(_s(), _e(), "other")}, _K, f"SELECT video_id, ord, {_READ.format(t='t')} || ' - ' || {_READ.format(t='u')} AS a, {_CLOCK.format(m=',', t='t', s='s')} || ' --> ' || {_CLOCK.format(m=',', t='u', s='e')} AS b, {_COMP.format(t='t')} || '-' || {_COMP.format(t='u')} AS c FROM ({_T})", "seg")
columns("fn_parse_ts", mp.segments, lambda: {"v": tm.parse_clock(F.when(F.col("ord") % 3 == 1, "bad").otherwise(_clk()))}, _K, "SELECT video_id, ord, CASE WHEN ord % 3 = 1 THEN 0.0 ELSE (video_id % 5) * 3600.0 + (ord * 7 % 60) * 60.0 + n % 60 END::DOUBLE AS v FROM seg", "seg")
columns("fn_probe_duration", mp.segments, lambda: {"v": tm.probe_duration(F.concat(_clk(), F.lit(".5"))), "p": F.round(tm.progress(F.col("start"), F.col("end")), 9)}, _K, 'SELECT video_id, ord, (video_id % 5) * 3600.0 + (ord * 7 % 60) * 60.0 + n % 60 + 0.5::DOUBLE AS v, round(least(coalesce(start / nullif("end", 0), 0), 1), 9) AS p FROM seg', "seg")
columns("fn_reading", mp.segments, lambda: {"v": F.round(tm.reading_seconds(F.col("text")), 6)}, _K, "SELECT video_id, ord, round(n / 180.0::DOUBLE * 60, 6) AS v FROM seg", "seg")
columns("fn_sanitize", mp.segments, lambda: {"v": tx.sanitize(F.col("text"), 120)}, _K, "SELECT video_id, ord, CASE WHEN length(c) > 120 THEN left(c, 117) || '...' ELSE c END AS v FROM (SELECT *, regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '[\\x00-\\x1f]', '', 'g') AS c FROM seg)", "seg")
columns("fn_caption_id", mp.segments, lambda: {"v": tx.caption_id(F.col("ord"), F.col("start").cast("bigint"))}, _K, "SELECT video_id, ord, printf('CAP_%03d_', ord) || left(md5(start::BIGINT::VARCHAR), 6) AS v FROM seg", "seg")
_SUM = """SELECT video_id, ord, CASE WHEN n <= 30 THEN text WHEN d > z * 0.6 THEN left(c, d + 1) WHEN m > z * 0.7 THEN left(c, m) || '...' ELSE c || '...' END AS v FROM (SELECT *, length(c) AS z,
  CASE WHEN contains(c, '.') THEN length(c) - strpos(reverse(c), '.') ELSE -1 END AS d, CASE WHEN contains(c, ',') THEN length(c) - strpos(reverse(c), ',') ELSE -1 END AS m
  FROM (SELECT *, array_to_string(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')[1:30], ' ') AS c FROM seg))"""
columns("fn_summary", mp.segments, lambda: {"v": tx.summary(F.col("text"))}, _K, _SUM, "seg")


def _speakers(spark, sf):
    return mp.segments(spark, sf).groupBy("video_id").agg(F.sort_array(F.collect_set("speaker")).alias("names"), F.array_sort(F.collect_list(F.struct("ord", "emotion"))).alias("l")).withColumn("emotions", F.transform("l", lambda x: x["emotion"]))


query("fn_chars_fmt", sql("SELECT video_id, CASE len(l) WHEN 1 THEN l[1] WHEN 2 THEN l[1] || ' and ' || l[2] ELSE array_to_string(l[1:len(l) - 1], ', ') || ', and ' || l[len(l)] END AS v FROM (SELECT video_id, list_sort(list_distinct(list(speaker))) AS l FROM seg GROUP BY video_id)", "seg"))(lambda s, d: _speakers(s, d).select("video_id", tx.names_list(F.col("names")).alias("v")))
query("fn_dialogue_fmt", sql("SELECT video_id, string_agg(speaker || ': ' || text, chr(10) ORDER BY ord) AS v FROM seg GROUP BY video_id", "seg"))(lambda s, d: mp.segments(s, d).groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.concat("speaker", F.lit(": "), "text").alias("x")))), lambda r: r["x"]), "\n").alias("v")))
query("fn_prompts", sql("SELECT video_id, ord, 'Sum up this scene in a sentence.' || chr(10) || 'Characters: ' || speaker || chr(10) || 'Dialogue: ' || text || chr(10) || 'Before: none' AS v FROM seg", "seg"))(lambda s, d: mp.segments(s, d).select("video_id", "ord", tx.prompt(F.col("speaker"), F.col("text"), F.lit("none"), "sum").alias("v")))
_EMO_SQL = """SELECT video_id, CASE WHEN len(f) = 0 THEN 'conversational' WHEN len(list_distinct(f)) > 1 AND f[1] <> f[len(f)] THEN 'shifting from ' || f[1] || ' to ' || f[len(f)]
  ELSE (SELECT e FROM (SELECT unnest(f) AS e, unnest(range(1, len(f) + 1)) AS i) GROUP BY e ORDER BY count(*) DESC, min(i) LIMIT 1) END AS v FROM (SELECT video_id, list_filter(list(emotion ORDER BY ord), lambda e: e <> 'neutral') AS f FROM seg GROUP BY video_id)"""
query("fn_emotion_ctx", sql(_EMO_SQL, "seg"))(lambda s, d: _speakers(s, d).select("video_id", tx.emotion_context(F.col("emotions")).alias("v")))
query("fn_parse_lines", sql("SELECT video_id, (ord * 2 + 2)::INTEGER AS id, start AS start, start + 5 AS \"end\", 'w' || n AS text FROM seg", "seg"))(
    lambda s, d: tx.timed_lines(
        mp.segments(s, d).groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "start", "n"))), lambda r: F.concat(F.lit("noise\n["), F.format_string("%02d:%02d:%02d", F.floor(r["start"] / 3600), F.floor(r["start"] / 60) % 60, r["start"].cast("bigint") % 60), F.lit("] w"), r["n"].cast("string"))), "\n").alias("body")),
        "body", ["video_id"],
    )
)
query("fn_json_extract", "SELECT event_id, (json_extract(props, '$.k'))::BIGINT AS k FROM events")(
    lambda s, d: mp.table(s, d, "events").select("event_id", F.explode(tx.json_array(F.concat(F.lit("so: ["), "props", F.lit("] done")), "array<struct<k:bigint>>")).alias("r")).select("event_id", "r.k")
)
query("fn_dotpath", "SELECT event_id, (json_extract(props, '$.k'))::BIGINT AS k FROM events")(lambda s, d: mp.table(s, d, "events").select("event_id", F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k")))
query("fn_positions", sql("SELECT ord, CASE WHEN (x1 + x2) / 2 < 213 THEN 'left' WHEN (x1 + x2) / 2 < 427 THEN 'center' ELSE 'right' END AS v FROM det", "det"))(lambda s, d: mp.detections(s, d).select("ord", vc.side(F.col("box")).alias("v")))
query("fn_size_reduction", sql('SELECT video_id, ord, round((1 - n / nullif("end", 0)) * 100, 6) AS v FROM seg', "seg"))(lambda s, d: mp.segments(s, d).select("video_id", "ord", F.round(ql.size_reduction(F.col("end"), F.col("n")), 6).alias("v")))
query("fn_mock_caption", sql("SELECT video_id, ord, CASE WHEN text <> '' THEN speaker || ' talk in this scene.' ELSE speaker || ' appear in this scene.' END AS v FROM (SELECT *, regexp_extract(text, '^[^\\n]*') AS t FROM seg)", "seg"))(lambda s, d: mp.segments(s, d).select("video_id", "ord", tx.mock_caption(tx.prompt(F.col("speaker"), F.regexp_replace("text", r"\n", " "), F.lit(""), "narrative")).alias("v")))
query("fn_match_prompt", sql("SELECT video_id, ord, 'Who says: ' || text || ' (' || emotion || ')?' AS v FROM seg", "seg"))(lambda s, d: mp.segments(s, d).select("video_id", "ord", F.concat(F.lit("Who says: "), "text", F.lit(" ("), "emotion", F.lit(")?")).alias("v")))
query("fn_genre_prompts", "SELECT * FROM (VALUES ('action', 'Follow movement and impact.'), ('documentary', 'Report facts and setting plainly.'), ('cinematic', 'Mind framing, light and mood.')) t(genre, prompt)")(lambda s, d: s.createDataFrame(list(tx.GENRES.items()), "genre string, prompt string"))
_COS = "list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v)))"
_EMB = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
query("fn_cosine", f"WITH {_EMB} SELECT a.vec_id, round({_COS}, 6) AS v FROM e a JOIN e b ON b.vec_id = a.vec_id + 1")(lambda s, d: _next_pairs(s, d).select("vec_id", F.round(vc.cosine(F.col("a"), F.col("b")), 6).alias("v")))


def _next_pairs(spark, sf):
    e = mp.table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")), "vec_id")


# ---- sources ---------------------------------------------------------------------------

query("src_fallback_scenes", sql('SELECT video_id, (k + 1)::INTEGER AS scene_id, (k * 30)::DOUBLE AS start, least((k + 1) * 30, duration)::DOUBLE AS "end" FROM (SELECT *, unnest(range(0, floor(duration / 30)::BIGINT + 1)) AS k FROM vid)', "vid"))(lambda s, d: rd.fallback_scenes(mp.videos(s, d)))
query("win_tiles_ceil", sql('SELECT video_id, k::INTEGER AS tile, (k * 100)::DOUBLE AS start, least((k + 1) * 100, duration)::DOUBLE AS "end" FROM (SELECT *, unnest(range(0, ceil(duration / 100)::BIGINT)) AS k FROM vid) WHERE k < 3', "vid"))(lambda s, d: rd.tiles_ceil(mp.videos(s, d), 100, 3))
query("src_tiles_shots", sql("""t AS (SELECT video_id, k + 1 AS scene_id, k * 30 AS a, least((k + 1) * 30, duration) AS b FROM (SELECT *, unnest(range(0, floor(duration / 30)::BIGINT + 1)) AS k FROM vid))
SELECT video_id, scene_id::INTEGER AS scene_id, (j + 1)::INTEGER AS shot_id, (a + j * 5)::DOUBLE AS start, (a + (j + 1) * 5)::DOUBLE AS "end" FROM (SELECT *, unnest(range(0, floor((b - a) / 5)::BIGINT)) AS j FROM t)""", "vid"))(lambda s, d: rd.nested_tiles(mp.videos(s, d)))  # fmt: skip
query("src_mock_shots", "SELECT (i + 1)::INTEGER AS shot_id, (i * 30)::DOUBLE AS start, ((i + 1) * 30)::DOUBLE AS \"end\" FROM range(4) t(i)")(lambda s, d: rd.mock_shots(s))
query("src_mock_scenes", sql("SELECT video_id, greatest(1, segments // 2)::BIGINT AS scenes FROM vid", "vid"))(lambda s, d: mp.videos(s, d).select("video_id", rd.mock_scene_count(F.col("segments")).alias("scenes")))
query("src_frame_at", sql("SELECT s.video_id, s.ord, trunc(s.start * 10)::INTEGER AS frame, count(t.ord) AS hits FROM seg s LEFT JOIN det t ON t.video_id = s.video_id AND t.decis = trunc(s.start * 10) GROUP BY ALL", "seg", "det"))(
    lambda s, d: rd.frame_at(mp.segments(s, d).select("video_id", "ord", F.col("start").alias("t")), mp.detections(s, d).groupBy("video_id", F.col("decis").cast("int").alias("frame")).agg(F.count("*").alias("h")), 10.0).select("video_id", "ord", "frame", F.coalesce("h", F.lit(0)).alias("hits"))
)
query("src_meta", "SELECT event_id, chr((97 + event_id % 26)::INTEGER) || 'v' || chr((97 + event_id % 7)::INTEGER) || '1' AS codec FROM events")(lambda s, d: mp.table(s, d, "events").select("event_id", rd.fourcc((97 + F.col("event_id") % 26) + F.lit(118) * 256 + (97 + F.col("event_id") % 7) * 65536 + F.lit(49) * 16777216).alias("codec")))
_CODEC_SQL = "['h264', 'av1', 'vp8', 'vp9', 'xvid'][(ord % 5 + 1)::INT]"
query("src_probe", sql(f"SELECT ord, concat_ws(',', CASE WHEN {_CODEC_SQL} IN ('av1', 'vp8') THEN 'codec' END, CASE WHEN x2 < 320 OR y2 < 100 THEN 'resolution' END, CASE WHEN ord % 40 < 15 THEN 'frame rate' END) AS issues FROM det", "det"))(lambda s, d: mp.detections(s, d).select("ord", F.array_join(ql.issues(_codec(), F.col("box.x2") + 320, F.col("box.y2") + 380, F.col("ord") % 40), ",").alias("issues")))
query("src_codec_compat", sql(f"SELECT ord, CASE WHEN {_CODEC_SQL} = 'h264' THEN 'true' WHEN {_CODEC_SQL} IN ('av1', 'vp8', 'vp9') THEN 'false' ELSE 'unknown' END AS ok FROM det", "det"))(lambda s, d: mp.detections(s, d).select("ord", F.coalesce(ql.codec_support(_codec()).cast("string"), F.lit("unknown")).alias("ok")))
query("src_scenes_cv", sql("""o AS (SELECT video_id, list(decis::DOUBLE ORDER BY decis) AS l FROM det WHERE confidence > 0.2 GROUP BY video_id), f AS (SELECT video_id, list_reduce(l, lambda k, t: CASE WHEN t[1] - k[len(k)] >= 30 THEN list_concat(k, t) ELSE k END) AS k FROM (SELECT video_id, list_transform(l, lambda t: [t]) AS l FROM o))
SELECT video_id, unnest(k) AS frame FROM f""", "det"))(lambda s, d: rd.scene_cuts(mp.detections(s, d).select("video_id", F.col("decis").alias("frame"), F.col("confidence").alias("diff")), 0.2, 30))
query("src_synthetic", """SELECT video_id, ord, start, start + 2 + h / 200 AS "end", printf('SPEAKER_%02d', h % 4) AS speaker, 0.5 + h / 2000 AS confidence FROM (SELECT i // 150 AS video_id, i % 150 AS ord, (i * 7919 + 7 * 104729) % 1000 AS h, (i % 150) * 12.0::DOUBLE + ((i * 7919 + 7 * 104729) % 1000) / 250 AS start FROM range(450) t(i))""")(lambda s, d: rd.synthetic(s))

# ---- projections and filters -----------------------------------------------------------

query("flt_asr_valid", sql("SELECT video_id, printf('SEG_%04d', row_number() OVER (PARTITION BY video_id ORDER BY ord) - 1) AS segment_id, 1 - confidence AS confidence FROM seg WHERE \"end\" > start AND trim(text) <> ''", "seg"))(
    lambda s, d: mp.segments(s, d).where((F.col("end") > F.col("start")) & (F.trim("text") != "")).select("video_id", F.format_string("SEG_%04d", F.row_number().over(Window.partitionBy("video_id").orderBy("ord")) - 1).alias("segment_id"), (1 - F.coalesce("confidence", F.lit(0.0))).alias("confidence"))
)
query("flt_fix_a", sql("SELECT count(*) FILTER (\"end\" <= start OR trim(text) = '' OR n < 40) AS removed, count(*) FILTER (NOT (\"end\" <= start OR trim(text) = '' OR n < 40)) AS kept FROM seg", "seg"))(lambda s, d: _fixed(s, d))


def _fixed(spark, sf):
    bad = (F.col("end") <= F.col("start")) | (F.trim("text") == "") | (F.col("n") < 40)
    return mp.segments(spark, sf).agg(F.count_if(bad).alias("removed"), F.count_if(~bad).alias("kept"))


query("flt_fix_c", sql("SELECT c.character_id, coalesce(CASE WHEN k % 2 = 0 THEN NULL ELSE k END, n)::BIGINT AS num_appearances FROM (SELECT 'C' || i AS character_id, i AS k FROM range(5) t(i)) c LEFT JOIN (SELECT character_id, count(*) AS n FROM det GROUP BY ALL) x USING (character_id)", "det"))(
    lambda s, d: s.range(5).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("character_id"), F.when(F.col("id") % 2 == 1, F.col("id")).alias("k")).join(mp.detections(s, d).groupBy("character_id").agg(F.count("*").alias("n")), "character_id", "left").select("character_id", F.coalesce("k", "n").alias("num_appearances"))
)
query("flt_min_dur", sql("""f AS (SELECT * FROM turn WHERE "end" - start >= 70)
SELECT video_id, printf('SPK_SEG_%04d', row_number() OVER (PARTITION BY video_id ORDER BY start, ord) - 1) AS segment_id, printf('SPEAKER_%02d', dense_rank() OVER (PARTITION BY video_id ORDER BY speaker_id) - 1) AS speaker FROM f""", "turn"))(lambda s, d: _long_turns(s, d))  # fmt: skip


def _long_turns(spark, sf):
    w = Window.partitionBy("video_id")
    f = mp.turns(spark, sf).where(F.col("end") - F.col("start") >= 70)
    return f.select("video_id", F.format_string("SPK_SEG_%04d", F.row_number().over(w.orderBy("start", "ord")) - 1).alias("segment_id"), F.format_string("SPEAKER_%02d", F.dense_rank().over(w.orderBy("speaker_id")) - 1).alias("speaker"))


query("flt_min_dur_simple", sql("SELECT video_id, printf('SPKR_%04d', row_number() OVER (PARTITION BY video_id ORDER BY start, ord) - 1) AS segment_id, 'speaker_' || speaker_id AS speaker, 0.8::DOUBLE AS confidence FROM turn WHERE \"end\" - start >= 70", "turn"))(
    lambda s, d: mp.turns(s, d).where(F.col("end") - F.col("start") >= 70).select("video_id", F.format_string("SPKR_%04d", F.row_number().over(Window.partitionBy("video_id").orderBy("start", "ord")) - 1).alias("segment_id"), F.concat(F.lit("speaker_"), "speaker_id").alias("speaker"), F.lit(0.8).alias("confidence"))
)
query("flt_speaker", sql("SELECT video_id, ord, start FROM turn WHERE speaker_id = 'user'", "turn"))(lambda s, d: mp.turns(s, d).where("speaker_id = 'user'").select("video_id", "ord", "start"))
query("flt_char_det", sql("SELECT ord, ts FROM det WHERE character_id = 'C3'", "det"))(lambda s, d: mp.detections(s, d).where("character_id = 'C3'").select("ord", "ts"))
query("flt_time_tol", sql("SELECT ord, ts FROM det WHERE abs(ts - 100) <= 0.5", "det"))(lambda s, d: mp.detections(s, d).where(F.abs(F.col("ts") - 100) <= 0.5).select("ord", "ts"))
query("flt_min_conf", sql("SELECT ord FROM det WHERE confidence IS NOT NULL AND confidence >= 0.5", "det"))(lambda s, d: mp.detections(s, d).where("confidence is not null and confidence >= 0.5").select("ord"))
query("flt_min_app", sql("SELECT video_id, character_id, count(*) AS n FROM det GROUP BY ALL HAVING count(*) >= 5", "det"))(lambda s, d: mp.detections(s, d).groupBy("video_id", "character_id").agg(F.count("*").alias("n")).where("n >= 5"))
_IMP = """least(2.0::DOUBLE, 1.0::DOUBLE * (CASE WHEN "end" - start > 3 THEN 1.2 ELSE 1.0 END)::DOUBLE * (CASE WHEN confidence > 0.8 THEN 1.1 ELSE 1.0 END)::DOUBLE * (CASE WHEN emotion <> 'neutral' THEN 1.1 ELSE 1.0 END)::DOUBLE)"""
columns("prj_importance", mp.segments, lambda: {"v": F.round(ql.importance(F.col("start"), F.col("end"), F.col("confidence"), F.col("emotion")), 6)}, _K, f"SELECT video_id, ord, round({_IMP}, 6) AS v FROM seg", "seg")
query("prj_name", sql("SELECT ord, CASE WHEN character_id IN ('C0', 'C1') THEN 'Ann' ELSE 'Character_' || character_id END AS name FROM det", "det"))(
    lambda s, d: mp.detections(s, d).join(F.broadcast(s.createDataFrame([("C0", "Ann"), ("C1", "Ann")], "character_id string, n string")), "character_id", "left").select("ord", F.coalesce("n", F.concat(F.lit("Character_"), "character_id")).alias("name"))
)
query("prj_conf_level", sql("SELECT ord, CASE WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.5 THEN 'medium' ELSE 'low' END AS a, CASE WHEN confidence > 0.7 THEN 'high' ELSE 'medium' END AS b FROM det", "det"))(lambda s, d: mp.detections(s, d).select("ord", sc.confidence_level(F.col("confidence")).alias("a"), sc.confidence_level(F.col("confidence"), True).alias("b")))
_GRP = "CASE WHEN {e} IN ('happy', 'surprise') THEN 'p' WHEN {e} = 'neutral' THEN 'n' WHEN {e} IN ('sad', 'angry', 'fear', 'disgust') THEN 'm' END"
query("prj_emotions_align", sql(f"SELECT video_id, ord, {_GRP.format(e='emotion')} IS NOT DISTINCT FROM {_GRP.format(e='nxt')} AS v FROM (SELECT *, lead(emotion) OVER (PARTITION BY video_id ORDER BY ord) AS nxt FROM seg)", "seg"))(
    lambda s, d: mp.segments(s, d).withColumn("nxt", F.lead("emotion").over(Window.partitionBy("video_id").orderBy("ord"))).select("video_id", "ord", tx.emotions_align(F.col("emotion"), F.col("nxt")).alias("v"))
)
query("prj_suggest_config", sql("SELECT ord, CASE WHEN confidence < 0.1 THEN 'dark' WHEN x1 > 350 OR ord % 50 > 30 THEN 'action' WHEN ord % 50 < 5 THEN 'dialogue' WHEN ord % 11 > 5 THEN 'crowd' ELSE 'default' END AS v FROM det", "det"))(lambda s, d: mp.detections(s, d).select("ord", ql.suggested_config(F.col("confidence") * 3, F.col("box.x1") / 500, F.col("ord") % 50, F.col("ord") % 11).alias("v")))
query("prj_whisper_model", sql("SELECT video_id, CASE WHEN duration < 300 THEN 'base' WHEN duration < 1800 THEN 'small' ELSE 'base' END AS v FROM vid", "vid"))(lambda s, d: mp.videos(s, d).select("video_id", ql.speech_model(F.col("duration")).alias("v")))
query("prj_window_ext", sql("SELECT video_id, CASE WHEN r < 1 THEN 60 WHEN r < 5 THEN 30 WHEN r < 10 THEN 10 ELSE 5 END::INTEGER AS v FROM (SELECT video_id, segments / (duration / 60) AS r FROM vid)", "vid"))(lambda s, d: mp.videos(s, d).select("video_id", ql.match_window(F.col("segments") / (F.col("duration") / 60)).alias("v")))
query("prj_coverage_targets", sql("SELECT video_id, CASE WHEN dense THEN 0.6 ELSE 0.7 END::DOUBLE AS target, CASE WHEN dense THEN greatest(50, segments * 2) ELSE greatest(100, segments * 3) END::BIGINT AS frames FROM (SELECT *, segments / (duration / 6000) > 20 AS dense FROM vid)", "vid"))(lambda s, d: _targets(s, d))


def _targets(spark, sf):
    target, frames = ql.coverage_targets(F.col("segments"), F.col("duration") / 6000)
    return mp.videos(spark, sf).select("video_id", target.alias("target"), frames.alias("frames"))


query("prj_calibrate", sql("""SELECT video_id, CASE WHEN c < 1 THEN 0.9 WHEN c > 10 THEN 1.2 ELSE 1.0 END::DOUBLE AS confidence_scale, CASE WHEN e > 20 THEN 10 WHEN e < 5 THEN 60 ELSE 30 END::DOUBLE AS "window",
  CASE WHEN duration > 600 THEN 0.3 ELSE 0.1 END::DOUBLE AS continuity_weight FROM (SELECT *, words / duration * 60 / 10 AS c, segments / duration * 600 AS e FROM vid)""", "vid"))(lambda s, d: ql.calibration(mp.videos(s, d).withColumns({"character_density": F.col("words") / F.col("duration") * 60 / 10, "dialogue_density": F.col("segments") / F.col("duration") * 600})).select("video_id", "confidence_scale", "window", "continuity_weight"))  # fmt: skip
query("prj_face_quality", sql("SELECT ord, round(confidence * (1 - (x1 / 50 + y1 / 50 + 1) / 270) * (0.5 + 0.5 * least((x2 - x1) / 112, 1.0)), 9) AS v FROM det", "det"))(lambda s, d: mp.detections(s, d).select("ord", F.round(ql.face_quality(F.col("confidence"), (F.col("box.x1") / 50, -F.col("box.y1") / 50, F.lit(1.0)), F.col("box.x2") - F.col("box.x1")), 9).alias("v")))
query("prj_face_assess", sql("SELECT ord, round(confidence * 0.3 + x1 / 500 * 0.3 + y1 / 350 * 0.2 + 0.1, 6) AS v FROM det", "det"))(lambda s, d: mp.detections(s, d).select("ord", F.round(ql.face_assessment(F.col("confidence"), F.col("box.x1") / 500, F.col("box.y1") / 350, F.lit(0.5)), 6).alias("v")))
query("prj_frame_quality", sql("SELECT ord, round(confidence * 0.4 + x1 / 500 * 0.2 + y1 / 350 * 0.2 + 0.1, 6) AS a, round(confidence * 0.5 + x1 / 500 * 0.3 + y1 / 350 * 0.2, 6) AS b FROM det", "det"))(lambda s, d: mp.detections(s, d).select("ord", F.round(ql.frame_quality(F.col("confidence"), F.col("box.x1") / 500, F.col("box.y1") / 350, F.lit(0.5)), 6).alias("a"), F.round(ql.frame_quality(F.col("confidence"), F.col("box.x1") / 500, F.col("box.y1") / 350), 6).alias("b")))
query("prj_region", sql("SELECT ord, round(greatest(0, x1 - (x2 - x1) * 0.2), 6) AS a, round(greatest(0, y1 - (y2 - y1) * 0.2), 6) AS b, round(least(640, x2 + (x2 - x1) * 0.2), 6) AS c, round(least(480, y2 + (y2 - y1) * 0.2), 6) AS e FROM det", "det"))(
    lambda s, d: mp.detections(s, d).withColumn("r", ql.region(F.col("box"), 0.2, 640.0, 480.0)).select("ord", F.round("r.x1", 6).alias("a"), F.round("r.y1", 6).alias("b"), F.round("r.x2", 6).alias("c"), F.round("r.y2", 6).alias("e"))
)
query("prj_keyframe_time", sql("SELECT video_id, id, CASE id % 3 WHEN 0 THEN (start + \"end\") / 2 WHEN 1 THEN start + 0.1 ELSE \"end\" - 0.1 END AS v FROM shot", "shot"))(lambda s, d: mp.shots(s, d).select("video_id", "id", ql.keyframe_time(F.col("start"), F.col("end"), F.when(F.col("id") % 3 == 0, "middle").when(F.col("id") % 3 == 1, "first").otherwise("last")).alias("v")))
query("prj_resize", sql("SELECT ord, trunc(x2 * f)::INTEGER AS w, trunc(y2 * f)::INTEGER AS h FROM (SELECT *, least(320.0::DOUBLE / x2, 240.0::DOUBLE / y2, 1.0::DOUBLE) AS f FROM det)", "det"))(lambda s, d: mp.detections(s, d).select("ord", *[c.alias(n) for c, n in zip(ql.resized(F.col("box.x2"), F.col("box.y2"), 320, 240), "wh", strict=True)]))
query("prj_max_scenes", sql("SELECT video_id, id FROM scene WHERE id <= 3", "scene"))(lambda s, d: mp.scenes(s, d).where("id <= 3").select("video_id", "id"))
query("flt_declared_only", sql("SELECT video_id, id FROM scene WHERE \"end\" - start BETWEEN 30 AND 60", "scene"))(lambda s, d: mp.scenes(s, d).where((F.col("end") - F.col("start")).between(30, 60)).select("video_id", "id"))
query("snk_even_width", sql("SELECT ord, (w - w % 2)::INTEGER AS v FROM (SELECT ord, trunc(x2 * 720 / y2)::BIGINT AS w FROM det)", "det"))(lambda s, d: mp.detections(s, d).select("ord", ql.even_width(F.col("box.x2"), F.col("box.y2"), 720).alias("v")))
query("prj_video_recs", sql("SELECT video_id, concat_ws(',', CASE WHEN q < 0.25 THEN 'low quality' END, CASE WHEN n > 60 THEN 'many faces' END) AS v FROM (SELECT video_id, avg(confidence) AS q, count(*) AS n FROM det GROUP BY ALL)", "det"))(lambda s, d: mp.detections(s, d).groupBy("video_id").agg(F.avg("confidence").alias("q"), F.count("*").alias("n")).select("video_id", F.concat_ws(",", F.when(F.col("q") < 0.25, "low quality"), F.when(F.col("n") > 60, "many faces")).alias("v")))
query("flt_emotion_rows", sql("SELECT video_id, ord, CASE WHEN n < 50 THEN 'neutral' ELSE emotion END AS emotion, CASE WHEN n < 50 THEN 0.0 ELSE emotion_confidence END::DOUBLE AS c FROM seg", "seg"))(lambda s, d: mp.segments(s, d).select("video_id", "ord", F.when(F.col("n") < 50, "neutral").otherwise(F.col("emotion")).alias("emotion"), F.when(F.col("n") < 50, 0.0).otherwise(F.col("emotion_confidence")).alias("c")))
query("prj_audio_slice", sql("SELECT video_id, ord, greatest(400, n * 100)::INTEGER AS v FROM seg", "seg"))(lambda s, d: mp.segments(s, d).select("video_id", "ord", F.size(ql.audio_slice(F.transform(F.sequence(F.lit(0), (F.col("n") * 100 - 1).cast("int")), lambda i: i.cast("double")), F.lit(0.0), F.col("n").cast("double"), 100)).alias("v")))

from . import queries_io, queries_joins, queries_media, queries_more  # noqa: E402, F401
