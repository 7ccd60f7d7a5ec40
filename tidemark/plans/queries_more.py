"""Queries of ordered operators, aggregates, top-k, sinks and streaming."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vector as vc
from ..operators import faces as fc
from ..operators import folds as fo
from ..operators import intervals as iv
from ..operators import reports as rp
from ..operators import scoring as sc
from ..operators import sessions as se
from ..operators import tracking as tk
from ..sources import sinks as sk
from . import mapping as mp
from . import registry
from .mapping import sql
from .queries import query
from .queries_io import stored
from .queries_joins import dialogues, spans

_V = ["video_id"]

# ---- ordered and windowed --------------------------------------------------------------

query("win_gap_islands", sql("""f AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > 2.0 THEN 1 ELSE 0 END AS new FROM det WINDOW w AS (PARTITION BY video_id, character_id ORDER BY ts, ord)), g AS (SELECT *, sum(new) OVER (PARTITION BY video_id, character_id ORDER BY ts, ord ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT video_id, character_id, island::BIGINT AS island, min(ts) AS start, max(ts) AS "end", count(*) AS points FROM g GROUP BY ALL""", "det"))(lambda s, d: se.islands(mp.detections(s, d), ["video_id", "character_id"], "ts", 2.0, "ord"))  # fmt: skip
_MERGE = """r AS (SELECT *, max("end") OVER (PARTITION BY {k} ORDER BY start, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {t}), g AS (SELECT *, sum(CASE WHEN start > reach + {tol} THEN 1 ELSE 0 END) OVER (PARTITION BY {k} ORDER BY start, ord ROWS UNBOUNDED PRECEDING) AS part FROM r)
"""
query("win_merge_tol", sql(_MERGE.format(k="video_id, speaker", t="seg", tol="10") + "SELECT video_id, speaker, part::BIGINT AS part, min(start) AS start, max(\"end\") AS \"end\", count(*) AS pieces, string_agg(text, ' ' ORDER BY start, ord) AS text FROM g GROUP BY ALL", "seg"))(lambda s, d: se.merged(mp.segments(s, d), ["video_id", "speaker"], 10.0, "text"))
query("win_merge_spk", sql(_MERGE.format(k="video_id, speaker_id", t="turn", tol="0.5") + "SELECT video_id, speaker_id, part::BIGINT AS part, min(start) AS start, max(\"end\") AS \"end\", count(*) AS pieces FROM g GROUP BY ALL", "turn"))(lambda s, d: se.merged(mp.turns(s, d), ["video_id", "speaker_id"], 0.5))
_SHORT = """o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY start, id) AS k, lead("end") OVER (PARTITION BY video_id ORDER BY start, id) AS nxt FROM scene),
r AS (SELECT video_id, 1 AS k, 1 AS new FROM o WHERE k = 1 UNION ALL SELECT r.video_id, r.k + CASE WHEN o."end" - o.start < 45 AND o.nxt IS NOT NULL THEN 2 ELSE 1 END, r.new + 1 FROM r JOIN o ON o.video_id = r.video_id AND o.k = r.k)
SELECT o.video_id, r.new::BIGINT AS id, o.start, CASE WHEN o."end" - o.start < 45 AND o.nxt IS NOT NULL THEN o.nxt ELSE o."end" END AS "end" FROM r JOIN o ON o.video_id = r.video_id AND o.k = r.k"""
query("win_merge_short", sql(_SHORT, "scene").replace("WITH ", "WITH RECURSIVE ", 1))(lambda s, d: fo.short_merged(mp.scenes(s, d), 45.0))
query("win_transitions", sql("SELECT video_id, start FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY start) AS k FROM scene) WHERE k > 1", "scene"))(lambda s, d: mp.scenes(s, d).withColumn("k", F.row_number().over(Window.partitionBy("video_id").orderBy("start"))).where("k > 1").select("video_id", "start"))
query("win_validate_seq", sql("SELECT video_id, ord, concat_ws(',', CASE WHEN start >= \"end\" THEN 'empty span' END, CASE WHEN start < lag(\"end\") OVER (PARTITION BY video_id ORDER BY ord) THEN 'overlaps previous' END) AS v FROM turn", "turn"))(lambda s, d: se.sequence_errors(mp.turns(s, d), _V).select("video_id", "ord", F.array_join("errors", ",").alias("v")))
query("win_turns", sql("SELECT a AS from_label, b AS to_label, count(*) AS times FROM (SELECT speaker_id AS a, lead(speaker_id) OVER (PARTITION BY video_id ORDER BY start, ord) AS b FROM turn) WHERE a <> b GROUP BY ALL", "turn"))(lambda s, d: se.transitions(mp.turns(s, d), _V, "speaker_id", True, "start", "ord"))
query("win_silence", sql("SELECT video_id, sum(greatest(g, 0)) AS silence, sum(greatest(-g, 0)) AS overlap FROM (SELECT video_id, lead(start) OVER (PARTITION BY video_id ORDER BY start, ord) - \"end\" AS g FROM turn) WHERE g IS NOT NULL GROUP BY ALL", "turn"))(lambda s, d: se.with_gaps(mp.turns(s, d), _V).where("gap is not null").groupBy("video_id").agg(F.sum(F.greatest("gap", F.lit(0.0))).alias("silence"), F.sum(F.greatest(-F.col("gap"), F.lit(0.0))).alias("overlap")))
query("win_emotion_trans", sql("SELECT a AS from_label, b AS to_label, count(*) AS times FROM (SELECT emotion AS a, lead(emotion) OVER (PARTITION BY video_id ORDER BY ord) AS b FROM seg) WHERE b IS NOT NULL GROUP BY ALL ORDER BY times DESC, a, b LIMIT 5", "seg"))(lambda s, d: se.transitions(mp.segments(s, d), _V, "emotion", False, "ord").orderBy(F.desc("times"), "from_label", "to_label").limit(5))
query("win_gaps5", sql("SELECT video_id, ord, g AS gap FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ord) AS k FROM (SELECT video_id, ord, start - lag(\"end\") OVER (PARTITION BY video_id ORDER BY ord) AS g FROM turn) WHERE g > 3) WHERE k <= 5", "turn"))(lambda s, d: _gaps5(s, d))


def _gaps5(spark, sf):
    w = Window.partitionBy("video_id").orderBy("ord")
    return mp.turns(spark, sf).withColumn("gap", F.col("start") - F.lag("end").over(w)).where("gap > 3").withColumn("k", F.row_number().over(w)).where("k <= 5").select("video_id", "ord", "gap")


query("win_temporal_gaps", sql("""g AS (SELECT video_id, ts AS a, lead(ts) OVER (PARTITION BY video_id ORDER BY ts, ord) AS b FROM det), h AS (SELECT DISTINCT g.* FROM g JOIN seg s ON s.video_id = g.video_id AND (s.start BETWEEN a AND b OR s."end" BETWEEN a AND b) WHERE b - a > 8)
SELECT video_id, a + 1 AS a, b - 1 AS b FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY a) AS k FROM h) WHERE k <= 5""", "seg", "det"))(lambda s, d: _frame_gaps(s, d))  # fmt: skip


def _frame_gaps(spark, sf):
    w = Window.partitionBy("video_id")
    gaps = mp.detections(spark, sf).select("video_id", F.col("ts").alias("a"), F.lead("ts").over(w.orderBy("ts", "ord")).alias("b")).where("b - a > 8")
    marks = mp.segments(spark, sf).select("video_id", F.explode(F.array("start", "end")).alias("at"))
    hit = iv.point_join(marks, gaps, "at", ("a", "b"), 30.0).select("video_id", "a", "b").distinct()
    return hit.withColumn("k", F.row_number().over(w.orderBy("a"))).where("k <= 5").select("video_id", (F.col("a") + 1).alias("a"), (F.col("b") - 1).alias("b"))


def _scored(spark, sf):
    return mp.segments(spark, sf).select("video_id", "ord", F.col("speaker").alias("character_id"), F.col("confidence").alias("score"))


query("win_smooth")(lambda s, d: fo.smoothed_in_place(_scored(s, d)))
query("win_smooth_plain", sql("SELECT a.video_id, a.ord, round(CASE WHEN count(b.ord) > 0 THEN 0.7 * a.confidence + 0.3 * avg(b.confidence) ELSE a.confidence END, 6) AS v FROM seg a LEFT JOIN seg b ON b.video_id = a.video_id AND b.speaker = a.speaker AND b.ord <> a.ord AND abs(b.ord - a.ord) <= 3 GROUP BY a.video_id, a.ord, a.confidence", "seg"))(lambda s, d: se.smoothed(_scored(s, d), _V, "character_id", "score", "ord").select("video_id", "ord", F.round("smooth", 6).alias("v")))
query("win_resolve", sql("""w AS (SELECT *, lag("end") OVER w AS pe, lag(confidence) OVER w AS ps, lead(start) OVER w AS ns, lead(confidence) OVER w AS nq FROM turn WINDOW w AS (PARTITION BY video_id ORDER BY start, ord))
SELECT video_id, ord FROM w WHERE NOT coalesce(start < pe AND confidence <= ps, false) AND NOT coalesce(ns < "end" AND nq > confidence, false)""", "turn"))(lambda s, d: se.resolved(mp.turns(s, d), _V, "confidence").select("video_id", "ord"))  # fmt: skip


query("win_assoc", sql("SELECT video_id, round(list_reduce(list(confidence ORDER BY ord), lambda a, x: (a + x) / 2), 6) AS v FROM seg GROUP BY video_id", "seg"))(
    lambda s, d: mp.segments(s, d).groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "confidence"))), lambda x: x["confidence"]).alias("l")).select("video_id", F.round(F.aggregate(F.slice("l", F.lit(2), F.greatest(F.size("l") - 1, F.lit(0))), F.get("l", F.lit(0)), lambda a, x: (a + x) / 2), 6).alias("v"))
)
query("win_profiles", sql("SELECT video_id, character_id, count(*) AS n, round(avg((x1 + x2) / 2), 6) AS cx, round(avg((y1 + y2) / 2), 6) AS cy FROM det GROUP BY ALL", "det"))(lambda s, d: mp.detections(s, d).groupBy("video_id", "character_id").agg(F.count("*").alias("n"), F.round(F.avg((F.col("box.x1") + F.col("box.x2")) / 2), 6).alias("cx"), F.round(F.avg((F.col("box.y1") + F.col("box.y2")) / 2), 6).alias("cy")))
query("win_prior_summary", sql("SELECT video_id, ord, lag('Scene ' || ord || ': ' || left(text, 100) || '...', 1, 'The story begins.') OVER (PARTITION BY video_id ORDER BY ord) AS v FROM seg", "seg"))(lambda s, d: mp.segments(s, d).select("video_id", "ord", F.lag(F.concat(F.lit("Scene "), F.col("ord").cast("string"), F.lit(": "), F.left("text", F.lit(100)), F.lit("...")), 1, "The story begins.").over(Window.partitionBy("video_id").orderBy("ord")).alias("v")))
query("win_context_chain", sql("SELECT video_id, ord AS scene_id, speaker || ' in a scene described from ' || CASE WHEN ord = min(ord) OVER (PARTITION BY video_id) THEN 6 ELSE 11 END || ' words.' AS caption, NULL::VARCHAR AS error FROM seg", "seg"))(lambda s, d: fo.chained_captions(mp.segments(s, d).select("video_id", F.col("ord").alias("scene_id"), F.concat(F.lit("Characters: "), "speaker", F.lit("\nBefore: {before}")).alias("prompt")), registry.mock_model()))
query("win_lip_hist", sql("SELECT ord, round(avg(confidence) OVER w, 9) AS m, round(stddev_pop(confidence) OVER w, 9) AS sd FROM det WINDOW w AS (PARTITION BY video_id, character_id ORDER BY ts, ord ROWS 14 PRECEDING)", "det"))(lambda s, d: _lip(s, d))


def _lip(spark, sf):
    w = Window.partitionBy("video_id", "character_id").orderBy("ts", "ord").rowsBetween(-14, 0)
    return mp.detections(spark, sf).select("ord", F.round(F.avg("confidence").over(w), 9).alias("m"), F.round(F.stddev_pop("confidence").over(w), 9).alias("sd"))


def _mouths(spark, sf):
    """Lip rows of each face: how far the mouth is open by the confidence, how far it moved by the box."""
    k = F.col("ord")
    return mp.detections(spark, sf).select("video_id", "character_id", "ts", F.floor(F.col("decis") / 40).alias("frame"), "ord", F.col("confidence").alias("mar"), (F.pmod(k * 29, F.lit(100)) / 400.0).alias("movement"))


query("win_lip_decisions")(lambda s, d: fc.lip_decisions(_mouths(s, d)).select("video_id", "character_id", "ord", "mar_mean", "mar_std", "movement_mean", "regular", "score", "speaking"))
query("win_lip_score", sql("""h AS (SELECT ord, avg(confidence) OVER w AS m, stddev_pop(confidence) OVER w AS sd, avg(((ord * 29) % 100) / 400.0::DOUBLE) OVER w AS mv, count(*) OVER w AS n, first(ts) OVER w AS since FROM det WINDOW w AS (PARTITION BY video_id, character_id ORDER BY ts, ord ROWS 14 PRECEDING))
SELECT ord, since, CASE WHEN n < 3 THEN 0 ELSE round(CASE WHEN sd > 0.02 THEN 0.3 ELSE 0 END + CASE WHEN m > 0.15 THEN 0.2 ELSE 0 END + CASE WHEN mv > 0.1 THEN 0.3 ELSE 0 END, 6) END::DOUBLE AS steady FROM h""", "det"))(
    lambda s, d: fc.lip_decisions(_mouths(s, d)).select("ord", "since", F.round(F.greatest(F.col("score") - F.when(F.col("regular"), 0.2).otherwise(0.0), F.lit(0.0)), 6).alias("steady"))
)
query("win_speaking_now")(lambda s, d: fc.active_speakers(fc.lip_decisions(_mouths(s, d))))
query("win_peaks")(lambda s, d: fo.regular_peaks(mp.detections(s, d), "confidence"))
query("win_audio_corr", sql("SELECT character_id, round((corr(confidence, x1) + 1) / 2, 6) AS v FROM det GROUP BY ALL", "det"))(lambda s, d: mp.detections(s, d).groupBy("character_id").agg(F.round(F.coalesce((F.corr("confidence", "box.x1") + 1) / 2, F.lit(0.0)), 6).alias("v")))
query("win_active_speaker", sql("SELECT video_id, character_id, n FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, character_id) AS k FROM (SELECT video_id, character_id, count(*) AS n FROM det WHERE confidence > 0.2 GROUP BY ALL)) WHERE k = 1", "det"))(lambda s, d: iv.first_by(mp.detections(s, d).where("confidence > 0.2").groupBy("video_id", "character_id").agg(F.count("*").alias("n")), _V, F.desc("n"), "character_id"))


def _frames(spark, sf):
    return mp.detections(spark, sf).select("video_id", F.floor(F.col("decis") / 40).alias("frame"), "ord", "box")


query("win_sort")(lambda s, d: tk.tracked(_frames(s, d)))
_MIX = "list_transform(list_zip(a, x), lambda z: z[1] * 0.7 + z[2] * 0.3)"
query("win_ema_emb", f"SELECT label, round(list_reduce(list(embedding::DOUBLE[] ORDER BY vec_id), lambda a, x: list_transform({_MIX}, lambda y: y / sqrt(list_inner_product({_MIX}, {_MIX}))))[1], 6) AS v FROM embeddings GROUP BY label")(lambda s, d: mp.table(s, d, "embeddings").groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))), lambda x: x["embedding"]).alias("l")).select("label", F.round(F.get(vc.ema(F.col("l")), F.lit(0)), 6).alias("v")))
query("win_batch_scenes", sql("SELECT video_id, (row_number() OVER (PARTITION BY video_id ORDER BY id) - 1) // 2 + 1 AS batch, id FROM shot", "shot"))(lambda s, d: se.batches(mp.shots(s, d), _V, 2, "id").select("video_id", "batch", "id"))
query("win_individual", sql("SELECT video_id, id AS scene_id, start, \"end\", 'Shot ' || id AS summary FROM shot", "shot"))(lambda s, d: mp.shots(s, d).select("video_id", F.col("id").alias("scene_id"), "start", "end", F.concat(F.lit("Shot "), F.col("id").cast("string")).alias("summary")))
query("win_renumber", sql("SELECT video_id, id, row_number() OVER (PARTITION BY video_id ORDER BY CASE WHEN id % 4 = 0 THEN 0 ELSE start END, id)::INTEGER AS new_id FROM shot", "shot"))(lambda s, d: se.renumbered(mp.shots(s, d).withColumn("start", F.when(F.col("id") % 4 != 0, F.col("start"))), _V, "start", "id").select("video_id", "id", "new_id"))
query("win_boundary_filter", sql("""o AS (SELECT video_id, list(ts ORDER BY ts) AS l FROM det GROUP BY video_id), f AS (SELECT video_id, list_reduce(l, lambda k, t: CASE WHEN t[1] - k[len(k)] >= 5 THEN list_concat(k, t) ELSE k END) AS k FROM (SELECT video_id, list_transform(l, lambda t: [t]) AS l FROM o))
SELECT video_id, unnest(k) AS ts FROM f""", "det"))(lambda s, d: se.boundaries_kept(mp.detections(s, d), _V, "ts", 5.0))  # fmt: skip
query("win_bounds_to_shots", sql('SELECT video_id, start, coalesce(lead(start) OVER (PARTITION BY video_id ORDER BY start), duration) AS "end" FROM seg JOIN vid USING (video_id)', "seg", "vid"))(lambda s, d: se.boundaries_to_spans(mp.segments(s, d).select("video_id", F.col("start").alias("b")).join(mp.videos(s, d).select("video_id", "duration"), "video_id"), _V, "b", F.col("duration")).select("video_id", "start", "end"))
_DENS = """g AS (SELECT video_id, unnest(range(0, floor(duration * 10)::BIGINT + 1)) AS k FROM vid), i AS (SELECT video_id, start - 2 AS a, "end" + 2 AS b, CASE WHEN emotion <> 'neutral' THEN 1.5 ELSE 1.0 END AS imp FROM seg),
r AS (SELECT g.video_id, g.k, round(100000 * coalesce(max(imp), 1.0))::BIGINT AS d FROM g LEFT JOIN i ON i.video_id = g.video_id AND g.k / 10.0::DOUBLE BETWEEN a AND b GROUP BY ALL), c AS (SELECT *, sum(d) OVER (PARTITION BY video_id ORDER BY k)::BIGINT AS cum FROM r)
"""
query("win_density_sched", sql(_DENS + "SELECT video_id, k / 10.0::DOUBLE AS t FROM c WHERE cum // 1000000 > (cum - d) // 1000000", "seg", "vid"))(lambda s, d: se.density_schedule(mp.videos(s, d), _important(s, d), 1.0))


def _important(spark, sf):
    return mp.segments(spark, sf).select("video_id", "start", "end", F.when(F.col("emotion") != "neutral", 1.5).otherwise(1.0).alias("importance"))


query("win_strategy", sql("SELECT video_id, min(p) AS strategy FROM (SELECT video_id, count(*) FILTER (confidence >= 0.3) AS a, count(*) FILTER (confidence >= 0.1) AS b FROM det GROUP BY ALL) t, LATERAL (SELECT CASE WHEN a >= 20 THEN 1 WHEN b >= 40 THEN 2 ELSE 3 END AS p) GROUP BY ALL", "det"))(
    lambda s, d: mp.detections(s, d).groupBy("video_id").agg(F.count_if(F.col("confidence") >= 0.3).alias("a"), F.count_if(F.col("confidence") >= 0.1).alias("b")).select("video_id", F.when(F.col("a") >= 20, 1).when(F.col("b") >= 40, 2).otherwise(3).alias("strategy"))
)
query("win_linspace_cap", sql("""n AS (SELECT video_id, ord, row_number() OVER (PARTITION BY video_id ORDER BY ord) - 1 AS i, count(*) OVER (PARTITION BY video_id) AS n FROM det), x AS (SELECT DISTINCT video_id, j * (n - 1) // 19 AS i FROM (SELECT DISTINCT video_id, n FROM n), range(20) t(j))
SELECT n.video_id, n.ord FROM n WHERE n.n <= 20 OR EXISTS (SELECT 1 FROM x WHERE x.video_id = n.video_id AND x.i = n.i)""", "det"))(lambda s, d: se.linspace_capped(mp.detections(s, d), _V, 20, "ord").select("video_id", "ord"))  # fmt: skip
query("win_select_best", sql("""k AS (SELECT video_id, ord, ts, row_number() OVER (PARTITION BY video_id ORDER BY confidence DESC, ord) AS q FROM det), a AS (SELECT * FROM k WHERE q <= 10), b AS (SELECT video_id, ord, ts FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ts, ord) - 1 AS j FROM k WHERE q > 10) WHERE j % 10 = 0)
SELECT video_id, ord FROM a UNION ALL SELECT video_id, ord FROM b""", "det"))(lambda s, d: _select_best(s, d))  # fmt: skip


def _select_best(spark, sf):
    ranked = mp.detections(spark, sf).withColumn("q", F.row_number().over(Window.partitionBy("video_id").orderBy(F.desc("confidence"), "ord")))
    return ranked.where("q <= 10").select("video_id", "ord").unionByName(se.every(ranked.where("q > 10"), _V, 10, "ts", "ord").select("video_id", "ord"))


query("win_best_around", sql("""m AS (SELECT *, max(confidence) OVER w AS m, list(struct_pack(c := confidence, o := ord)) OVER w AS l FROM det WINDOW w AS (PARTITION BY video_id ORDER BY ord ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING))
SELECT ord, list_min(list_transform(list_filter(l, lambda x: x.c = m), lambda x: x.o)) AS best FROM m WHERE ord % 7 = 0 AND m > 0""", "det"))(lambda s, d: _best_around(s, d))  # fmt: skip


def _best_around(spark, sf):
    w = Window.partitionBy("video_id").orderBy("ord").rowsBetween(-5, 5)
    return mp.detections(spark, sf).withColumn("m", F.max(F.struct("confidence", (-F.col("ord")).alias("o"))).over(w)).where("ord % 7 = 0 and m.confidence > 0").select("ord", (-F.col("m.o")).alias("best"))


query("win_gap_fill", sql("SELECT video_id, id, round(start + (\"end\" - start) * j / 4, 6) AS t FROM scene, range(5) t(j)", "scene"))(lambda s, d: mp.scenes(s, d).select("video_id", "id", "start", "end", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("j")).select("video_id", "id", F.round(F.col("start") + (F.col("end") - F.col("start")) * F.col("j") / 4, 6).alias("t")))
query("win_random_scenes", sql("SELECT video_id, round(t + ((video_id * 7919 + t * 104729) % 2000) / 1000.0::DOUBLE - 1, 3) AS t FROM (SELECT video_id, unnest(range(5, greatest(5, trunc(duration)::BIGINT) + 1, 5)) AS t FROM vid)", "vid"))(lambda s, d: mp.videos(s, d).select("video_id", F.explode(F.sequence(F.lit(5), F.greatest(F.lit(5), F.col("duration").cast("int")), F.lit(5))).alias("t")).select("video_id", F.round(F.col("t") + F.pmod(F.col("video_id") * 7919 + F.col("t") * 104729, F.lit(2000)) / 1000 - 1, 3).alias("t")))
query("win_chunks", sql("SELECT video_id, unnest(range(0, greatest(duration::BIGINT - 10, 0) + 1, 1)) AS c FROM vid", "vid"))(lambda s, d: mp.videos(s, d).select("video_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("duration").cast("bigint") - 10, F.lit(0).cast("bigint")))).alias("c")))
query("lim_shots", sql("SELECT video_id, id FROM shot WHERE id <= 10", "shot"))(lambda s, d: mp.shots(s, d).withColumn("k", F.row_number().over(Window.partitionBy("video_id").orderBy("id"))).where("k <= 10").select("video_id", "id"))

# ---- aggregates ------------------------------------------------------------------------

query("agg_speaker_stats", sql('SELECT video_id, speaker_id, sum("end" - start) AS seconds, count(*) AS turns, round(sum("end" - start) * 100 / any_value(duration), 6) AS percent FROM turn JOIN vid USING (video_id) GROUP BY ALL', "turn", "vid"))(lambda s, d: rp.speaker_stats(mp.turns(s, d), mp.videos(s, d)).withColumn("percent", F.round("percent", 6)))


def flagship(spark, sf):
    """Each speaker's share of the time of the dialogues that its turns overlap best."""
    best = iv.best_overlap(dialogues(spark, sf), spans(spark, sf), "segment_id")
    return best.groupBy("video_id", "speaker_id").agg(F.sum(F.col("end") - F.col("start")).alias("seconds"), F.count("*").alias("lines"))


query("best_overlap_share", sql("""p AS (SELECT s.video_id, s.segment_id, s."end" - s.start AS len, t.speaker_id, t.ord AS tord, greatest(0, least(s."end", t."end") - greatest(s.start, t.start)) / nullif(s."end" - s.start, 0) AS ratio FROM seg s JOIN turn t ON s.video_id = t.video_id),
b AS (SELECT *, row_number() OVER (PARTITION BY video_id, segment_id ORDER BY ratio DESC, tord) AS k FROM p WHERE ratio > 0) SELECT s.video_id, b.speaker_id, sum(s."end" - s.start) AS seconds, count(*) AS lines FROM seg s LEFT JOIN b ON b.video_id = s.video_id AND b.segment_id = s.segment_id AND b.k = 1 GROUP BY ALL""", "turn"))(flagship)  # fmt: skip
query("agg_match_summary", sql("SELECT video_id, count(*) AS total, count(*) FILTER (n > 60) AS matched, round(count(*) FILTER (n > 60) / count(*), 6) AS rate, count(*) FILTER (n > 60 AND confidence >= 0.8) AS high, count(*) FILTER (n > 60 AND confidence >= 0.5 AND confidence < 0.8) AS medium, count(*) FILTER (n > 60 AND confidence < 0.5) AS low, round(avg(confidence) FILTER (n > 60), 6) AS mean FROM seg GROUP BY ALL", "seg"))(
    lambda s, d: rp.match_summary(mp.segments(s, d).select("video_id", F.when(F.col("n") > 60, F.col("speaker")).alias("character_id"), F.when(F.col("n") > 60, F.col("confidence")).alias("final"))).withColumns({"rate": F.round("rate", 6), "mean": F.round("mean", 6)})
)
query("agg_context", sql("SELECT video_id, round(duration / segments, 6) AS mean, round(segments / (duration / 60), 6) AS density FROM vid", "vid"))(lambda s, d: mp.videos(s, d).select("video_id", F.round(F.try_divide(F.col("duration"), F.col("segments")), 6).alias("mean"), F.round(F.coalesce(F.try_divide(F.col("segments"), F.col("duration") / 60), F.lit(0.0)), 6).alias("density")))
query("agg_coverage_bins", sql("SELECT video_id, round(count(DISTINCT floor(ts)) / (trunc(any_value(duration)) + 1), 6) AS coverage FROM det JOIN vid USING (video_id) GROUP BY ALL", "det", "vid"))(lambda s, d: rp.coverage_bins(mp.detections(s, d), mp.videos(s, d)).withColumn("coverage", F.round("coverage", 6)))
query("agg_dialogue_cov", sql('SELECT s.video_id, round(count(*) FILTER (EXISTS (SELECT 1 FROM det d WHERE d.video_id = s.video_id AND d.ts BETWEEN s.start - 2 AND s."end" + 2)) / count(*), 6) AS v FROM seg s GROUP BY ALL', "seg", "det"))(lambda s, d: _dialogue_cov(s, d))


def _dialogue_cov(spark, sf):
    wide = mp.segments(spark, sf).select("video_id", "ord", (F.col("start") - 2).alias("a"), (F.col("end") + 2).alias("b"))
    hit = iv.interval_join(wide, mp.detections(spark, sf).select("video_id", "ts"), _V, ("a", "b"), ("ts", "ts"), 60.0).select("video_id", "ord").distinct().withColumn("hit", F.lit(1))
    return wide.join(hit, ["video_id", "ord"], "left").groupBy("video_id").agg(F.round(F.count("hit") / F.count("*"), 6).alias("v"))


query("agg_coverage_stats", sql('SELECT video_id, count(*) AS segments, round(sum(greatest(0, "end" - start)), 2) AS covered, round(avg(greatest(0, "end" - start)), 2) AS mean, round(sum(greatest(0, "end" - start)) * 100 / any_value(duration), 2) AS percent FROM turn JOIN vid USING (video_id) GROUP BY ALL', "turn", "vid"))(lambda s, d: rp.coverage_stats(mp.turns(s, d), mp.videos(s, d)))
query("agg_caption_report", sql("SELECT video_id, count(*) AS total, count(*) FILTER (n > 50) AS good, round(count(*) FILTER (n > 50) * 100.0 / count(*), 6) AS pct, count(DISTINCT speaker) AS who FROM seg GROUP BY ALL", "seg"))(lambda s, d: mp.segments(s, d).groupBy("video_id").agg(F.count("*").alias("total"), F.count_if(F.col("n") > 50).alias("good"), F.round(F.try_divide(F.count_if(F.col("n") > 50) * 100.0, F.count("*")), 6).alias("pct"), F.count_distinct("speaker").alias("who")))
_QUAL = """w AS (SELECT text, lower(text) AS low, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''))::INTEGER AS n FROM conversations)
SELECT count(*) AS n, round(avg(n), 6) AS mean_words, median(n)::DOUBLE AS median_words, min(n) AS min_words, max(n) AS max_words, round(avg(length(text)), 6) AS mean_chars, round(count(*) FILTER (contains(text, '"')) * 100.0 / count(*), 6) AS quote_pct,
round(count(*) FILTER (regexp_matches(low, 'happy|sad|angry|fear|surprise|disgust')) * 100.0 / count(*), 6) AS emotion_pct, round(count(*) FILTER (regexp_matches(low, 'then|while|after')) * 100.0 / count(*), 6) AS transition_pct, sum(greatest(1, len(regexp_extract_all(text, '[.!?]+'))))::BIGINT AS sentences FROM w"""
query("agg_caption_quality", "WITH " + _QUAL)(lambda s, d: rp.caption_quality(mp.table(s, d, "conversations")))
query("agg_compare_report", "WITH a AS (SELECT avg(length(text)) FILTER (turn % 2 = 0) AS x, avg(length(text)) FILTER (turn % 2 = 1) AS y FROM conversations) SELECT round((y - x) * 100 / x, 6) AS pct FROM a")(lambda s, d: mp.table(s, d, "conversations").agg(F.avg(F.when(F.col("turn") % 2 == 0, F.length("text"))).alias("x"), F.avg(F.when(F.col("turn") % 2 == 1, F.length("text"))).alias("y")).select(F.round(F.try_divide((F.col("y") - F.col("x")) * 100, F.col("x")), 6).alias("pct")))
query("agg_emotion_dist", sql("SELECT emotion, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct, round(avg(emotion_confidence), 6) AS mean FROM seg GROUP BY emotion", "seg"))(lambda s, d: mp.segments(s, d).groupBy("emotion").agg(F.count("*").alias("n"), F.round(F.avg("emotion_confidence"), 6).alias("mean")).withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6)))
for _how, _val in (("mean", "sum(confidence) / any_value(n)"), ("max", "max(confidence)"), ("weighted", "sum(confidence * confidence) / nullif(sum(confidence), 0)")):
    query("agg_emotion_chunk" + ("" if _how == "mean" else "_" + _how), sql(f"""c AS (SELECT video_id, character_id, emotion, {_val} AS v FROM (SELECT *, count(*) OVER (PARTITION BY video_id, character_id) AS n FROM det) GROUP BY video_id, character_id, emotion),
r AS (SELECT *, row_number() OVER (PARTITION BY video_id, character_id ORDER BY v DESC, list_position(['neutral', 'happy', 'sad', 'angry', 'fear', 'surprise', 'disgust'], emotion)) AS k FROM c)
SELECT video_id, character_id, CASE WHEN v < 0.5 THEN 'neutral' ELSE emotion END AS emotion, round(CASE WHEN v < 0.5 THEN 1 - v ELSE v END, 9) AS confidence FROM r WHERE k = 1""", "det"))(lambda s, d, h=_how: rp.emotion_chunks(mp.detections(s, d), ["video_id", "character_id"], h).withColumn("confidence", F.round("confidence", 9)))  # fmt: skip
query("agg_transcript", sql('SELECT video_id, count(*) AS segments, sum(n)::BIGINT AS words, round(sum(n) / (max("end") / 60), 6) AS wpm, round(avg(confidence), 6) AS mean, count(*) FILTER (confidence < 0.3) AS low FROM seg GROUP BY ALL', "seg"))(lambda s, d: mp.segments(s, d).groupBy("video_id").agg(F.count("*").alias("segments"), F.sum("n").alias("words"), F.round(F.try_divide(F.sum("n"), F.max("end") / 60), 6).alias("wpm"), F.round(F.avg("confidence"), 6).alias("mean"), F.count_if(F.col("confidence") < 0.3).alias("low")))
query("agg_word_freq", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '\\s+')) AS word FROM conversations) WHERE length(word) > 2 AND word NOT IN ('" + "', '".join(tx.STOPWORDS) + "') GROUP BY word ORDER BY n DESC, word LIMIT 20")(lambda s, d: rp.word_frequency(mp.table(s, d, "conversations"), "text"))
query("agg_shot_stats", sql("SELECT CASE WHEN l < 2 THEN '0-2' WHEN l < 5 THEN '2-5' WHEN l < 10 THEN '5-10' WHEN l < 20 THEN '10-20' ELSE '20+' END AS bucket, count(*) AS n, round(avg(l), 6) AS mean FROM (SELECT \"end\" - start AS l FROM shot) GROUP BY ALL", "shot"))(lambda s, d: mp.shots(s, d).withColumn("l", F.col("end") - F.col("start")).groupBy(rp.duration_bucket(F.col("l")).alias("bucket")).agg(F.count("*").alias("n"), F.round(F.avg("l"), 6).alias("mean")))
query("agg_scene_log", sql('SELECT video_id, count(*) AS n, round(avg("end" - start), 6) AS mean, min("end" - start) AS low, max("end" - start) AS high FROM scene GROUP BY ALL', "scene"))(lambda s, d: mp.scenes(s, d).withColumn("l", F.col("end") - F.col("start")).groupBy("video_id").agg(F.count("*").alias("n"), F.round(F.avg("l"), 6).alias("mean"), F.min("l").alias("low"), F.max("l").alias("high")))
query("agg_attr", sql("""s AS (SELECT character_id, round(avg(confidence), 9) AS mean, round(median(confidence), 9) AS median, round(stddev_pop(confidence), 9) AS std, min(confidence) AS low, max(confidence) AS high FROM det GROUP BY ALL), t AS (SELECT character_id, emotion, count(*) AS n, row_number() OVER (PARTITION BY character_id ORDER BY count(*) DESC, emotion) AS k FROM det GROUP BY character_id, emotion)
SELECT s.*, t.emotion AS dominant, t.n AS dominant_n FROM s JOIN t USING (character_id) WHERE k = 1""", "det"))(lambda s, d: rp.attributes(mp.detections(s, d)).withColumns({c: F.round(c, 9) for c in ("mean", "median", "std")}))  # fmt: skip
def _analyses(spark, sf):
    """Face analyses: age, gender and race by the row's number, emotions by the confidence of one and the rest of another."""
    k, c = F.col("ord"), F.col("confidence")
    return mp.detections(spark, sf).select(
        "character_id", (F.pmod(k * 31, F.lit(60)) + 18).cast("double").alias("age"), F.when(k % 3 == 0, "woman").otherwise("man").alias("gender"), c.alias("gender_confidence"),
        F.map_from_arrays(F.array("emotion", F.concat(F.col("emotion"), F.lit("_not"))), F.array(c, 0.3 - c)).alias("emotions"), F.create_map(F.concat(F.lit("r"), (k % 4).cast("string")), c).alias("races"),
    )


def _profile_rows(spark, sf):
    """A row for each entry of a profile's maps."""
    p = fc.profiles(_analyses(spark, sf), ["character_id"])
    rows = lambda kind, freq, mean: p.select("character_id", "n", "age_median", "age_min", "age_max", F.round("age_mean", 6).alias("age_mean"), F.round("age_std", 6).alias("age_std"), "dominant_gender", F.lit(kind).alias("kind"), F.explode(kind).alias("name", "v")).select("*", F.round(freq, 6).alias("frequency"), F.round(mean, 6).alias("mean")).drop("v")
    return rows("genders", F.col("v.frequency"), F.col("v.mean")).unionByName(rows("emotions", F.col("v.clear"), F.col("v.mean"))).unionByName(rows("races", F.col("v.frequency"), F.col("v.mean")))


query("agg_attr_maps", sql("""x AS (SELECT character_id, (ord * 31) % 60 + 18 AS age, CASE WHEN ord % 3 = 0 THEN 'woman' ELSE 'man' END AS gender, 'r' || (ord % 4)::VARCHAR AS race, emotion, confidence AS c FROM det),
a AS (SELECT character_id, count(*) AS n, median(age)::DOUBLE AS age_median, min(age)::DOUBLE AS age_min, max(age)::DOUBLE AS age_max, round(avg(age), 6) AS age_mean, round(stddev_pop(age), 6) AS age_std FROM x GROUP BY ALL),
e AS (SELECT character_id, 'genders' AS kind, gender AS name, c, true AS clear FROM x UNION ALL SELECT character_id, 'emotions', emotion, c, c > 0.1 FROM x UNION ALL SELECT character_id, 'emotions', emotion || '_not', 0.3 - c, 0.3 - c > 0.1 FROM x UNION ALL SELECT character_id, 'races', race, c, true FROM x),
g AS (SELECT character_id, kind, name, count(*) AS k, count(*) FILTER (clear) AS m, avg(c) AS mean FROM e GROUP BY ALL),
t AS (SELECT character_id, name AS dominant_gender FROM (SELECT *, row_number() OVER (PARTITION BY character_id ORDER BY k DESC, name) AS r FROM g WHERE kind = 'genders') WHERE r = 1)
SELECT a.*, dominant_gender, kind, name, round((CASE WHEN kind = 'emotions' THEN m ELSE k END) / n::DOUBLE, 6) AS frequency, round(mean, 6) AS mean FROM a JOIN g USING (character_id) JOIN t USING (character_id)""", "det"))(_profile_rows)  # fmt: skip
query("agg_attr_best", sql("SELECT character_id, ord FROM (SELECT *, row_number() OVER (PARTITION BY character_id ORDER BY confidence DESC, ord) AS k FROM det) WHERE k = 1", "det"))(lambda s, d: iv.first_by(mp.detections(s, d), ["character_id"], F.desc("confidence"), "ord").select("character_id", "ord"))
query("agg_bbox", sql("SELECT video_id, character_id, round(avg((x2 - x1) * (y2 - y1)), 6) AS area FROM det GROUP BY ALL", "det"))(lambda s, d: mp.detections(s, d).groupBy("video_id", "character_id").agg(F.round(F.avg(vc.box_area(F.col("box"))), 6).alias("area")))
query("agg_character", sql("SELECT video_id, character_id, count(*) AS n, min(ts) AS first, max(ts) AS last, max(ts) - min(ts) AS span, count(DISTINCT floor(ts)) AS present FROM det GROUP BY ALL", "det"))(lambda s, d: mp.detections(s, d).groupBy("video_id", "character_id").agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"), (F.max("ts") - F.min("ts")).alias("span"), F.count_distinct(F.floor("ts")).alias("present")))


def _rules():
    return {"times": F.col("end") > F.col("start"), "text": F.trim("text") != "", "score": F.col("confidence").between(0.1, 1)}


_CHECK = "count(*) AS rows, count(*) FILTER (NOT {a}) AS bad_times, count(*) FILTER (NOT {b}) AS bad_text, count(*) FILTER (NOT {c}) AS bad_score, bool_and({a} AND {b} AND {c}) AS valid"
query("agg_validate_a", sql("SELECT video_id, " + _CHECK.format(a='("end" > start)', b="(trim(text) <> '')", c="(confidence BETWEEN 0.1 AND 1)") + " FROM seg GROUP BY ALL", "seg"))(lambda s, d: rp.checks(mp.segments(s, d), _rules()))
query("agg_validate_b", sql('SELECT video_id, count(*) AS rows, count(*) FILTER (NOT "end" > start) AS bad_times, count(*) FILTER (speaker_id NOT IN (\'user\', \'assistant\')) AS bad_speaker, bool_and("end" > start AND speaker_id IN (\'user\', \'assistant\')) AS valid FROM turn GROUP BY ALL', "turn"))(lambda s, d: rp.checks(mp.turns(s, d), {"times": F.col("end") > F.col("start"), "speaker": F.col("speaker_id").isin("user", "assistant")}))
query("agg_validate_c", sql("SELECT video_id, count(*) AS rows, count(*) FILTER (NOT x2 > x1) AS bad_box, count(*) FILTER (NOT confidence >= 0.01) AS bad_score, bool_and(x2 > x1 AND confidence >= 0.01) AS valid FROM det GROUP BY ALL", "det"))(lambda s, d: rp.checks(mp.detections(s, d), {"box": F.col("box.x2") > F.col("box.x1"), "score": F.col("confidence") >= 0.01}))
query("agg_validate_d", sql("SELECT video_id, count(*) AS rows, count(*) FILTER (n <= 60) AS bad_match, bool_and(n > 60) AS valid FROM seg GROUP BY ALL", "seg"))(lambda s, d: rp.checks(mp.segments(s, d), {"match": F.col("n") > 60}))
query("agg_eval_a", sql("SELECT video_id, concat_ws(',', CASE WHEN m < 0.4 THEN 'low confidence' END, CASE WHEN n < 4 THEN 'few segments' END, CASE WHEN w / n < 80 THEN 'short segments' END) AS issues FROM (SELECT video_id, avg(confidence) AS m, count(*) AS n, sum(n) AS w FROM seg GROUP BY ALL)", "seg"))(lambda s, d: rp.findings(mp.segments(s, d).groupBy("video_id").agg(F.avg("confidence").alias("m"), F.count("*").alias("k"), F.sum("n").alias("w")), {"low confidence": F.col("m") < 0.4, "few segments": F.col("k") < 4, "short segments": F.col("w") / F.col("k") < 80}).select("video_id", F.array_join("issues", ",").alias("issues")))
query("agg_eval_b", sql("SELECT video_id, CASE WHEN count(DISTINCT speaker_id) < 2 THEN 'one speaker' ELSE '' END AS issues FROM turn GROUP BY ALL", "turn"))(lambda s, d: rp.findings(mp.turns(s, d).groupBy("video_id").agg(F.count_distinct("speaker_id").alias("k")), {"one speaker": F.col("k") < 2}).select("video_id", F.array_join("issues", ",").alias("issues")))
query("agg_eval_c", sql("SELECT video_id, concat_ws(',', CASE WHEN count(DISTINCT character_id) < 3 THEN 'few characters' END, CASE WHEN avg(confidence) < 0.25 THEN 'low quality' END) AS issues FROM det GROUP BY ALL", "det"))(lambda s, d: rp.findings(mp.detections(s, d).groupBy("video_id").agg(F.count_distinct("character_id").alias("k"), F.avg("confidence").alias("m")), {"few characters": F.col("k") < 3, "low quality": F.col("m") < 0.25}).select("video_id", F.array_join("issues", ",").alias("issues")))
query("agg_eval_d", sql("SELECT video_id, CASE WHEN count(*) FILTER (n > 60) / count(*) < 0.5 THEN 'low match rate' ELSE '' END AS issues FROM seg GROUP BY ALL", "seg"))(lambda s, d: rp.findings(mp.segments(s, d).groupBy("video_id").agg((F.count_if(F.col("n") > 60) / F.count("*")).alias("r")), {"low match rate": F.col("r") < 0.5}).select("video_id", F.array_join("issues", ",").alias("issues")))
query("agg_hallucination", "SELECT source, round(count(DISTINCT text) / count(*), 6) AS ratio, count(DISTINCT text) / count(*) < 0.5 AS warn FROM documents GROUP BY ALL")(lambda s, d: mp.table(s, d, "documents").groupBy("source").agg(F.count_distinct("text").alias("k"), F.count("*").alias("n")).select("source", F.round(F.col("k") / F.col("n"), 6).alias("ratio"), (F.col("k") / F.col("n") < 0.5).alias("warn")))
query("agg_char_report", sql("SELECT character_id, count(*) AS n, round(avg(confidence), 6) AS mean, count(*) FILTER (confidence > 0.7) AS high, count(*) FILTER (confidence BETWEEN 0.4 AND 0.7) AS mid, count(*) FILTER (confidence < 0.4) AS low FROM det GROUP BY ALL", "det"))(lambda s, d: mp.detections(s, d).groupBy("character_id").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("mean"), F.count_if(F.col("confidence") > 0.7).alias("high"), F.count_if(F.col("confidence").between(0.4, 0.7)).alias("mid"), F.count_if(F.col("confidence") < 0.4).alias("low")))
query("agg_reports_other", sql("SELECT CASE WHEN start < duration / 3 THEN 'early' WHEN start < duration * 2 / 3 THEN 'middle' ELSE 'late' END AS part, count(*) AS unmatched FROM seg JOIN vid USING (video_id) WHERE n <= 60 GROUP BY ALL", "seg", "vid"))(lambda s, d: mp.segments(s, d).where("n <= 60").join(mp.videos(s, d).select("video_id", "duration"), "video_id").groupBy(F.when(F.col("start") < F.col("duration") / 3, "early").when(F.col("start") < F.col("duration") * 2 / 3, "middle").otherwise("late").alias("part")).agg(F.count("*").alias("unmatched")))
query("agg_display", sql("SELECT video_id, count(DISTINCT speaker) AS speakers, min(confidence) AS low, max(confidence) AS high FROM seg GROUP BY ALL", "seg"))(lambda s, d: mp.segments(s, d).groupBy("video_id").agg(F.count_distinct("speaker").alias("speakers"), F.min("confidence").alias("low"), F.max("confidence").alias("high")))
query("agg_display_parts", sql("SELECT video_id, round(stddev_pop(confidence), 6) AS std, string_agg(segment_id, ',' ORDER BY ord) FILTER (ord < 3) AS head FROM seg GROUP BY ALL", "seg"))(lambda s, d: mp.segments(s, d).groupBy("video_id").agg(F.round(F.stddev_pop("confidence"), 6).alias("std"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("ord") < 3, F.struct("ord", "segment_id")))), lambda x: x["segment_id"]), ",").alias("head")))
query("agg_multi_video", sql("SELECT count(*) AS videos, count(*) FILTER (duration > 300) AS long, round(avg(duration), 6) AS mean FROM vid", "vid"))(lambda s, d: mp.videos(s, d).agg(F.count("*").alias("videos"), F.count_if(F.col("duration") > 300).alias("long"), F.round(F.avg("duration"), 6).alias("mean")))
query("agg_batch", sql("SELECT CASE WHEN segments < 4 THEN 'short' ELSE 'ok' END AS status, count(*) AS n, round(avg(duration), 6) AS mean FROM vid GROUP BY ALL", "vid"))(lambda s, d: mp.videos(s, d).groupBy(F.when(F.col("segments") < 4, "short").otherwise("ok").alias("status")).agg(F.count("*").alias("n"), F.round(F.avg("duration"), 6).alias("mean")))
query("agg_perf", "SELECT event_type, round(avg(value), 6) AS mean, max(value) AS high, round(stddev_pop(value), 6) AS std FROM events GROUP BY ALL")(lambda s, d: mp.table(s, d, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("high"), F.round(F.stddev_pop("value"), 6).alias("std")))
query("agg_perf_report", "SELECT user_id, count(*) AS n, round(count(*) FILTER (event_type <> 'error') / count(*), 6) AS ok, CASE WHEN count(*) FILTER (event_type = 'error') * 4 > count(*) THEN 'check errors' ELSE 'fine' END AS advice FROM events GROUP BY ALL")(lambda s, d: mp.table(s, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.try_divide(F.count_if(F.col("event_type") != "error").cast("double"), F.count("*")), 6).alias("ok"), F.when(F.count_if(F.col("event_type") == "error") * 4 > F.count("*"), "check errors").otherwise("fine").alias("advice")))
query("agg_frame_stats", sql("SELECT video_id, round(coalesce(avg(confidence), 0), 6) AS mean, round(coalesce(stddev_pop(confidence), 0), 6) AS std, min(confidence) AS low, max(confidence) AS high FROM det GROUP BY ALL", "det"))(lambda s, d: mp.detections(s, d).groupBy("video_id").agg(F.round(F.coalesce(F.avg("confidence"), F.lit(0.0)), 6).alias("mean"), F.round(F.coalesce(F.stddev_pop("confidence"), F.lit(0.0)), 6).alias("std"), F.min("confidence").alias("low"), F.max("confidence").alias("high")))
query("agg_run_totals", sql('SELECT count(*) FILTER (n > 50) AS good, count(*) FILTER (n <= 50) AS failed, sum("end" - start) AS seconds FROM seg', "seg"))(lambda s, d: mp.segments(s, d).agg(F.count_if(F.col("n") > 50).alias("good"), F.count_if(F.col("n") <= 50).alias("failed"), F.sum(F.col("end") - F.col("start")).alias("seconds")))
query("agg_track_report", sql("SELECT character_id, count(*) AS frames FROM det GROUP BY ALL", "det"))(lambda s, d: mp.detections(s, d).groupBy("character_id").agg(F.count("*").alias("frames")).orderBy(F.desc("frames"), "character_id"))
query("agg_cube", "SELECT event_type, user_id % 5 AS g, count(*) AS n FROM events GROUP BY CUBE (event_type, user_id % 5)")(lambda s, d: mp.table(s, d, "events").withColumn("g", F.col("user_id") % 5).cube("event_type", "g").agg(F.count("*").alias("n")))

# ---- top-k -----------------------------------------------------------------------------

query("top_dialogue", sql("SELECT video_id, string_agg(segment_id, ',' ORDER BY start, ord) AS v FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY coalesce(emotion_confidence, 0) DESC, ord) AS k FROM seg) WHERE k <= 3 GROUP BY ALL", "seg"))(
    lambda s, d: mp.segments(s, d).withColumn("k", F.row_number().over(Window.partitionBy("video_id").orderBy(F.desc(F.coalesce("emotion_confidence", F.lit(0.0))), "ord"))).where("k <= 3").groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "ord", "segment_id"))), lambda x: x["segment_id"]), ",").alias("v"))
)
query("top_emotional", sql("SELECT video_id, ord FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY emotion_confidence DESC, ord) AS k FROM seg WHERE emotion <> 'neutral') WHERE k = 1", "seg"))(lambda s, d: iv.first_by(mp.segments(s, d).where("emotion <> 'neutral'"), _V, F.desc("emotion_confidence"), "ord").select("video_id", "ord"))
query("top_longest", sql('SELECT video_id, ord, "end" - start AS seconds FROM turn ORDER BY seconds DESC, video_id, ord LIMIT 5', "turn"))(lambda s, d: mp.turns(s, d).select("video_id", "ord", (F.col("end") - F.col("start")).alias("seconds")).orderBy(F.desc("seconds"), "video_id", "ord").limit(5))
query("top_chars", sql("SELECT video_id, character_id, n FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, character_id) AS k FROM (SELECT video_id, character_id, count(*) AS n FROM det GROUP BY ALL)) WHERE k <= 5", "det"))(lambda s, d: mp.detections(s, d).groupBy("video_id", "character_id").agg(F.count("*").alias("n")).withColumn("k", F.row_number().over(Window.partitionBy("video_id").orderBy(F.desc("n"), "character_id"))).where("k <= 5").drop("k"))
query("top_first5", sql("SELECT video_id, id FROM shot WHERE id <= 5", "shot"))(lambda s, d: mp.shots(s, d).withColumn("k", F.row_number().over(Window.partitionBy("video_id").orderBy("id"))).where("k <= 5").select("video_id", "id"))
query("top_sample", sql("SELECT video_id, ord FROM (SELECT video_id, ord, row_number() OVER w AS k, count(*) OVER (PARTITION BY video_id) AS n FROM seg WINDOW w AS (PARTITION BY video_id ORDER BY ord)) WHERE k = 1 OR k = n OR k = n // 2 + 1", "seg"))(lambda s, d: mp.segments(s, d).withColumns({"k": F.row_number().over(Window.partitionBy("video_id").orderBy("ord")), "n": F.count("*").over(Window.partitionBy("video_id"))}).where("k = 1 or k = n or k = n div 2 + 1").select("video_id", "ord"))

# ---- sinks -----------------------------------------------------------------------------


def captions(spark, sf):
    return mp.segments(spark, sf).select("video_id", F.col("ord").alias("scene_id"), "start", "end", F.col("text").alias("caption"), F.array("speaker").alias("characters"), (F.col("ord") % 2 == 0).alias("has_dialogue"))


_CS = "printf('%02d:%02d:%02d{m}%03d', {c}::BIGINT // 3600, ({c}::BIGINT % 3600) // 60, {c}::BIGINT % 60, 0)"
_A, _B = _CS.format(m=",", c="start"), _CS.format(m=",", c='"end"')
_AV, _BV = _CS.format(m=".", c="start"), _CS.format(m=".", c='"end"')
_WHO = "CASE WHEN ord % 2 = 0 THEN '[' || speaker || '] ' ELSE '' END"
query("snk_srt", sql(f"SELECT video_id, string_agg((ord + 1) || chr(10) || {_A} || ' --> ' || {_B} || chr(10) || {_WHO} || text || chr(10), chr(10) ORDER BY ord) || chr(10) AS body FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ord) - 1 AS o FROM seg) GROUP BY ALL", "seg"))(lambda s, d: sk.srt_file(captions(s, d)))
query("snk_vtt", sql(f"SELECT video_id, 'WEBVTT' || chr(10) || 'Kind: captions' || chr(10) || chr(10) || string_agg(printf('SCENE_%03d', ord) || chr(10) || {_AV} || ' --> ' || {_BV} || ' align:left line:90%' || chr(10) || CASE WHEN ord % 2 = 0 THEN '<v ' || speaker || '>' ELSE '' END || text || chr(10), chr(10) ORDER BY ord) || chr(10) AS body FROM seg GROUP BY ALL", "seg"))(lambda s, d: sk.vtt_file(captions(s, d)))
query("snk_pkg_srt_vtt", sql(f"SELECT video_id, string_agg(ord || chr(10) || {_A} || ' --> ' || {_B} || chr(10) || text || chr(10), chr(10) ORDER BY ord) || chr(10) AS body FROM seg GROUP BY ALL", "seg"))(lambda s, d: sk.plain_srt(captions(s, d)))
_RD = "CASE WHEN {c} >= 3600 THEN printf('%d:%02d:%02d', {c}::BIGINT // 3600, ({c}::BIGINT % 3600) // 60, {c}::BIGINT % 60) ELSE printf('%d:%02d', {c}::BIGINT // 60, {c}::BIGINT % 60) END"
query("snk_txt", sql(f"SELECT video_id, string_agg('[' || {_RD.format(c='start')} || ' - ' || {_RD.format(c=chr(34) + 'end' + chr(34))} || '] ' || text, chr(10) ORDER BY ord) || chr(10) AS body FROM seg GROUP BY ALL", "seg"))(lambda s, d: sk.text_file(captions(s, d)))
query("snk_html", "SELECT doc_id AS video_id, '<!DOCTYPE html>' || chr(10) || '<meta charset=\"utf-8\">' || chr(10) || '<p><b>0:00</b> ' || replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') || '</p>' || chr(10) AS body FROM documents")(
    lambda s, d: sk.html_file(mp.table(s, d, "documents").select(F.col("doc_id").alias("video_id"), F.lit(1).alias("scene_id"), F.lit(0.0).alias("start"), F.col("text").alias("caption")))
)
query("snk_json_caps", sql("SELECT video_id, count(*)::INTEGER AS n, string_agg(text, chr(10) ORDER BY ord) AS captions, string_agg(start || '-' || \"end\", ',' ORDER BY ord) AS spans FROM seg GROUP BY ALL", "seg"))(lambda s, d: _json_captions(s, d))


def _json_captions(spark, sf):
    """The bodies, written, read back and parsed."""
    kind = "struct<total_captions:int,captions:array<struct<scene_id:bigint,start:double,end:double,caption:string,characters:array<string>,has_dialogue:boolean>>>"
    back = stored(sk.json_file(captions(spark, sf))).select("video_id", F.from_json("body", kind).alias("b"))
    one = lambda f: F.array_join(F.transform("b.captions", f), "\n")
    spans_ = F.array_join(F.transform("b.captions", lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string"))), ",")
    return back.select("video_id", F.col("b.total_captions").alias("n"), one(lambda x: x["caption"]).alias("captions"), spans_.alias("spans"))
query("snk_json_docs", sql("SELECT video_id, count(*)::INTEGER AS n, string_agg(segment_id, ',' ORDER BY ord) AS v FROM seg GROUP BY ALL", "seg"))(lambda s, d: stored(sk.nested(mp.segments(s, d), "segments", "ord", "segment_id", "start", "end", "text")).select("video_id", F.col("total_segments").alias("n"), F.array_join(F.transform("segments", lambda x: x["segment_id"]), ",").alias("v")))
query("snk_shots_scenes", sql('SELECT video_id, count(*)::INTEGER AS total_shots, max("end") AS "end" FROM shot GROUP BY ALL', "shot"))(lambda s, d: stored(sk.nested(mp.shots(s, d), "shots", "id", "start", "end")).select("video_id", "total_shots", F.element_at("shots", -1)["end"].alias("end")))
query("snk_analysis", sql("SELECT v.video_id, duration, (SELECT count(*) FROM shot s WHERE s.video_id = v.video_id)::INTEGER AS total_shots, (SELECT count(*) FROM scene c WHERE c.video_id = v.video_id)::INTEGER AS total_scenes FROM vid v", "shot", "scene"))(lambda s, d: stored(sk.analysis(mp.videos(s, d), mp.shots(s, d), mp.scenes(s, d))).select("video_id", "duration", "total_shots", "total_scenes"))
query("snk_tracking", sql("SELECT character_id, string_agg(ord::VARCHAR, ',' ORDER BY k DESC) AS v FROM (SELECT character_id, ord, row_number() OVER (PARTITION BY character_id ORDER BY ord DESC) AS k FROM det) WHERE k <= 10 GROUP BY ALL", "det"))(lambda s, d: stored(mp.detections(s, d).withColumn("k", F.row_number().over(Window.partitionBy("character_id").orderBy(F.desc("ord")))).where("k <= 10").groupBy("character_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("ord")), lambda x: x.cast("string")), ",").alias("v"))))
query("snk_context", sql("SELECT video_id, ord AS scene_id, speaker || ': ' || text AS v FROM seg", "seg"))(lambda s, d: stored(captions(s, d).select("video_id", "scene_id", F.concat(F.get("characters", F.lit(0)), F.lit(": "), "caption").alias("v"))))
query("snk_reports", sql("SELECT '# Video ' || video_id || chr(10) || '- segments: ' || segments || chr(10) || '- words: ' || words AS body FROM vid", "vid"))(lambda s, d: stored(mp.videos(s, d).select(F.concat(F.lit("# Video "), F.col("video_id").cast("string"), F.lit("\n- segments: "), F.col("segments").cast("string"), F.lit("\n- words: "), F.col("words").cast("string")).alias("body"))))

# ---- model boundary --------------------------------------------------------------------

query("udf_mllm", sql("SELECT video_id, ord, speaker || ' in a scene described from ' || (2 + n) || ' words.' AS caption, NULL::VARCHAR AS error FROM seg", "seg"))(lambda s, d: registry.captioned(mp.segments(s, d).select("video_id", "ord", F.concat(F.lit("Characters: "), "speaker", F.lit("\n"), "text").alias("prompt"))).drop("prompt"))
query("udf_presets", "SELECT * FROM (VALUES ('action', 0.2::DOUBLE, 3000), ('crowd', 0.3, 3000), ('dark', 0.15, 2000), ('default', 0.3, 2000), ('dialogue', 0.4, 1500), ('fast', 0.5, 600)) t(name, quality, max_frames)")(lambda s, d: _presets(s))
query("udf_cinematic", sql("SELECT video_id, 'disabled' AS status FROM vid", "vid"))(lambda s, d: registry.cinematic(mp.videos(s, d)))


def _presets(spark):
    from .config import PRESETS

    return spark.createDataFrame([(k, float(v["quality"]), int(v["max_frames"])) for k, v in PRESETS.items()], "name string, quality double, max_frames int")
