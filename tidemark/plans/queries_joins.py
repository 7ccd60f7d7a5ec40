"""Queries of the joins, the scores over joined rows and the set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vector as vc
from ..operators import folds as fo
from ..operators import intervals as iv
from ..operators import scoring as sc
from . import mapping as mp
from .mapping import sql
from .queries import query

_OV = 'greatest(0, least(s."end", t."end") - greatest(s.start, t.start))'


def dialogues(spark, sf):
    return mp.segments(spark, sf).select("video_id", "ord", "segment_id", "start", "end", "speaker", "emotion", "confidence")


def spans(spark, sf):
    return mp.turns(spark, sf).select("video_id", "speaker_id", F.col("start").alias("t0"), F.col("end").alias("t1"), F.col("ord").alias("tord"))


def _best(body: str) -> str:
    return f"""p AS (SELECT s.video_id, s.segment_id, t.speaker_id, t.ord AS tord, {body} AS ratio FROM seg s JOIN turn t ON s.video_id = t.video_id),
b AS (SELECT *, row_number() OVER (PARTITION BY video_id, segment_id ORDER BY ratio DESC, tord) AS k FROM p WHERE ratio > """


query("jn_best_overlap", sql(_best(f'{_OV} / nullif(s."end" - s.start, 0)') + "0)\nSELECT s.video_id, s.segment_id, b.speaker_id, round(b.ratio, 6) AS ratio FROM seg s LEFT JOIN b ON b.video_id = s.video_id AND b.segment_id = s.segment_id AND b.k = 1", "turn"))(
    lambda s, d: iv.best_overlap(dialogues(s, d), spans(s, d), "segment_id").select("video_id", "segment_id", "speaker_id", F.round("ratio", 6).alias("ratio"))
)
query("jn_overlap_min", sql(_best(f'{_OV} / nullif(least(s."end" - s.start, t."end" - t.start), 0)') + "0.5)\nSELECT s.video_id, s.segment_id, b.speaker_id, round(b.ratio, 6) AS ratio FROM seg s LEFT JOIN b ON b.video_id = s.video_id AND b.segment_id = s.segment_id AND b.k = 1", "turn"))(
    lambda s, d: iv.best_overlap(dialogues(s, d), spans(s, d), "segment_id", "shorter", 0.5).select("video_id", "segment_id", "speaker_id", F.round("ratio", 6).alias("ratio"))
)
query("jn_point_overlap", sql("""p AS (SELECT s.video_id, s.segment_id, t.speaker_id, row_number() OVER (PARTITION BY s.video_id, s.segment_id ORDER BY t.ord) AS k FROM seg s JOIN turn t ON s.video_id = t.video_id AND (s.start BETWEEN t.start AND t."end" OR s."end" BETWEEN t.start AND t."end"))
SELECT video_id, segment_id, speaker_id FROM p WHERE k = 1""", "turn"))(lambda s, d: _point_overlap(s, d))  # fmt: skip


def _point_overlap(spark, sf):
    inside = (F.col("start").between(F.col("t0"), F.col("t1"))) | (F.col("end").between(F.col("t0"), F.col("t1")))
    pairs = iv.interval_join(dialogues(spark, sf), spans(spark, sf), ["video_id"], ("start", "end"), ("t0", "t1"), 60.0, inside)
    return iv.first_by(pairs, ["video_id", "segment_id"], "tord").select("video_id", "segment_id", "speaker_id")


def _scene_spans(spark, sf):
    return mp.scenes(spark, sf).select("video_id", F.col("id").alias("scene_id"), F.col("start").alias("s0"), F.col("end").alias("s1"))


_IN = "row_number() OVER (PARTITION BY d.ord ORDER BY c.id) AS k FROM det d {j} JOIN scene c ON d.video_id = c.video_id AND d.ts BETWEEN c.start AND c.\"end\""
query("jn_point_in_scene", sql("p AS (SELECT d.ord, c.id AS scene_id, " + _IN.format(j="") + ") SELECT ord, scene_id FROM p WHERE k = 1", "det", "scene"))(lambda s, d: iv.first_by(iv.point_join(mp.detections(s, d).select("video_id", "ord", "ts"), _scene_spans(s, d), "ts", ("s0", "s1"), 60.0), ["ord"], "scene_id").select("ord", "scene_id"))
query("jn_frame_in_scene", sql("p AS (SELECT d.ord, c.id AS scene_id, " + _IN.format(j="") + ") SELECT ord, scene_id FROM p WHERE k = 1", "det", "scene"))(lambda s, d: iv.first_by(iv.point_join(mp.detections(s, d).select("video_id", "ord", (F.col("decis") / 10.0).alias("ts")), _scene_spans(s, d), "ts", ("s0", "s1"), 60.0), ["ord"], "scene_id").select("ord", "scene_id"))
query("jn_c_with_scenes", sql("p AS (SELECT d.ord, d.character_id, c.id AS scene_id, " + _IN.format(j="LEFT") + ") SELECT character_id, scene_id, count(*) AS n FROM p WHERE k = 1 GROUP BY ALL", "det", "scene"))(
    lambda s, d: iv.first_by(iv.point_join(mp.detections(s, d).select("video_id", "ord", "character_id", "ts"), _scene_spans(s, d), "ts", ("s0", "s1"), 60.0, how="left"), ["ord"], "scene_id").groupBy("character_id", "scene_id").agg(F.count("*").alias("n"))
)
query("jn_scene_dialogue", sql("SELECT c.video_id, c.id AS scene_id, coalesce(string_agg(s.segment_id, ',' ORDER BY s.start, s.ord), '') AS v FROM scene c LEFT JOIN seg s ON s.video_id = c.video_id AND s.start >= c.start AND s.start < c.\"end\" AND s.confidence >= 0.3 GROUP BY ALL", "scene"))(lambda s, d: _scene_dialogue(s, d))


def _scene_dialogue(spark, sf):
    said = mp.segments(spark, sf).where("confidence >= 0.3").select("video_id", F.col("start").alias("at"), "ord", "segment_id")
    pairs = iv.point_join(said, _scene_spans(spark, sf), "at", ("s0", "s1"), 60.0, closed=False)
    listed = pairs.groupBy("video_id", "scene_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "ord", "segment_id"))), lambda x: x["segment_id"]), ",").alias("v"))
    return _scene_spans(spark, sf).join(listed, ["video_id", "scene_id"], "left").select("video_id", "scene_id", F.coalesce("v", F.lit("")).alias("v"))


query("jn_scene_chars", sql("""x AS (SELECT c.video_id, c.id, s.speaker AS who FROM scene c JOIN seg s ON s.video_id = c.video_id AND s.start >= c.start AND s.start < c."end"
 UNION SELECT c.video_id, c.id, d.character_id FROM scene c JOIN det d ON d.video_id = c.video_id AND d.ts BETWEEN c.start AND c."end")
SELECT video_id, id AS scene_id, string_agg(who, ',' ORDER BY who) AS v FROM x GROUP BY ALL""", "scene", "det"))(lambda s, d: _scene_chars(s, d))  # fmt: skip


def _scene_chars(spark, sf):
    spoke = iv.point_join(mp.segments(spark, sf).select("video_id", F.col("start").alias("at"), F.col("speaker").alias("who")), _scene_spans(spark, sf), "at", ("s0", "s1"), 60.0, closed=False)
    seen = iv.point_join(mp.detections(spark, sf).select("video_id", F.col("ts").alias("at"), F.col("character_id").alias("who")), _scene_spans(spark, sf), "at", ("s0", "s1"), 60.0)
    return spoke.unionByName(seen).groupBy("video_id", "scene_id").agg(F.array_join(F.sort_array(F.collect_set("who")), ",").alias("v"))


query("set_union_chars", sql("""x AS (SELECT video_id, speaker AS who FROM seg UNION SELECT video_id, character_id FROM det) SELECT video_id, string_agg(who, ',' ORDER BY who) AS v FROM x GROUP BY ALL""", "seg", "det"))(
    lambda s, d: mp.segments(s, d).select("video_id", F.col("speaker").alias("who")).unionByName(mp.detections(s, d).select("video_id", F.col("character_id").alias("who"))).groupBy("video_id").agg(F.array_join(F.sort_array(F.collect_set("who")), ",").alias("v"))
)
query("jn_det_window", sql("SELECT s.video_id, s.segment_id, count(*) AS n FROM seg s JOIN det d ON d.video_id = s.video_id AND d.ts BETWEEN greatest(0, s.start - 30) AND s.\"end\" + 30 GROUP BY ALL", "seg", "det"))(
    lambda s, d: iv.interval_join(dialogues(s, d).withColumns({"w0": F.greatest(F.lit(0.0), F.col("start") - 30), "w1": F.col("end") + 30}), mp.detections(s, d).select("video_id", "ts"), ["video_id"], ("w0", "w1"), ("ts", "ts"), 60.0).groupBy("video_id", "segment_id").agg(F.count("*").alias("n"))
)
query("jn_det_during", sql("""c AS (SELECT s.video_id, s.segment_id, d.character_id, count(*) AS n, min(d.ord) AS o FROM seg s JOIN det d ON d.video_id = s.video_id AND d.ts BETWEEN s.start AND s."end" GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY video_id, segment_id ORDER BY n DESC, o) AS k, sum(n) OVER (PARTITION BY video_id, segment_id) AS total FROM c) SELECT video_id, segment_id, character_id AS dominant, n, total::BIGINT AS total FROM r WHERE k = 1""", "seg", "det"))(lambda s, d: _during(s, d))  # fmt: skip


def _during(spark, sf):
    pairs = iv.interval_join(dialogues(spark, sf), mp.detections(spark, sf).select("video_id", "ts", "character_id", F.col("ord").alias("o")), ["video_id"], ("start", "end"), ("ts", "ts"), 60.0)
    counts = pairs.groupBy("video_id", "segment_id", "character_id").agg(F.count("*").alias("n"), F.min("o").alias("o"))
    total = counts.withColumn("total", F.sum("n").over(Window.partitionBy("video_id", "segment_id")))
    return iv.first_by(total, ["video_id", "segment_id"], F.desc("n"), "o").select("video_id", "segment_id", F.col("character_id").alias("dominant"), "n", "total")


_PRES = """near AS (SELECT s.video_id, s.segment_id, d.character_id, d.ts BETWEEN s.start AND s."end" AS i, greatest(s.start - d.ts, d.ts - s."end", 0) AS gap, (x2 - x1) * (y2 - y1) / 307200 AS area,
  sqrt(pow((x1 + x2) / 2 / 640 - 0.5, 2) + pow((y1 + y2) / 2 / 480 - 0.5, 2)) AS dist FROM seg s JOIN det d ON d.video_id = s.video_id AND d.ts BETWEEN greatest(0, s.start - 30) AND s."end" + 30),
c AS (SELECT video_id, segment_id, character_id, count(*) FILTER (i) AS during, count(*) AS near, min(gap) AS distance, avg((area + 1 - least(dist, 1)) / 2) FILTER (i) AS centrality, avg(area) FILTER (i) AS size FROM near GROUP BY ALL),
p AS (SELECT *, sum(during) OVER w AS all_during, sum(near) OVER w AS all_near, count(*) FILTER (during > 0) OVER w AS who_during, count(*) OVER w AS who_near FROM c WINDOW w AS (PARTITION BY video_id, segment_id)),
q AS (SELECT *, CASE WHEN during > 0 THEN CASE WHEN who_during = 1 THEN 0.8 ELSE during / all_during * 0.4 END ELSE CASE WHEN who_near = 1 THEN greatest(0.2, 1 - distance / 30) * 0.56 ELSE near / all_near * greatest(0.2, 1 - distance / 30) * 0.32 END END AS single,
  CASE WHEN coalesce(centrality, 0) >= 0.3 THEN coalesce(centrality, 0) * 0.6 ELSE coalesce(centrality, 0) * 0.3 END AS central,
  CASE WHEN distance = 0 THEN 0.5 WHEN distance <= 0.5 THEN (1 - distance / 0.5) * 0.5 ELSE exp(-distance / 0.5) * 0.15 END AS temporal,
  CASE WHEN during > 0 THEN least(1, 0.5 + CASE WHEN size > 0.15 THEN 0.2 ELSE 0 END + CASE WHEN centrality > 0.7 THEN 0.2 ELSE 0 END + CASE WHEN who_during = 1 THEN 0.1 ELSE 0 END) ELSE 0.1 END AS rule FROM p)
"""


def _presence(spark, sf):
    return sc.presence(dialogues(spark, sf), mp.detections(spark, sf))


_PK = ["video_id", "segment_id", "character_id"]
query("sc_single_char", sql(_PRES + "SELECT video_id, segment_id, character_id, round(single, 6) AS v FROM q", "seg", "det"))(lambda s, d: _presence(s, d).select(*_PK, F.round(sc.single_character(), 6).alias("v")))
query("sc_centrality", sql(_PRES + "SELECT video_id, segment_id, character_id, round(central, 6) AS v FROM q", "seg", "det"))(lambda s, d: _presence(s, d).select(*_PK, F.round(sc.centrality_score(), 6).alias("v")))
query("sc_temporal", sql(_PRES + "SELECT video_id, segment_id, character_id, round(temporal, 6) AS v FROM q", "seg", "det"))(lambda s, d: _presence(s, d).select(*_PK, F.round(sc.temporal(F.col("distance")), 6).alias("v")))
query("sc_llm_sim", sql(_PRES + "SELECT video_id, segment_id, character_id, round(rule, 6)::DOUBLE AS v, CASE WHEN during > 0 THEN concat_ws('; ', 'visible', CASE WHEN size > 0.15 THEN 'large face' END, CASE WHEN centrality > 0.7 THEN 'central' END, CASE WHEN who_during = 1 THEN 'alone' END) ELSE 'not visible' END AS why FROM q", "seg", "det"))(
    lambda s, d: _presence(s, d).select(*_PK, F.round(sc.rules(F.lit(False)), 6).alias("v"), sc.reasons(F.lit(False)).alias("why"))
)
_BEST = "greatest(single, 0.1, central, temporal)"
query("sc_best", sql(_PRES + f"SELECT video_id, segment_id, character_id, round({_BEST}, 6) AS v FROM q", "seg", "det"))(lambda s, d: _presence(s, d).select(*_PK, F.round(sc.best(_heuristics()), 6).alias("v")))
query("sc_heuristics", sql(_PRES + "SELECT video_id, segment_id, character_id, round(single + central + temporal + 0.1, 5) AS v FROM q", "seg", "det"))(lambda s, d: _presence(s, d).select(*_PK, F.round(F.aggregate(F.map_values(_heuristics()), F.lit(0.0), lambda a, x: a + x), 5).alias("v")))
query("sc_fusion", sql(_PRES + f"SELECT video_id, segment_id, character_id, round({_BEST} * 0.4 + rule * 0.6, 6) AS v FROM q", "seg", "det"))(lambda s, d: _presence(s, d).select(*_PK, F.round(sc.fused(sc.best(_heuristics()), sc.rules(F.lit(False))), 6).alias("v")))
query("jn_cross_score", sql(_PRES + f""", f AS (SELECT *, {_BEST} * 0.4 + rule * 0.6 AS final FROM q), r AS (SELECT *, row_number() OVER (PARTITION BY video_id, segment_id ORDER BY final DESC, character_id) AS k FROM f WHERE final >= 0.3)
SELECT s.video_id, s.segment_id, r.character_id, round(r.final, 6) AS final FROM seg s LEFT JOIN r ON r.video_id = s.video_id AND r.segment_id = s.segment_id AND r.k = 1""", "seg", "det"))(lambda s, d: sc.matches(dialogues(s, d), mp.detections(s, d)).select("video_id", "segment_id", "character_id", F.round("final", 6).alias("final")))  # fmt: skip


def _heuristics():
    return F.create_map(F.lit("single"), sc.single_character(), F.lit("lip"), sc.lip(), F.lit("centrality"), sc.centrality_score(), F.lit("temporal"), sc.temporal(F.col("distance")))


query("sc_time_overlap", sql(f'SELECT s.video_id, s.ord, round({_OV} / nullif(s."end" - s.start, 0), 6) AS v FROM seg s JOIN turn t USING (video_id, ord)', "turn"))(lambda s, d: _paired(s, d).select("video_id", "ord", F.round(F.try_divide(iv.overlap(F.col("start"), F.col("end"), F.col("t0"), F.col("t1")), F.col("end") - F.col("start")), 6).alias("v")))
query("sc_iou_time", sql(f"""u AS (SELECT s.video_id, s.ord, {_OV} / nullif(greatest(s."end", t."end") - least(s.start, t.start), 0) AS iou, abs(s.start - t.start) <= 4 AND abs(s."end" - t."end") <= 4 AS near FROM seg s JOIN turn t USING (video_id, ord))
SELECT video_id, ord, round(CASE WHEN near THEN least(1, coalesce(iou, 0) * 1.2) ELSE coalesce(iou, 0) END, 6) AS v FROM u""", "turn"))(lambda s, d: _paired(s, d).select("video_id", "ord", F.round(sc.span_iou(F.col("start"), F.col("end"), F.col("t0"), F.col("t1"), 4.0), 6).alias("v")))  # fmt: skip


def _paired(spark, sf):
    return dialogues(spark, sf).join(spans(spark, sf).withColumnRenamed("tord", "ord"), ["video_id", "ord"])


query("sc_speaker_align", sql("""r AS (SELECT s.video_id, s.ord, least(1, (greatest(0, least(s."end", s.start + 30) - s.start) + greatest(0, s."end" - (s.start + 60))) / nullif(s."end" - s.start, 0)) AS r FROM seg s)
SELECT video_id, ord, round(CASE WHEN r > 0.8 THEN 0.7 WHEN r > 0.5 THEN r * 0.7 ELSE coalesce(r, 0) * 0.35 END, 6) AS v FROM r""", "seg"))(  # fmt: skip
    lambda s, d: dialogues(s, d).select("video_id", "ord", F.round(sc.speaker_alignment(F.col("start"), F.col("end"), F.array(F.struct(F.col("start").alias("start"), (F.col("start") + 30).alias("end")), F.struct((F.col("start") + 60).alias("start"), (F.col("end") + 1).alias("end")))), 6).alias("v"))
)
query("jn_nearest_app", sql("""d2 AS (SELECT video_id, (floor(min(ts) / 10) * 10) AS a, (floor(min(ts) / 10) * 10) + 5 AS b FROM det GROUP BY video_id)
SELECT s.video_id, s.ord, CASE WHEN s.start BETWEEN a AND b OR s."end" BETWEEN a AND b THEN 0 ELSE least(abs(a - s."end"), abs(s.start - b)) END::DOUBLE AS v FROM seg s JOIN d2 USING (video_id)""", "seg", "det"))(  # fmt: skip
    lambda s, d: dialogues(s, d).join(mp.detections(s, d).groupBy("video_id").agg((F.floor(F.min("ts") / 10) * 10).cast("double").alias("a")), "video_id").select("video_id", "ord", sc.span_distance(F.col("start"), F.col("end"), F.array(F.struct(F.col("a").alias("start"), (F.col("a") + 5).alias("end")))).alias("v"))
)
query("sc_position", sql("SELECT ord, round(1 - least(1, sqrt(pow((x1 + x2) / 2 / 640 - 0.5, 2) + pow((y1 + y2) / 2 / 480 - 0.5, 2)) * 2), 6) AS v FROM det", "det"))(lambda s, d: mp.detections(s, d).select("ord", F.round(sc.position(F.col("box")), 6).alias("v")))
query("sc_emotion", sql("SELECT ord, round(CASE WHEN emotion IN ('angry', 'fear') THEN 1 - p WHEN emotion IN ('happy', 'surprise') THEN p ELSE 0.5 END, 6) AS v FROM (SELECT *, 1 - least(1, sqrt(pow((x1 + x2) / 2 / 640 - 0.5, 2) + pow((y1 + y2) / 2 / 480 - 0.5, 2)) * 2) AS p FROM det)", "det"))(lambda s, d: mp.detections(s, d).select("ord", F.round(sc.emotion_position(F.col("emotion"), sc.position(F.col("box"))), 6).alias("v")))
_IOU = "(SELECT ord, x1, y1, x2, y2, lead(x1) OVER w AS a1, lead(y1) OVER w AS b1, lead(x2) OVER w AS a2, lead(y2) OVER w AS b2 FROM det WINDOW w AS (PARTITION BY video_id ORDER BY ord))"
query("sc_iou_box", sql(f"SELECT ord, round(i / ((x2 - x1) * (y2 - y1) + (a2 - a1) * (b2 - b1) - i), 6) AS v FROM (SELECT *, greatest(0, least(x2, a2) - greatest(x1, a1)) * greatest(0, least(y2, b2) - greatest(y1, b1)) AS i FROM {_IOU} WHERE a1 IS NOT NULL)", "det"))(lambda s, d: _next_box(s, d).select("ord", F.round(vc.box_iou(F.col("box"), F.col("nb")), 6).alias("v")))


def _next_box(spark, sf):
    return mp.detections(spark, sf).withColumn("nb", F.lead("box").over(Window.partitionBy("video_id").orderBy("ord"))).where("nb is not null")


query("jn_iou_match", sql(f"SELECT ord FROM (SELECT *, greatest(0, least(x2, a2) - greatest(x1, a1)) * greatest(0, least(y2, b2) - greatest(y1, b1)) AS i FROM {_IOU} WHERE a1 IS NOT NULL) WHERE i / ((x2 - x1) * (y2 - y1) + (a2 - a1) * (b2 - b1) - i) > 0.1", "det"))(lambda s, d: _next_box(s, d).where(vc.box_iou(F.col("box"), F.col("nb")) > 0.1).select("ord"))
query("win_box_conv", sql("SELECT ord, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, (x2 - x1) * (y2 - y1) AS area, round((x2 - x1) / (y2 - y1), 9) AS aspect FROM det", "det"))(lambda s, d: mp.detections(s, d).withColumn("z", vc.box_to_state(F.col("box"))).select("ord", "z.cx", "z.cy", "z.area", F.round("z.aspect", 9).alias("aspect")))
_VEC = "WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS a, lead(embedding::DOUBLE[]) OVER (ORDER BY vec_id) AS b FROM embeddings)"
query("sc_motion", _VEC + " SELECT vec_id, round(list_sum(list_transform(list_zip(a, b), lambda z: abs(z[1] - z[2]))) / 64, 6) AS v FROM v WHERE b IS NOT NULL")(lambda s, d: _vec_pairs(s, d).select("vec_id", F.round(vc.mean_abs_diff(F.col("a"), F.col("b")), 6).alias("v")))
query("sc_frame_diff", _VEC + " SELECT vec_id, round(list_sum(list_transform(list_zip(a, b), lambda z: pow(z[1] - z[2], 2))) / 64, 6) AS v FROM v WHERE b IS NOT NULL")(lambda s, d: _vec_pairs(s, d).select("vec_id", F.round(vc.mean_square_diff(F.col("a"), F.col("b")), 6).alias("v")))
query("sc_scene_change", _VEC + " SELECT vec_id, round(0.5 * list_sum(list_transform(list_zip(a, b), lambda z: coalesce(pow(abs(z[1]) - abs(z[2]), 2) / nullif(abs(z[1]) + abs(z[2]), 0), 0))) + 0.5 * list_sum(list_transform(list_zip(a, b), lambda z: abs(z[1] - z[2]))) / 64, 6) AS v FROM v WHERE b IS NOT NULL")(
    lambda s, d: _vec_pairs(s, d).select("vec_id", F.round(vc.scene_change(F.transform("a", F.abs), F.transform("b", F.abs), F.col("a"), F.col("b")), 6).alias("v"))
)


def _vec_pairs(spark, sf):
    e = mp.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    return e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b")), "vec_id")



# ---- equi, anti and semi joins ---------------------------------------------------------

_LINK = "l AS (SELECT video_id, id, (id - 1) // 3 + 1 AS scene FROM shot)"


def _links(spark, sf):
    return mp.shots(spark, sf).select("video_id", "id", "start", "end", (F.floor((F.col("id") - 1) / 3) + 1).alias("scene"))


query("jn_scene_shots", sql(_LINK + " SELECT video_id, scene, string_agg(id::VARCHAR, ',' ORDER BY id) AS v FROM l GROUP BY ALL", "shot"))(lambda s, d: _links(s, d).groupBy("video_id", "scene").agg(F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda x: x.cast("string")), ",").alias("v")))
query("jn_scene_times", sql(_LINK + ' SELECT l.video_id, l.scene, min_by(s.start, l.id) AS start, max_by(s."end", l.id) AS "end" FROM l JOIN shot s ON s.video_id = l.video_id AND s.id = l.id GROUP BY ALL', "shot"))(lambda s, d: _links(s, d).groupBy("video_id", "scene").agg(F.min_by("start", "id").alias("start"), F.max_by("end", "id").alias("end")))
query("jn_unassigned", sql("SELECT video_id, string_agg(id::VARCHAR, ',' ORDER BY id) AS v FROM shot WHERE id % 3 = 0 GROUP BY ALL", "shot"))(
    lambda s, d: mp.shots(s, d).join(_links(s, d).where("id % 3 <> 0").select("video_id", "id"), ["video_id", "id"], "left_anti").groupBy("video_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda x: x.cast("string")), ",").alias("v"))
)
query("set_diff_shots", sql("SELECT video_id, id FROM shot EXCEPT SELECT video_id, id FROM scene", "shot", "scene"))(lambda s, d: mp.shots(s, d).select("video_id", "id").exceptAll(mp.scenes(s, d).select("video_id", "id")))
query("jn_middle_keyframe", sql(_LINK + " SELECT video_id, scene, printf('shot_%04d.jpg', list(id ORDER BY id)[count(*) // 2 + 1]) AS v FROM l GROUP BY ALL", "shot"))(lambda s, d: _links(s, d).groupBy("video_id", "scene").agg(F.sort_array(F.collect_list("id")).alias("l")).select("video_id", "scene", F.format_string("shot_%04d.jpg", F.element_at("l", F.floor(F.size("l") / 2).cast("int") + 1)).alias("v")))
query("jn_merge_c", sql("SELECT character_id, min(k) AS k FROM (SELECT character_id, 1 AS k FROM det WHERE ord % 2 = 0 AND character_id <> 'C4' UNION ALL SELECT character_id, 2 FROM det WHERE ord % 2 = 1) GROUP BY character_id", "det"))(lambda s, d: _merged_c(s, d))


def _merged_c(spark, sf):
    det = mp.detections(spark, sf)
    first = det.where("ord % 2 = 0 and character_id <> 'C4'").select("character_id").distinct()
    second = det.where("ord % 2 = 1").select("character_id").distinct().join(first, "character_id", "left_anti")
    return first.withColumn("k", F.lit(1)).unionByName(second.withColumn("k", F.lit(2)))


query("set_union_det", sql("SELECT character_id, count(*) AS n FROM (SELECT * FROM det WHERE ord % 2 = 0 UNION ALL SELECT * FROM det WHERE ord % 3 = 0) GROUP BY ALL", "det"))(lambda s, d: mp.detections(s, d).where("ord % 2 = 0").unionAll(mp.detections(s, d).where("ord % 3 = 0")).groupBy("character_id").agg(F.count("*").alias("n")))
query("jn_compare_runs", sql("SELECT a.video_id, a.ord, b.n - a.n AS words, round((b.n - a.n) * 100.0::DOUBLE / a.n, 6) AS pct FROM seg a JOIN seg b ON b.video_id = a.video_id AND b.ord = a.ord + 1", "seg"))(
    lambda s, d: mp.segments(s, d).select("video_id", "ord", "n").join(mp.segments(s, d).select("video_id", (F.col("ord") - 1).alias("ord"), F.col("n").alias("m")), ["video_id", "ord"]).select("video_id", "ord", (F.col("m") - F.col("n")).alias("words"), F.round(F.try_divide((F.col("m") - F.col("n")) * 100.0, F.col("n")), 6).alias("pct"))
)
query("jn_absent", "SELECT n_name, r_name, count(s_suppkey) AS suppliers FROM nation FULL JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL")(
    lambda s, d: mp.table(s, d, "nation").join(mp.table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "full").join(mp.table(s, d, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name", "r_name").agg(F.count("s_suppkey").alias("suppliers"))
)
query("set_word_overlap", sql("SELECT video_id, ord, round(len(list_intersect(a, b)) / greatest(len(a), len(b)), 6) AS v FROM (SELECT video_id, ord, list_distinct(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) AS a, list_distinct(list_filter(string_split_regex(lower(nxt), '\\s+'), lambda x: x <> '')) AS b FROM (SELECT *, lead(text) OVER (PARTITION BY video_id ORDER BY ord) AS nxt FROM seg)) WHERE b IS NOT NULL", "seg"))(
    lambda s, d: mp.segments(s, d).withColumn("nxt", F.lead("text").over(Window.partitionBy("video_id").orderBy("ord"))).where("nxt is not null").select("video_id", "ord", F.round(tx.word_overlap(F.col("text"), F.col("nxt")), 6).alias("v"))
)
query("jn_band", sql('SELECT s.video_id, s.ord, count(*) AS n FROM seg s JOIN det d ON d.video_id = s.video_id AND abs(d.ts - s.start) <= 2 GROUP BY ALL', "seg", "det"))(lambda s, d: iv.band_join(mp.segments(s, d).select("video_id", "ord", "start"), mp.detections(s, d).select("video_id", "ts"), "start", "ts", 2.0).groupBy("video_id", "ord").agg(F.count("*").alias("n")))
query("jn_as_of", sql("SELECT d.ord, s.ord AS seg_ord FROM det d ASOF LEFT JOIN seg s ON d.video_id = s.video_id AND d.ts >= s.start", "seg", "det"))(lambda s, d: iv.as_of(mp.detections(s, d).select("video_id", "ord", "ts"), mp.segments(s, d).select("video_id", "start", F.col("ord").alias("seg_ord")), "ts", "start", "seg_ord").select("ord", "seg_ord"))

# ---- embeddings ------------------------------------------------------------------------

_CENT = "WITH c AS (SELECT label, list(m ORDER BY i) AS v FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(embedding::DOUBLE[]) AS x, unnest(range(64)) AS i FROM embeddings) GROUP BY label, i) GROUP BY label)"


def centroids(spark, sf, *by: str):
    """The mean vector ``v`` of each label (or of each video and label)."""
    keys = by or ("label",)
    rows = _faces(spark, sf).select("video_id", F.col("scene_id").alias("label"), F.posexplode("embedding").alias("i", "x"))
    means = rows.groupBy(*keys, "i").agg(F.avg("x").alias("m"))
    return means.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda z: z["m"]).alias("v"))


_OF = ("video_id", "label")
_CENTV = "WITH e AS (SELECT vec_id, vec_id % 20 AS video_id, label::BIGINT AS label, embedding::DOUBLE[] AS x FROM embeddings), c AS (SELECT video_id, label, list(m ORDER BY i) AS v FROM (SELECT video_id, label, i, avg(y) AS m FROM (SELECT video_id, label, unnest(x) AS y, unnest(range(64)) AS i FROM e) GROUP BY video_id, label, i) GROUP BY video_id, label)"
query("agg_centroid", _CENT + " SELECT label, round(list_sum(v), 4) AS s, round(v[1], 5) AS first FROM c")(lambda s, d: centroids(s, d).select("label", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 4).alias("s"), F.round(F.get("v", F.lit(0)), 5).alias("first")))
query("jn_cosine", _CENTV + " SELECT a.video_id, a.label AS a, b.label AS b, round(list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)), 4) AS v FROM c a JOIN c b ON a.video_id = b.video_id AND a.label < b.label")(lambda s, d: _cosines(s, d))


def _cosines(spark, sf):
    """Pairs of a video's character centroids; a video has few characters."""
    c = centroids(spark, sf, *_OF)
    other = c.select("video_id", F.col("label").alias("b"), F.col("v").alias("w"))
    return c.join(other, "video_id").where(F.col("label") < F.col("b")).select("video_id", F.col("label").alias("a"), "b", F.round(vc.cosine(F.col("v"), F.col("w")), 4).alias("v"))


query("jn_emb_match", _CENTV + ", m AS (SELECT e.vec_id, c.label, (list_inner_product(e.x, c.v) / sqrt(list_inner_product(e.x, e.x) * list_inner_product(c.v, c.v)) + 1) / 2 AS s FROM e JOIN c USING (video_id)), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS k FROM m) SELECT vec_id, label AS best, round(s, 4) AS s FROM r WHERE k = 1 AND s > 0.55")(
    lambda s, d: _nearest(s, d)
)


def _nearest(spark, sf):
    """Each face with the nearest of its video's character centroids, which travel as one array a video: no pair of rows is made."""
    known = centroids(spark, sf, *_OF).groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("label", "v"))).alias("known"))
    faces = _faces(spark, sf).select("video_id", F.col("ord").alias("vec_id"), "embedding").join(known, "video_id")
    best = F.array_max(F.transform("known", lambda c: F.struct(vc.centred_cosine(F.col("embedding"), c["v"]).alias("s"), (-c["label"]).alias("k"))))
    return faces.select("vec_id", best.alias("b")).where("b.s > 0.55").select("vec_id", (-F.col("b.k")).alias("best"), F.round("b.s", 4).alias("s"))


query("clu_greedy")(lambda s, d: fo.merged_clusters(centroids(s, d, *_OF).select("video_id", F.col("label").alias("cluster_id"), F.col("v").alias("embedding")), 0.3))
query("clu_dbscan")(lambda s, d: fo.clustered(_faces(s, d), 3, 0.75))
query("clu_agglo")(lambda s, d: fo.clustered(_faces(s, d), 3, 0.6, "average"))
query("win_char_assoc")(lambda s, d: fo.associated(_faces(s, d), 0.6))


def _faces(spark, sf):
    return mp.table(spark, sf, "embeddings").select((F.col("vec_id") % 20).alias("video_id"), F.col("label").cast("bigint").alias("scene_id"), F.col("vec_id").alias("ord"), "embedding")


def _members(spark, sf):
    """Faces with their scene's cluster and the merged cluster that this one joins."""
    faces = _faces(spark, sf)
    key = (F.col("scene_id") * 1000 + F.col("cluster")).alias("cluster_id")
    member = fo.clustered(faces, 3, 0.75).select("video_id", "ord", "scene_id", key).join(faces.select("ord", "embedding"), "ord")
    means = member.select("video_id", "cluster_id", F.posexplode("embedding").alias("i", "x")).groupBy("video_id", "cluster_id", "i").agg(F.avg("x").alias("m")).groupBy("video_id", "cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda z: z["m"]).alias("embedding"))
    return member.join(fo.merged_clusters(means, 0.75), ["video_id", "cluster_id"])


def _profiled(spark, sf, *more):
    """A profile of each merged cluster."""
    aggs = [F.count("*").alias("faces"), F.count_distinct("scene_id").alias("scenes"), F.least(F.lit(1.0), F.count("*") / 10.0).alias("confidence"), *more]
    return _members(spark, sf).groupBy("video_id", "global_id").agg(*aggs)


query("clu_driver")(lambda s, d: _profiled(s, d))
query("agg_cluster_profiles")(lambda s, d: _profiled(s, d, F.min("ord").alias("first"), F.max("ord").alias("last"), F.sort_array(F.collect_set("cluster_id")).alias("clusters"), F.sort_array(F.collect_set("scene_id")).alias("in_scenes")))
query("jn_id_remap")(lambda s, d: _members(s, d).select("video_id", "ord", "cluster_id", F.dense_rank().over(Window.partitionBy("video_id").orderBy("global_id")).alias("character")))
query("agg_cluster_stats", "SELECT count(*) AS clusters, sum(n)::BIGINT AS faces, round(avg(n), 6) AS mean, round(1 - count(*)::DOUBLE / greatest(1, sum(n)), 6) AS reduction FROM (SELECT vec_id % 20 AS v, label, count(*) AS n FROM embeddings GROUP BY ALL)")(
    lambda s, d: _faces(s, d).groupBy("video_id", "scene_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("clusters"), F.sum("n").alias("faces"), F.round(F.avg("n"), 6).alias("mean"), F.round(1 - F.count("*") / F.greatest(F.lit(1), F.sum("n")), 6).alias("reduction"))
)
query("clu_prepare", "SELECT vec_id % 20 AS video_id, label::BIGINT AS scene_id, vec_id AS ord, len(embedding)::INTEGER AS size FROM embeddings")(lambda s, d: _faces(s, d).select("video_id", "scene_id", "ord", F.size("embedding").alias("size")))
