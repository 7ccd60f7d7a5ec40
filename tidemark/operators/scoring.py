"""Scores of a character for a dialogue, as Column expressions and one conditional aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vector import box_area, centrality, centre_distance
from .intervals import first_by, interval_join, overlap

#: Weights of the presence heuristic and the window, in seconds, of indirect evidence.
SOLE, WINDOW = 0.8, 30.0


def presence(dialogues: DataFrame, detections: DataFrame, key: str = "segment_id", width: float = 60.0) -> DataFrame:
    """Per dialogue and character: detections during it, near it, and the totals of both.

    One interval join over the extended span and one partial aggregate: counts are
    combined before the shuffle.
    """
    wide = dialogues.select("video_id", key, "start", "end", F.greatest(F.lit(0.0), F.col("start") - WINDOW).alias("w0"), (F.col("end") + WINDOW).alias("w1"))
    near = interval_join(wide, detections.select("video_id", "character_id", "ts", "box"), ["video_id"], ("w0", "w1"), ("ts", "ts"), width)
    inside = (F.col("ts") >= F.col("start")) & (F.col("ts") <= F.col("end"))
    gap = F.greatest(F.col("start") - F.col("ts"), F.col("ts") - F.col("end"), F.lit(0.0))
    counts = near.groupBy("video_id", key, "character_id").agg(
        F.count_if(inside).alias("during"), F.count("*").alias("near"), F.min(gap).alias("distance"),
        F.avg(F.when(inside, centrality(F.col("box")))).alias("centrality"),
        F.avg(F.when(inside, box_area(F.col("box")) / (640.0 * 480.0))).alias("size"),
    )
    totals = counts.groupBy("video_id", key).agg(F.sum("during").alias("all_during"), F.sum("near").alias("all_near"), F.count_if(F.col("during") > 0).alias("who_during"), F.count("*").alias("who_near"))
    return counts.join(totals, ["video_id", key])


def single_character() -> Column:
    """Presence score over the columns of ``presence``."""
    share = F.try_divide(F.col("during").cast("double"), F.col("all_during"))
    direct = F.when(F.col("who_during") == 1, F.lit(SOLE)).otherwise(share * (SOLE * 0.5))
    decay = F.greatest(F.lit(0.2), 1 - F.col("distance") / WINDOW)
    wide = F.try_divide(F.col("near").cast("double"), F.col("all_near"))
    indirect = F.when(F.col("who_near") == 1, decay * (SOLE * 0.7)).otherwise(wide * decay * (SOLE * 0.4))
    return F.when(F.col("during") > 0, direct).otherwise(indirect)


def lip(confidence: Column | None = None) -> Column:
    """Lip evidence: 0.9 of a confidence (0.05 if none is given for the character), or 0.1 for mere presence."""
    if confidence is None:
        return F.when(F.col("near") > 0, 0.1).otherwise(0.0)
    return F.coalesce(confidence * 0.9, F.lit(0.05))


def centrality_score() -> Column:
    c = F.coalesce("centrality", F.lit(0.0))
    return F.when(c >= 0.3, c * 0.6).otherwise(c * 0.3)


def speaker_alignment(t0: Column, t1: Column, spans: Column) -> Column:
    """How much of a speaker's turn a character's appearance spans cover, graded."""
    total = F.aggregate(spans, F.lit(0.0), lambda s, x: s + overlap(t0, t1, x["start"], x["end"]))
    r = F.coalesce(F.try_divide(total, t1 - t0), F.lit(0.0))
    return F.when(r > 0.8, 0.7).when(r > 0.5, r * 0.7).otherwise(r * 0.35)


def span_distance(start: Column, end: Column, spans: Column) -> Column:
    """Least distance of a dialogue's ends from the spans; 0 where its start or end lies in one."""

    def one(x):
        held = ((start >= x["start"]) & (start <= x["end"])) | ((end >= x["start"]) & (end <= x["end"]))
        return F.when(held, 0.0).otherwise(F.least(F.abs(x["start"] - end), F.abs(start - x["end"])))

    return F.array_min(F.transform(spans, one))


def temporal(distance: Column) -> Column:
    near = F.when(distance <= 0.5, (1 - distance / 0.5) * 0.5)
    return F.when(distance.isNull(), 0.0).when(distance == 0, 0.5).otherwise(F.coalesce(near, F.exp(-distance / 0.5) * 0.5 * 0.3))


def best(scores: Column) -> Column:
    return F.coalesce(F.array_max(F.map_values(scores)), F.lit(0.0))


def rules(emotion_ok: Column) -> Column:
    """Rule-based plausibility over the columns of ``presence``."""
    seen = F.lit(0.5) + F.when(F.col("size") > 0.15, 0.2).otherwise(0.0) + F.when(F.col("centrality") > 0.7, 0.2).otherwise(0.0) + F.when(F.col("who_during") == 1, 0.1).otherwise(0.0) + F.when(emotion_ok, 0.1).otherwise(0.0)
    return F.when(F.col("during") > 0, F.least(seen, F.lit(1.0))).otherwise(0.1)


def reasons(emotion_ok: Column) -> Column:
    """Why ``rules`` gave its score."""
    parts = [F.when(F.col("size") > 0.15, "large face"), F.when(F.col("centrality") > 0.7, "central"), F.when(F.col("who_during") == 1, "alone"), F.when(emotion_ok, "emotion agrees")]
    return F.when(F.col("during") > 0, F.concat_ws("; ", F.lit("visible"), *parts)).otherwise("not visible")


def fused(heuristic: Column, rule: Column | None) -> Column:
    return heuristic if rule is None else heuristic * 0.4 + rule * 0.6


def confidence_level(score: Column, advanced: bool = False) -> Column:
    if advanced:
        return F.when(score > 0.7, "high").otherwise("medium")
    return F.when(score >= 0.8, "high").when(score >= 0.5, "medium").otherwise("low")


def span_iou(a0: Column, a1: Column, b0: Column, b1: Column, tolerance: float = 0.5) -> Column:
    """Overlap over union of two spans, 1.2 times (1 at most) if both ends agree within the tolerance."""
    common = overlap(a0, a1, b0, b1)
    iou = F.coalesce(F.try_divide(common, F.greatest(a1, b1) - F.least(a0, b0)), F.lit(0.0))
    close = (F.abs(a0 - b0) <= tolerance) & (F.abs(a1 - b1) <= tolerance)
    return F.when(close, F.least(F.lit(1.0), iou * 1.2)).otherwise(iou)


def position(box: Column, width: float = 640.0, height: float = 480.0) -> Column:
    return 1 - F.least(F.lit(1.0), centre_distance(box, width, height) * 2)


def emotion_position(emotion: Column, pos: Column) -> Column:
    return F.when(emotion.isin("angry", "fear"), 1 - pos).when(emotion.isin("happy", "surprise"), pos).otherwise(0.5)


def matches(dialogues: DataFrame, detections: DataFrame, threshold: float = 0.3, with_rules: bool = True) -> DataFrame:
    """The best character of each dialogue by fused score; character_id is null under the threshold."""
    p = presence(dialogues, detections)
    scores = F.create_map(F.lit("single"), single_character(), F.lit("lip"), lip(), F.lit("centrality"), centrality_score(), F.lit("temporal"), temporal(F.col("distance")))
    scored = p.withColumn("final", fused(best(scores), rules(F.lit(False)) if with_rules else None))
    top = first_by(scored, ["video_id", "segment_id"], F.desc("final"), "character_id").where(F.col("final") >= threshold)
    return dialogues.join(top.select("video_id", "segment_id", "character_id", "final"), ["video_id", "segment_id"], "left")


def comprehensive(temporal_: Column, speaker: Column, continuity: Column, place: Column, emotion: Column, weight: float = 0.1) -> Column:
    """Mean of the terms that are there, by weights 0.3, 0.3 (if over 0), ``weight``, 0.1 and 0.1 (if not null)."""
    known = F.when(speaker > 0, 1.0).otherwise(0.0)
    felt = F.when(emotion.isNotNull(), 1.0).otherwise(0.0)
    total = temporal_ * 0.3 + F.coalesce(speaker, F.lit(0.0)) * known * 0.3 + continuity * weight + place * 0.1 + F.coalesce(emotion, F.lit(0.0)) * 0.1
    return total / (known * 0.3 + felt * 0.1 + (0.3 + weight + 0.1))


def lip_evidence(present: Column, has_data: Column, moves: Column, speaking: Column, confidence: Column) -> Column:
    """0.9 of the confidence if the lips speak and 0.05 if they do not; 0 without a movement in the span; without lip data 0.1 for mere presence."""
    told = F.when(moves == 0, 0.0).when(speaking, confidence * 0.9).otherwise(0.05)
    return F.when(has_data, told).when(present, 0.1).otherwise(0.0)
