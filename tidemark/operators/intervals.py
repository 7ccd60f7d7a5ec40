"""Temporal joins: overlap, band, point-in-interval, as-of and argmax, all keyed by video.

Spans are cut into buckets of time, sides meet by an equi-join on (video, bucket), the
exact predicate is checked again, and a pair is emitted only in the first bucket that
both spans reach. No pair of rows outside a bucket is ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .slices import WIDTH, Scan


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Length of the common part of two spans; 0 if there is none."""
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))


def _bucketed(df: DataFrame, start: Column, end: Column, width: float, name: str) -> DataFrame:
    lo, hi = F.floor(start / width).cast("bigint"), F.floor(end / width).cast("bigint")
    return df.withColumn(f"__lo_{name}", lo).withColumn("__bucket", F.explode(F.sequence(lo, F.greatest(lo, hi))))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], width: float, condition: Column | None = None, how: str = "inner") -> DataFrame:
    """Pairs whose closed spans touch (and meet ``condition``); other column names must differ.

    With ``how='left'`` a left row without a partner comes once with nulls.
    """
    rid = "__row"
    side = left.withColumn(rid, F.monotonically_increasing_id()) if how == "left" else left
    l0, l1, r0, r1 = F.col(left_span[0]), F.col(left_span[1]), F.col(right_span[0]), F.col(right_span[1])
    a, b = _bucketed(side, l0, l1, width, "l"), _bucketed(right, r0, r1, width, "r")
    on = (l0 <= r1) & (r0 <= l1) & (F.col("__bucket") == F.greatest("__lo_l", "__lo_r"))
    pairs = a.join(b, [*keys, "__bucket"]).where(on if condition is None else on & condition).drop("__bucket", "__lo_l", "__lo_r")
    if how != "left":
        return pairs
    added = [c for c in right.columns if c not in keys]
    return side.join(pairs.select(rid, *added), rid, "left").drop(rid)


def first_by(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def best_overlap(dialogues: DataFrame, spans: DataFrame, key: str, ratio_of: str = "dialogue", least: float = 0.0, width: float = 60.0) -> DataFrame:
    """Each dialogue (video_id, key, start, end) with the span (speaker_id, t0, t1, tord) of most overlap over ``least``, else nulls.

    The ratio is to the dialogue's length or to the shorter of both; ties go to the first span.
    """
    common = overlap(F.col("start"), F.col("end"), F.col("t0"), F.col("t1"))
    base = F.col("end") - F.col("start")
    base = base if ratio_of == "dialogue" else F.least(base, F.col("t1") - F.col("t0"))
    pairs = interval_join(dialogues, spans, ["video_id"], ("start", "end"), ("t0", "t1"), width).withColumn("ratio", F.coalesce(F.try_divide(common, base), F.lit(0.0))).where(F.col("ratio") > least)
    best = first_by(pairs, ["video_id", key], F.desc("ratio"), "tord")
    return dialogues.join(best.select("video_id", key, "speaker_id", "ratio"), ["video_id", key], "left")


def point_join(points: DataFrame, spans: DataFrame, at: str, span: tuple[str, str], width: float, closed: bool = True, how: str = "inner") -> DataFrame:
    """Points with the spans that hold them; a half-open span leaves out its end."""
    inside = None if closed else F.col(at) < F.col(span[1])
    return interval_join(points, spans, ["video_id"], (at, at), span, width, inside, how)


def band_join(left: DataFrame, right: DataFrame, at: str, other: str, tolerance: float) -> DataFrame:
    """Pairs of points at most ``tolerance`` apart."""
    lo, hi = F.col(at) - tolerance, F.col(at) + tolerance
    return interval_join(left.withColumns({"__a": lo, "__b": hi}), right, ["video_id"], ("__a", "__b"), (other, other), max(tolerance * 4, 1.0)).drop("__a", "__b")


def as_of(points: DataFrame, marks: DataFrame, at: str, mark_at: str, value: str, width: float = WIDTH) -> DataFrame:
    """Each point with the last mark at or before it, by one sort of the union inside time slices; marks are carried from slice to slice."""
    p = points.withColumns({"__t": F.col(at), "__k": F.lit(1), "__x": F.lit(None).cast(marks.schema[value].dataType)})
    m = marks.select("video_id", F.col(mark_at).alias("__t"), F.lit(0).alias("__k"), F.col(value).alias("__x"))
    both = Scan(p.unionByName(m, allowMissingColumns=True), ["video_id"], "__t", "__k", width=width)
    return both.last_before(value, F.col("__x"), skip_nulls=True).done().where("__k = 1").drop("__t", "__k", "__x")
