"""Ordered operators without a UDF: islands, merges, gaps, transitions, schedules, samples."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .slices import WIDTH, Scan


def _order(keys: Sequence[str], *by) -> Window:
    return Window.partitionBy(*keys).orderBy(*by)


def islands(points: DataFrame, keys: Sequence[str], at: str, gap: float, *tie: str, width: float = WIDTH) -> DataFrame:
    """Runs of points whose neighbours are at most ``gap`` apart: start, end, count. A key's points are dealt by time slices."""
    opens = F.coalesce((F.col(at) - F.col("__before") > gap).cast("bigint"), F.lit(0))
    scan = Scan(points.select(*keys, at, *tie), keys, at, *tie, width=width).last_before("__before", F.col(at))
    numbered = scan.with_column("__new", opens).total_before("island", "__new").done().withColumn("island", F.col("island") + F.col("__new"))
    return numbered.groupBy(*keys, "island").agg(F.min(at).alias("start"), F.max(at).alias("end"), F.count("*").alias("points"))


def merged(spans: DataFrame, keys: Sequence[str], tolerance: float, text: str | None = None, tie: str = "ord", width: float = WIDTH) -> DataFrame:
    """Spans joined when one starts at most ``tolerance`` after the end reached so far; texts joined in order. A key's spans are dealt by time slices."""
    opens = F.coalesce((F.col("start") > F.col("__reach") + tolerance).cast("bigint"), F.lit(0))
    scan = Scan(spans, keys, "start", tie, width=width).greatest_before("__reach", F.col("end"))
    numbered = scan.with_column("__new", opens).total_before("part", "__new").done().withColumn("part", F.col("part") + F.col("__new"))
    aggs = [F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("pieces")]
    if text:
        listed = F.array_sort(F.collect_list(F.struct("start", tie, text)))
        aggs.append(F.array_join(F.transform(listed, lambda x: x[text]), " ").alias(text))
    return numbered.groupBy(*keys, "part").agg(*aggs)


def with_gaps(spans: DataFrame, keys: Sequence[str], tie: str = "ord", width: float = WIDTH) -> DataFrame:
    """Spans with the gap to the next; negative where they overlap, null at the end."""
    known = Scan(spans, keys, "start", tie, width=width).first_after("__next", F.col("start")).done()
    return known.withColumn("gap", F.col("__next") - F.col("end")).drop("__next")


def transitions(rows: DataFrame, keys: Sequence[str], label: str, changed_only: bool, *order: str, width: float = WIDTH) -> DataFrame:
    """Counts of (from, to) labels of consecutive rows; a slice is ``width`` of the first order column."""
    held = Scan(rows.select(*keys, *order, label), keys, *order, width=width).last_before("__before", F.struct(F.col(label).alias("x"))).done()
    pairs = held.where(F.col("__before").isNotNull() & F.col(label).isNotNull()).select(F.col("__before.x").alias("from_label"), F.col(label).alias("to_label"))
    pairs = pairs.where("from_label <> to_label") if changed_only else pairs
    return pairs.groupBy("from_label", "to_label").agg(F.count("*").alias("times"))


def sequence_errors(spans: DataFrame, keys: Sequence[str], tie: str = "ord") -> DataFrame:
    """Rows with a list of what is wrong: missing times, empty spans, overlap with the one before."""
    w = _order(keys, tie)
    checks = F.array(
        F.when(F.col("start").isNull() | F.col("end").isNull(), "missing time"),
        F.when(F.col("start") >= F.col("end"), "empty span"),
        F.when(F.col("start") < F.lag("end").over(w), "overlaps previous"),
    )
    return spans.withColumn("errors", F.array_compact(checks))


def batches(rows: DataFrame, keys: Sequence[str], size: int, *order) -> DataFrame:
    """Rows numbered and dealt into batches of ``size`` from 1 on, the rest last."""
    w = _order(keys, *order)
    return rows.withColumn("n", F.row_number().over(w)).withColumn("batch", (F.floor((F.col("n") - 1) / size) + 1).cast("bigint"))


def renumbered(rows: DataFrame, keys: Sequence[str], at: str, tie: str) -> DataFrame:
    return rows.withColumn("new_id", F.row_number().over(_order(keys, F.coalesce(at, F.lit(0.0)), tie)))


def _jumps(t: np.ndarray, least: float) -> np.ndarray:
    """For each of sorted points, the place of the first later one that is at least ``least`` after it (len(t): none)."""
    n = len(t)
    to = np.maximum(np.searchsorted(t, t + least), np.arange(n) + 1)
    while True:  # the sum may be rounded to either side of the difference, which counts
        back = (to - 1 > np.arange(n)) & (t[np.minimum(to - 1, n - 1)] - t >= least)
        on = (to < n) & (t[np.minimum(to, n - 1)] - t < least)
        if not (back.any() or on.any()):
            return to
        to = to - back + (on & ~back)


def _ways(t: np.ndarray, low: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(points of a slice that may be the first one kept, the last one kept from each on), by pointer doubling."""
    n, to = len(t), _jumps(t, least)
    end = np.where(to < n, to, np.arange(n))
    while (end[end] != end).any():
        end = end[end]
    some = min(n, int(np.searchsorted(t, low + least)) + 2)
    return t[:some], t[end[:some]]


def _enter(rows: list[dict], least: float) -> list[float | None]:
    """The first point kept in each of a key's slices, in order."""
    last, out = None, []
    for row in rows:
        at = np.asarray(row["ways"]["starts"], float)
        hit = np.arange(len(at)) if last is None else np.flatnonzero(at - last >= least)
        out.append(float(at[hit[0]]) if len(hit) else None)
        last = row["ways"]["ends"][hit[0]] if len(hit) else last
    return out


def boundaries_kept(points: DataFrame, keys: Sequence[str], at: str, least: float, width: float = WIDTH) -> DataFrame:
    """Boundaries at least ``least`` after the last one kept; null ones go.

    A key's points are cut into time slices. Each slice tells, for every point that may be
    the first one kept in it, which is the last (pointer doubling over "first point at least
    ``least`` later"); a key's slices are then entered one after another by these tables
    alone, and each lists the points that it keeps.
    """
    width = max(float(width), 20.0 * least)  # the tables hold about least / width of the points
    number = F.floor(F.col(at) / width).cast("bigint")
    slices = points.where(F.col(at).isNotNull()).groupBy(*keys, number.alias("__slice")).agg(F.array_sort(F.collect_list(F.col(at).cast("double"))).alias("__ts"))

    @F.pandas_udf("struct<starts: array<double>, ends: array<double>>")
    def ways(ts: pd.Series, number: pd.Series) -> pd.DataFrame:
        made = [_ways(np.asarray(t, float), n * width, least) for t, n in zip(ts, number, strict=True)]
        return pd.DataFrame({"starts": [m[0] for m in made], "ends": [m[1] for m in made]})

    @F.pandas_udf("array<double>")
    def enter(tables: pd.Series) -> pd.Series:
        return pd.Series([_enter(t, least) for t in tables])

    @F.pandas_udf("array<double>")
    def keep(ts: pd.Series, first: pd.Series) -> pd.Series:
        def one(t: np.ndarray, f: float) -> list[float]:
            if f != f:  # a slice that keeps none
                return []
            t = np.asarray(t, float)
            to, i, out = _jumps(t, least).tolist(), int(np.searchsorted(t, f)), []
            while i < len(t):
                out.append(t[i])
                i = to[i]
            return out

        return pd.Series([one(t, f) for t, f in zip(ts, first, strict=True)])

    tables = slices.select(*keys, F.struct("__slice", ways("__ts", "__slice").alias("ways")).alias("__w")).groupBy(*keys).agg(F.array_sort(F.collect_list("__w"), lambda a, b: (a["__slice"] - b["__slice"]).cast("int")).alias("__w"))
    entered = tables.select(*keys, F.explode(F.arrays_zip(F.transform("__w", lambda w: w["__slice"]).alias("__slice"), enter("__w").alias("__first"))).alias("__e")).select(*keys, "__e.__slice", "__e.__first")
    known = slices.join(entered, [*keys, "__slice"])
    return known.select(*keys, F.explode(keep("__ts", "__first")).alias(at))


def boundaries_to_spans(points: DataFrame, keys: Sequence[str], at: str, end: Column) -> DataFrame:
    w = _order(keys, at)
    return points.withColumns({"start": F.col(at), "end": F.coalesce(F.lead(at).over(w), end)})


def resolved(rows: DataFrame, keys: Sequence[str], score: str, tie: str = "ord") -> DataFrame:
    """Of neighbouring spans that overlap, the higher score stays; the earlier one on a tie."""
    w = _order(keys, "start", tie)
    with_near = rows.withColumns({"__pe": F.lag("end").over(w), "__ps": F.lag(score).over(w), "__ns": F.lead("start").over(w), "__nq": F.lead(score).over(w)})
    lost = (F.col("start") < F.col("__pe")) & (F.col(score) <= F.col("__ps"))
    beaten = (F.col("__ns") < F.col("end")) & (F.col("__nq") > F.col(score))
    return with_near.where(~F.coalesce(lost, F.lit(False)) & ~F.coalesce(beaten, F.lit(False))).drop("__pe", "__ps", "__ns", "__nq")


def smoothed(rows: DataFrame, keys: Sequence[str], label: str, score: str, *order, reach: int = 3) -> DataFrame:
    """0.7 of the score and 0.3 of the mean of the same label's scores within ``reach`` rows."""
    w = _order(keys, *order)
    near = [(F.lag(score, k).over(w), F.lag(label, k).over(w)) for k in range(1, reach + 1)] + [(F.lead(score, k).over(w), F.lead(label, k).over(w)) for k in range(1, reach + 1)]
    same = [F.when(lab == F.col(label), s) for s, lab in near]
    total, n = sum((F.coalesce(s, F.lit(0.0)) for s in same), F.lit(0.0)), sum((s.isNotNull().cast("int") for s in same), F.lit(0))
    return rows.withColumn("smooth", F.when(n > 0, F.col(score) * 0.7 + total / n * 0.3).otherwise(F.col(score)))


def every(rows: DataFrame, keys: Sequence[str], step: int, *order) -> DataFrame:
    return rows.withColumn("__n", F.row_number().over(_order(keys, *order)) - 1).where(F.col("__n") % step == 0).drop("__n")


def linspace_capped(rows: DataFrame, keys: Sequence[str], limit: int, *order) -> DataFrame:
    """At most ``limit`` rows at evenly spaced places, first and last kept."""
    w = _order(keys, *order)
    n = F.count("*").over(Window.partitionBy(*keys))
    numbered = rows.withColumns({"__i": F.row_number().over(w) - 1, "__n": n})
    last = max(limit - 1, 1)
    # place i is kept if it is floor(j * (n - 1) / last) for some j
    j = F.ceil(F.col("__i") * last / (F.col("__n") - 1))
    hit = F.floor(j * (F.col("__n") - 1) / last) == F.col("__i")
    return numbered.where((F.col("__n") <= limit) | hit).drop("__i", "__n")


def density_schedule(videos: DataFrame, dialogues: DataFrame, fps: float, micro: int = 1_000_000) -> DataFrame:
    """Frame times: tenth-second ticks hold base density, raised near dialogue by its importance; a frame is due at the tick where the running sum passes a whole number.

    Ticks between two dialogue bounds have one density, so sums run over such spans and
    only due ticks are made. Densities are whole millionths, so running sums are exact.
    """
    from .intervals import point_join

    ends = videos.select("video_id", (F.floor(F.col("duration") * 10) + 1).alias("n"))
    tick = lambda c, f: F.least(F.greatest(f(F.round(c * 10, 6)), F.lit(0)), F.col("n"))
    near = dialogues.join(ends, "video_id").select("video_id", tick(F.col("start") - 2, F.ceil).alias("a"), (tick(F.col("end") + 2, F.floor) + 1).alias("b"), "importance", "n")
    near = near.withColumn("b", F.least("b", "n"))
    cuts = near.select("video_id", F.explode(F.array("a", "b")).alias("s")).unionByName(ends.select("video_id", F.explode(F.array(F.lit(0).cast("bigint"), "n")).alias("s"))).distinct()
    spans = cuts.withColumn("e", F.lead("s").over(_order(["video_id"], "s"))).where("e is not null")
    raised = point_join(spans, near.where("a < b").select("video_id", "a", "b", "importance"), "s", ("a", "b"), 600.0, closed=False).groupBy("video_id", "s").agg(F.max("importance").alias("importance"))
    density = F.round(F.lit(fps * 0.1 * micro) * F.coalesce("importance", F.lit(1.0))).cast("bigint")
    run = spans.join(raised, ["video_id", "s"], "left").withColumn("d", density).where("d > 0")
    total = (F.col("e") - F.col("s")) * F.col("d")
    run = run.withColumn("base", F.sum(total).over(_order(["video_id"], "s").rowsBetween(Window.unboundedPreceding, 0)) - total)
    first, last = F.floor(F.col("base") / micro) + 1, F.floor((F.col("base") + total) / micro)
    due = F.transform(F.sequence(first, last), lambda m: F.col("s") + F.ceil((m * micro - F.col("base")) / F.col("d")) - 1)
    return run.where(last >= first).select("video_id", F.explode(F.array_distinct(due)).alias("k")).select("video_id", (F.col("k") / F.lit(10.0)).alias("t"))
