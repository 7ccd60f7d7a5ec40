"""Attributes of characters and speech from lip movement."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import first_by

#: Bins of a pass over a key's values, passes, rows of a lip history and the least of it.
BINS, PASSES, HISTORY, SHORTEST = 4096, 3, 15, 3


def exact_median(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, median) without holding a key's values: equal values are counted first, then passes of BINS bins close in on the middle ranks.

    Bins run from the smallest to the largest value that is left, so values that share
    leading digits are parted as well; what is left after PASSES passes is put in order.
    Nulls do not count; a key without values has no row.
    """
    keys = list(keys)
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    n = F.col("__all")
    ranks = F.array_distinct(F.array(F.floor((n - 1) / 2), F.floor(n / 2)))  # from 0
    left = counts.groupBy(*keys).agg(F.sum("__n").alias("__all"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    left = left.select(*keys, "__lo", "__hi", F.explode(ranks).alias("__rank")).withColumn("__skip", F.col("__rank"))
    for step in range(PASSES + 1):
        near = counts.join(left, keys).where(F.col("__v").between(F.col("__lo"), F.col("__hi")))
        share = F.coalesce(F.try_divide(F.col("__v") - F.col("__lo"), F.col("__hi") - F.col("__lo")), F.lit(0.0))
        bin_ = F.least(F.lit(BINS - 1), F.floor(share * BINS)).cast("double") if step < PASSES else F.col("__v")
        bins = near.groupBy(*keys, "__rank", "__skip", bin_.alias("__bin")).agg(F.sum("__n").alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        upto = F.sum("__n").over(Window.partitionBy(*keys, "__rank").orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0))
        hit = bins.withColumn("__upto", upto).where((F.col("__upto") > F.col("__skip")) & (F.col("__upto") - F.col("__n") <= F.col("__skip")))
        left = hit.select(*keys, "__rank", (F.col("__skip") - F.col("__upto") + F.col("__n")).alias("__skip"), "__lo", "__hi")
    return left.groupBy(*keys).agg(F.avg("__lo").alias("median"))


def profiles(analyses: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attributes of each key over its analyses (age, gender, gender_confidence, emotions and races as maps of scores).

    genders: frequency and mean confidence by gender; emotions: mean, largest score and share
    of scores over 0.1 by emotion; races: mean score and frequency; the gender met most often
    and the emotion and race of the highest mean, the first name of equal ones. Map entries are
    added up in the tasks that read them, so a hot key sends a few rows a task. A null map
    has no entries, a null gender or score does not count.
    """
    keys = list(keys)
    entry = lambda kind, name, score: F.struct(F.lit(kind).alias("kind"), name.alias("name"), score.cast("double").alias("score"))
    of_map = lambda kind, c: F.transform(F.map_entries(F.coalesce(F.col(c), F.create_map().cast("map<string,double>"))), lambda e: entry(kind, e["key"], e["value"]))
    listed = F.concat(F.array(entry("gender", F.col("gender"), F.col("gender_confidence"))), of_map("emotion", "emotions"), of_map("race", "races"))
    parts = analyses.select(*keys, F.explode(listed).alias("e")).where("e.name is not null and e.score is not null").groupBy(*keys, "e.kind", "e.name")
    parts = parts.agg(F.count("*").alias("n"), F.avg("e.score").alias("mean"), F.max("e.score").alias("most"), F.count_if(F.col("e.score") > 0.1).alias("clear"))
    ages = analyses.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("age").alias("age_mean"), F.stddev_pop("age").alias("age_std"), F.min("age").alias("age_min"), F.max("age").alias("age_max"))
    known = parts.join(ages.select(*keys, F.col("n").alias("all")), keys)
    value = F.struct((F.col("n") / F.col("all")).alias("frequency"), F.col("mean").alias("mean"), F.col("most").alias("most"), (F.col("clear") / F.col("all")).alias("clear"))

    def table(kind: str, fields: Sequence[str]) -> Column:
        pairs = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("name", value.alias("v")))))
        return F.transform_values(F.map_from_entries(pairs), lambda _, v: F.struct(*(v[f].alias(f) for f in fields)))

    def top(kind: str, by: Column) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.struct((-by).alias("v"), "name")))["name"]

    maps = known.groupBy(*keys).agg(
        table("gender", ("frequency", "mean")).alias("genders"), table("emotion", ("mean", "most", "clear")).alias("emotions"), table("race", ("mean", "frequency")).alias("races"),
        top("gender", F.col("n").cast("double")).alias("dominant_gender"), top("emotion", F.col("mean")).alias("dominant_emotion"), top("race", F.col("mean")).alias("dominant_race"),
    )
    medians = exact_median(analyses, keys, "age").withColumnRenamed("median", "age_median")
    return ages.join(medians, keys, "left").join(maps, keys, "left")


def regular(history: np.ndarray) -> np.ndarray:
    """Whether each row (a lip history of five values or more) opens and closes regularly: two peaks or more, spaced with a variation under a half.

    A peak is a rise, a level stretch of any length and a fall; it stands in the stretch's
    middle and counts from the mean and half a deviation on.
    """
    n, width = history.shape
    if width < 5:
        return np.zeros(n, bool)
    high = history.mean(1) + 0.5 * history.std(1)
    rise = np.full(n, -1)
    peak = np.zeros((n, width), bool)
    for j in range(1, width):
        up, down = history[:, j] > history[:, j - 1], history[:, j] < history[:, j - 1]
        at = np.flatnonzero(down & (rise >= 0))
        peak[at, (rise[at] + j - 1) // 2] = True
        rise = np.where(up, j, np.where(down, -1, rise))
    peak &= history >= high[:, None]
    last, gaps, total, squares = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j in range(width):
        at = peak[:, j] & (last >= 0)
        gap = np.where(at, j - last, 0)
        gaps, total, squares = gaps + at, total + gap, squares + gap * gap
        last = np.where(peak[:, j], j, last)
    return (gaps > 0) & (4 * (gaps * squares - total * total) < total * total)


def lip_decisions(rows: DataFrame, order: Sequence[str] = ("ts", "ord"), moving: float = 0.1) -> DataFrame:
    """Rows (video_id, character_id, ts, ord, mar, movement) with what the character's last HISTORY rows tell.

    mar_mean, mar_std, movement_mean, regular, score (mouth varies 0.3, is open 0.2, moves more
    than ``moving`` 0.3, regular peaks 0.2; 0 with fewer than SHORTEST rows), speaking (score over 0.5), and
    since, the time of the history's first row.
    """
    w = Window.partitionBy("video_id", "character_id").orderBy(*order).rowsBetween(1 - HISTORY, 0)

    @F.pandas_udf("boolean")
    def peaks(histories: pd.Series) -> pd.Series:
        out = np.zeros(len(histories), bool)
        sizes = histories.map(len).to_numpy()
        for n in np.unique(sizes):
            some = np.flatnonzero(sizes == n)
            out[some] = regular(np.stack([histories.iloc[k] for k in some]).astype(float))
        return pd.Series(out)

    known = rows.withColumns({
        "mar_mean": F.avg("mar").over(w), "mar_std": F.stddev_pop("mar").over(w), "movement_mean": F.avg("movement").over(w),
        "since": F.first("ts").over(w), "__rows": F.count("*").over(w), "__mars": F.collect_list("mar").over(w),
    }).withColumn("regular", peaks("__mars"))
    term = lambda c, v: F.when(c, v).otherwise(0.0)
    score = term(F.col("mar_std") > 0.02, 0.3) + term(F.col("mar_mean") > 0.15, 0.2) + term(F.col("movement_mean") > moving, 0.3) + term(F.col("regular"), 0.2)
    scored = known.withColumn("score", F.when(F.col("__rows") < SHORTEST, 0.0).otherwise(F.least(score, F.lit(1.0))))
    return scored.withColumn("speaking", F.col("score") > 0.5).drop("__rows", "__mars")


def active_speakers(decisions: DataFrame, frame: str = "frame") -> DataFrame:
    """(video_id, frame, character_id, score, start, end): who speaks in each frame by ``lip_decisions``, the best score and the first name of equal ones, and the time of that history."""
    best = first_by(decisions.where("speaking"), ["video_id", frame], F.desc("score"), "character_id")
    return best.select("video_id", frame, "character_id", "score", F.col("since").alias("start"), F.col("ts").alias("end"))
