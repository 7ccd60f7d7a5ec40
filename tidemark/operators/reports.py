"""Aggregates: speakers, matches, coverage, captions, emotions, transcripts, shots, attributes, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import EMOTIONS, STOPWORDS, word_list


def speaker_stats(turns: DataFrame, videos: DataFrame) -> DataFrame:
    """Per speaker: time, share of the video, turns."""
    sums = turns.groupBy("video_id", "speaker_id").agg(F.sum(F.col("end") - F.col("start")).alias("seconds"), F.count("*").alias("turns"))
    return sums.join(videos.select("video_id", "duration"), "video_id").select("video_id", "speaker_id", "seconds", "turns", F.coalesce(F.try_divide(F.col("seconds") * 100, F.col("duration")), F.lit(0.0)).alias("percent"))


def match_summary(matches: DataFrame) -> DataFrame:
    """Totals, rate and the histogram of confidence levels, with zero bins."""
    hit = F.col("character_id").isNotNull()
    return matches.groupBy("video_id").agg(
        F.count("*").alias("total"), F.count_if(hit).alias("matched"), F.coalesce(F.try_divide(F.count_if(hit).cast("double"), F.count("*")), F.lit(0.0)).alias("rate"),
        F.count_if(F.col("final") >= 0.8).alias("high"), F.count_if((F.col("final") >= 0.5) & (F.col("final") < 0.8)).alias("medium"), F.count_if(F.col("final") < 0.5).alias("low"), F.avg("final").alias("mean"),
    )


def coverage_bins(points: DataFrame, videos: DataFrame) -> DataFrame:
    """Share of a video's seconds with a point."""
    bins = points.groupBy("video_id").agg(F.count_distinct(F.floor("ts")).alias("bins"))
    return bins.join(videos.select("video_id", "duration"), "video_id").select("video_id", (F.col("bins") / (F.col("duration").cast("int") + 1)).alias("coverage"))


def coverage_stats(spans: DataFrame, videos: DataFrame) -> DataFrame:
    """Covered time (overlaps count twice), share and mean, rounded to 2."""
    length = F.greatest(F.lit(0.0), F.col("end") - F.col("start"))
    sums = spans.groupBy("video_id").agg(F.count("*").alias("segments"), F.sum(length).alias("covered"), F.avg(length).alias("mean"))
    return sums.join(videos.select("video_id", "duration"), "video_id").select("video_id", "segments", F.round("covered", 2).alias("covered"), F.round("mean", 2).alias("mean"), F.round(F.try_divide(F.col("covered") * 100, F.col("duration")), 2).alias("percent"))


def caption_quality(captions: DataFrame, text: str = "text") -> DataFrame:
    """Lengths and shares of captions with a quotation, an emotion word or a transition word."""
    t = F.col(text)
    words, low = F.size(word_list(t)), F.lower(t)
    felt = F.lit(False)
    for e in EMOTIONS[1:]:
        felt = felt | F.contains(low, F.lit(e))
    turn = F.contains(low, F.lit("then")) | F.contains(low, F.lit("while")) | F.contains(low, F.lit("after"))
    share = lambda c: F.round(F.count_if(c) * 100.0 / F.count("*"), 6)
    return captions.agg(
        F.count("*").alias("n"), F.round(F.avg(words), 6).alias("mean_words"), F.median(words).alias("median_words"), F.min(words).alias("min_words"), F.max(words).alias("max_words"), F.round(F.avg(F.length(t)), 6).alias("mean_chars"),
        share(F.contains(t, F.lit('"'))).alias("quote_pct"), share(felt).alias("emotion_pct"), share(turn).alias("transition_pct"), F.sum(F.greatest(F.lit(1), F.regexp_count(t, F.lit("[.!?]+")))).alias("sentences"),
    )


def emotion_chunks(chunks: DataFrame, keys: list[str], how: str = "mean") -> DataFrame:
    """Chunk labels folded to one: mean confidence per label, the label of the largest, or weighted; under 0.5 it is neutral."""
    n = F.count("*").over(Window.partitionBy(*keys))
    value = {"mean": F.sum("confidence") / F.first("n"), "max": F.max("confidence"), "weighted": F.try_divide(F.sum(F.col("confidence") * F.col("confidence")), F.sum("confidence"))}[how]
    place = F.array_position(F.array(*[F.lit(e) for e in EMOTIONS]), F.col("emotion"))
    by = chunks.withColumn("n", n).groupBy(*keys, "emotion").agg(value.alias("v"))
    top = by.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("v"), place))).where("k = 1")
    return top.select(*keys, F.when(F.col("v") < 0.5, "neutral").otherwise(F.col("emotion")).alias("emotion"), F.when(F.col("v") < 0.5, 1 - F.col("v")).otherwise(F.col("v")).alias("confidence"))


def word_frequency(rows: DataFrame, text: str, top: int = 20) -> DataFrame:
    """The commonest words over two letters that are no stopwords; ties by word."""
    words = rows.select(F.explode(word_list(F.lower(F.col(text)))).alias("word")).where((F.length("word") > 2) & ~F.col("word").isin(STOPWORDS))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(top)


def duration_bucket(length: Column) -> Column:
    return F.when(length < 2, "0-2").when(length < 5, "2-5").when(length < 10, "5-10").when(length < 20, "10-20").otherwise("20+")


def attributes(rows: DataFrame) -> DataFrame:
    """Per character: statistics of a number (population deviation) and the commonest label."""
    labels = rows.groupBy("character_id", "emotion").agg(F.count("*").alias("n"))
    top = labels.withColumn("k", F.row_number().over(Window.partitionBy("character_id").orderBy(F.desc("n"), "emotion"))).where("k = 1").select("character_id", F.col("emotion").alias("dominant"), F.col("n").alias("dominant_n"))
    stats = rows.groupBy("character_id").agg(F.avg("confidence").alias("mean"), F.median("confidence").alias("median"), F.stddev_pop("confidence").alias("std"), F.min("confidence").alias("low"), F.max("confidence").alias("high"))
    return stats.join(top, "character_id")


def checks(rows: DataFrame, rules: dict[str, Column], key: str = "video_id") -> DataFrame:
    """Per key: rows, how many break each rule, and whether none does."""
    bad = {name: F.count_if(~F.coalesce(ok, F.lit(False))) for name, ok in rules.items()}
    out = rows.groupBy(key).agg(F.count("*").alias("rows"), *[c.alias(f"bad_{n}") for n, c in bad.items()])
    valid = sum((F.col(f"bad_{n}") for n in rules), F.lit(0)) == 0
    return out.withColumn("valid", valid)


def findings(row: DataFrame, rules: dict[str, Column], name: str = "issues") -> DataFrame:
    """Rows with the list of rules that fire."""
    return row.withColumn(name, F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()])))
