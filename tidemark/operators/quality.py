"""Quality expressions, parameters and decisions over metric columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def importance(start: Column, end: Column, confidence: Column, emotion: Column) -> Column:
    v = F.lit(1.0) * F.when(end - start > 3, 1.2).otherwise(1.0) * F.when(confidence > 0.8, 1.1).otherwise(1.0) * F.when(emotion != "neutral", 1.1).otherwise(1.0)
    return F.least(F.lit(2.0), v)


def face_quality(score: Column, pose: tuple[Column, Column, Column], size: Column) -> Column:
    angles = sum((F.abs(p) for p in pose), F.lit(0.0))
    return score * (1 - angles / 270) * (F.lit(0.5) + F.least(size / 112, F.lit(1.0)) * 0.5)


def frame_quality(blur: Column, contrast: Column, brightness: Column, edges: Column | None = None) -> Column:
    """0.4/0.2/0.2/0.2 with an edge measure, 0.5/0.3/0.2 without."""
    return blur * 0.5 + contrast * 0.3 + brightness * 0.2 if edges is None else blur * 0.4 + contrast * 0.2 + brightness * 0.2 + edges * 0.2


def face_assessment(size: Column, blur: Column, brightness: Column, contrast: Column) -> Column:
    return size * 0.3 + blur * 0.3 + brightness * 0.2 + contrast * 0.2


def suggested_config(brightness: Column, motion: Column, cuts: Column, faces: Column) -> Column:
    return F.when(brightness < 0.3, "dark").when((motion > 0.7) | (cuts > 30), "action").when(cuts < 5, "dialogue").when(faces > 5, "crowd").otherwise("default")


def speech_model(duration: Column) -> Column:
    return F.when(duration < 300, "base").when(duration < 1800, "small").otherwise("base")


def match_window(density: Column) -> Column:
    """Seconds of the matching window for detections a minute."""
    return F.when(density < 1, 60).when(density < 5, 30).when(density < 10, 10).otherwise(5)


def coverage_targets(dialogues: Column, minutes: Column) -> tuple[Column, Column]:
    """(coverage target, least frames) for a number of dialogues."""
    dense = F.coalesce(F.try_divide(dialogues.cast("double"), minutes), F.lit(0.0)) > 20
    return F.when(dense, 0.6).otherwise(0.7), F.when(dense, F.greatest(F.lit(50), dialogues * 2)).otherwise(F.greatest(F.lit(100), dialogues * 3))


def calibration(context: DataFrame) -> DataFrame:
    """Matcher parameters of each video from its densities a minute."""
    c, d = F.col("character_density"), F.col("dialogue_density")
    return context.withColumns({
        "confidence_scale": F.when(c < 1, 0.9).when(c > 10, 1.2).otherwise(1.0),
        "window": F.when(d > 20, 10.0).when(d < 5, 60.0).otherwise(30.0),
        "continuity_weight": F.when(F.col("duration") > 600, 0.3).otherwise(0.1),
    })


def issues(codec: Column, width: Column, height: Column, fps: Column) -> Column:
    """What may hinder processing of a video, in a list."""
    return F.array_compact(F.array(F.when(codec.isin("av1", "vp8"), "codec"), F.when((width < 640) | (height < 480), "resolution"), F.when(fps < 15, "frame rate")))


def codec_support(codec: Column) -> Column:
    """true, false, or null where nobody knows."""
    return F.when(codec.isin("h264", "mpeg4", "mjpeg", "hevc"), True).when(codec.isin("av1", "vp8", "vp9"), False)


def keyframe_time(start: Column, end: Column, where: Column) -> Column:
    bad = F.raise_error(F.concat(F.lit("unknown place: "), where)).cast("double")
    return F.when(where == "middle", (start + end) / 2).when(where == "first", start + 0.1).when(where == "last", end - 0.1).otherwise(bad)


def resized(width: Column, height: Column, most_w: int, most_h: int) -> tuple[Column, Column]:
    """Size that fits the frame with the aspect kept; never enlarged."""
    scale = F.least(F.lit(float(most_w)) / width, F.lit(float(most_h)) / height, F.lit(1.0))
    return (width * scale).cast("int"), (height * scale).cast("int")


def even_width(width: Column, height: Column, target_height: int) -> Column:
    """Width at a target height, rounded down to an even number."""
    w = (width.cast("double") * target_height / height).cast("int")
    return w - w % 2


def size_reduction(before: Column, after: Column) -> Column:
    return (1 - F.try_divide(after.cast("double"), before)) * 100


def region(box: Column, margin: float, width: float, height: float) -> Column:
    """The box with a margin of its size on each side, inside the frame."""
    mw, mh = (box["x2"] - box["x1"]) * margin, (box["y2"] - box["y1"]) * margin
    return F.struct(F.greatest(F.lit(0.0), box["x1"] - mw).alias("x1"), F.greatest(F.lit(0.0), box["y1"] - mh).alias("y1"), F.least(F.lit(width), box["x2"] + mw).alias("x2"), F.least(F.lit(height), box["y2"] + mh).alias("y2"))


def audio_slice(samples: Column, start: Column, end: Column, rate: int, least: int = 400) -> Column:
    """Samples of [start, end): none for an empty span, widened about its middle under 25 ms, padded with zeros."""
    short = (end - start) < 0.025
    a = F.when(short, F.greatest(F.lit(0.0), (start + end) / 2 - 0.0125)).otherwise(start)
    b = F.when(short, (start + end) / 2 + 0.0125).otherwise(end)
    i, j = (a * rate).cast("int"), (b * rate).cast("int")
    cut = F.slice(samples, i + 1, F.greatest(j - i, F.lit(0)))
    pad = F.array_repeat(F.lit(0.0), F.greatest(F.lit(least) - F.size(cut), F.lit(0)))
    return F.when(end <= start, F.array().cast("array<double>")).otherwise(F.concat(cut.cast("array<double>"), pad))
