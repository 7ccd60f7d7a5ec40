"""Vector, box and landmark functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector is zero."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def centred_cosine(a: Column, b: Column) -> Column:
    """(cos + 1) / 2, the similarity that face matching compares with 0.7."""
    return (cosine(a, b) + 1) / 2


def box_area(b: Column) -> Column:
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])


def box_iou(a: Column, b: Column) -> Column:
    w = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    return F.coalesce(F.try_divide(w * h, box_area(a) + box_area(b) - w * h), F.lit(0.0))


def box_to_state(b: Column) -> Column:
    """(cx, cy, area, aspect) of corners."""
    w, h = b["x2"] - b["x1"], b["y2"] - b["y1"]
    return F.struct((b["x1"] + w / 2).alias("cx"), (b["y1"] + h / 2).alias("cy"), (w * h).alias("area"), F.try_divide(w, h).alias("aspect"))


def state_to_box(s: Column) -> Column:
    w = F.sqrt(s["area"] * s["aspect"])
    h = F.try_divide(s["area"], w)
    return F.struct((s["cx"] - w / 2).alias("x1"), (s["cy"] - h / 2).alias("y1"), (s["cx"] + w / 2).alias("x2"), (s["cy"] + h / 2).alias("y2"))


def centre_distance(b: Column, width: float, height: float) -> Column:
    """Distance of a box's centre from the frame's, both in unit coordinates."""
    cx, cy = (b["x1"] + b["x2"]) / 2 / width, (b["y1"] + b["y2"]) / 2 / height
    return F.sqrt((cx - 0.5) * (cx - 0.5) + (cy - 0.5) * (cy - 0.5))


def centrality(b: Column, width: float = 640.0, height: float = 480.0) -> Column:
    return (box_area(b) / (width * height) + 1 - F.least(centre_distance(b, width, height), F.lit(1.0))) / 2


def side(b: Column) -> Column:
    """left, center or right by the centre's x over 640 pixels."""
    x = (b["x1"] + b["x2"]) / 2
    return F.when(x < 213, "left").when(x < 427, "center").otherwise("right")


def chi_square(a: Column, b: Column) -> Column:
    part = F.zip_with(a, b, lambda x, y: F.coalesce(F.try_divide((x - y) * (x - y), x + y), F.lit(0.0)))
    return F.aggregate(part, F.lit(0.0), lambda s, x: s + x)


def mean_abs_diff(a: Column, b: Column) -> Column:
    return F.try_divide(F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x), F.size(a))


def mean_square_diff(a: Column, b: Column) -> Column:
    same = F.when(F.size(a) != F.size(b), F.raise_error(F.lit("frames differ in shape")).cast("double"))
    return F.coalesce(same, F.try_divide(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x), F.size(a)))


def scene_change(hist_a: Column, hist_b: Column, pixels_a: Column, pixels_b: Column) -> Column:
    return chi_square(hist_a, hist_b) * 0.5 + mean_abs_diff(pixels_a, pixels_b) * 0.5


def ema(vectors: Column, alpha: float = 0.3) -> Column:
    """Exponential average of an ordered list of vectors, normalised at each step."""

    def step(old, new):
        mixed = F.zip_with(old, new, lambda x, y: x * (1 - alpha) + y * alpha)
        size = norm(mixed)
        return F.transform(mixed, lambda x: F.coalesce(F.try_divide(x, size), x))

    doubles = F.transform(vectors, lambda v: v.cast("array<double>"))
    return F.aggregate(F.slice(doubles, F.lit(2), F.greatest(F.size(doubles) - 1, F.lit(0))), F.get(doubles, F.lit(0)), step)


def mouth_ratio(points: Column) -> Column:
    """Mouth aspect ratio of 68 landmarks (x, y); 0.15 of five; 0 otherwise."""

    def gap(i, j):
        a, b = F.get(points, F.lit(i)), F.get(points, F.lit(j))
        return F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))

    ratio = F.try_divide(gap(61, 67) + gap(62, 66) + gap(63, 65), gap(60, 64) * 3)
    return F.when(F.size(points) == 68, F.coalesce(ratio, F.lit(0.0))).when(F.size(points) == 5, F.lit(0.15)).otherwise(F.lit(0.0))
