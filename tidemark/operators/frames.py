"""Frame choice: average-hash dedup, samplers, budgets, and clean-up of face images."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def average_hash(pixels: Column) -> Column:
    """First 16 digits of the MD5 of which pixels (8 x 8 grey values, any count) are over their mean."""
    values = pixels.cast("array<double>")
    mean = F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)
    return F.left(F.md5(F.array_join(F.transform(values, lambda x: F.when(x > mean, "1").otherwise("0")), "")), F.lit(16))


def first_of_hash(frames: DataFrame, pixels: str, *order: str) -> DataFrame:
    """Frames whose hash no earlier frame has, over all videos."""
    hashed = frames.withColumn("hash", average_hash(F.col(pixels)))
    return hashed.withColumn("__k", F.row_number().over(Window.partitionBy("hash").orderBy(*order))).where("__k = 1").drop("__k")


def numbered(frames: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """Frames with their place ``i`` from 0 and the number ``n`` of their video's frames."""
    w = Window.partitionBy(*keys)
    return frames.withColumns({"i": F.row_number().over(w.orderBy(*order)) - 1, "n": F.count("*").over(w)})


def uniform(frames: DataFrame, keys: Sequence[str], target: int, *order: str) -> DataFrame:
    """Every (n div target)-th frame."""
    return numbered(frames, keys, *order).where(F.col("i") % F.greatest(F.lit(1), F.expr(f"n div {target}")) == 0).drop("i", "n")


def best_sampled(frames: DataFrame, keys: Sequence[str], target: int, quality: str, hashed: str, *order: str) -> DataFrame:
    """Of three times as many sampled frames, without repeats of a hash, the ``target`` of highest quality."""
    some = numbered(frames, keys, *order).where(F.col("i") % F.greatest(F.lit(1), F.expr(f"n div {3 * target}")) == 0)
    fresh = some.withColumn("__k", F.row_number().over(Window.partitionBy(*keys, hashed).orderBy(*order))).where("__k = 1")
    best = fresh.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(quality), *order)))
    return best.where(F.col("__k") <= target).drop("__k", "i", "n")


def at_changes(frames: DataFrame, keys: Sequence[str], fps: float, value: str, threshold: float, *order: str) -> DataFrame:
    """Of five samples a second, those whose value differs from the sample before by more than the threshold."""
    some = numbered(frames, keys, *order).where(F.col("i") % max(1, int(fps / 5)) == 0)
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    return some.withColumn("__c", F.abs(F.col(value) - before)).where(F.col("__c") > threshold).drop("__c", "i", "n")


def budgeted(frames: DataFrame, keys: Sequence[str], said: Column, budget: int, *order: str) -> DataFrame:
    """At most ``budget`` frames a video: all of dialogue and a stride of the others; or a stride of dialogue, if that alone is too much."""
    w = Window.partitionBy(*keys, "__said")
    rows = frames.withColumn("__said", said)
    rows = rows.withColumn("__d", F.count_if("__said").over(Window.partitionBy(*keys))).withColumns({"__m": F.count("*").over(w), "__i": F.row_number().over(w.orderBy(*order)) - 1})
    room = F.when(F.col("__said"), F.lit(budget)).otherwise(F.lit(budget) - F.col("__d"))
    step = F.greatest(F.lit(1), F.floor(F.try_divide(F.col("__m"), room)))
    strided = (room > 0) & (F.col("__i") % step == 0) & (F.floor(F.col("__i") / step) < room)
    return rows.where(F.when(F.col("__said") & (F.col("__d") <= budget), True).otherwise(F.coalesce(strided, F.lit(False)))).drop("__said", "__d", "__m", "__i")


# ---- clean-up of grey images -----------------------------------------------------------


def _around(image: np.ndarray, reach: int) -> np.ndarray:
    """The (2 * reach + 1) ** 2 neighbours of each pixel, edges mirrored."""
    wide = np.pad(image, reach, mode="reflect" if min(image.shape) > reach else "edge")
    size = 2 * reach + 1
    return np.lib.stride_tricks.sliding_window_view(wide, (size, size)).reshape(*image.shape, size * size)


def equalised(image: np.ndarray, tiles: int = 8, clip: float = 3.0) -> np.ndarray:
    """Contrast-limited histogram equalisation by tiles, maps blended between tile centres."""
    h, w = image.shape
    rows, cols = min(tiles, h), min(tiles, w)
    edges_y, edges_x = np.linspace(0, h, rows + 1).astype(int), np.linspace(0, w, cols + 1).astype(int)
    maps = np.empty((rows, cols, 256))
    for i in range(rows):
        for j in range(cols):
            part = image[edges_y[i] : edges_y[i + 1], edges_x[j] : edges_x[j + 1]]
            count = np.bincount(part.ravel().astype(int), minlength=256).astype(float)
            most = max(1.0, clip * part.size / 256)
            over = np.clip(count - most, 0, None).sum()
            maps[i, j] = np.cumsum(np.minimum(count, most) + over / 256) * 255 / part.size
    y = np.interp(np.arange(h), (edges_y[:-1] + edges_y[1:] - 1) / 2, np.arange(rows))
    x = np.interp(np.arange(w), (edges_x[:-1] + edges_x[1:] - 1) / 2, np.arange(cols))
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, rows - 1), np.minimum(x0 + 1, cols - 1)
    fy, fx, v = (y - y0)[:, None], (x - x0)[None, :], image.astype(int)
    at = lambda a, b: maps[a[:, None], b[None, :], v]
    return (at(y0, x0) * (1 - fy) + at(y1, x0) * fy) * (1 - fx) + (at(y0, x1) * (1 - fy) + at(y1, x1) * fy) * fx


def enhanced(image: np.ndarray, contrast: bool = True, denoise: bool = True, sharpen: bool = True, least: int = 64) -> np.ndarray:
    """A grey image (0..255): enlarged to ``least`` pixels, denoised (median), equalised, sharpened, and its brightness mended."""
    h, w = image.shape
    if h < least or w < least:
        scale = max(least / h, least / w)
        y, x = (np.linspace(0, n - 1, int(n * scale)) for n in (h, w))
        rows = np.stack([np.interp(y, np.arange(h), image[:, j]) for j in range(w)], 1)
        image = np.stack([np.interp(x, np.arange(w), r) for r in rows])
    image = np.clip(np.round(image), 0, 255)
    if denoise and min(image.shape) >= 5:
        image = np.median(_around(image, 1), axis=2)
    if contrast:
        image = np.clip(np.round(equalised(image)), 0, 255)
    if sharpen:
        image = np.clip(10 * image - _around(image, 1).sum(2), 0, 255)  # 9 in the middle, -1 around
    if image.mean() < 60:
        image = np.clip(1.5 * image + 30, 0, 255)
    elif image.mean() > 200:
        image = np.clip(0.8 * image - 20, 0, 255)
    return np.round(image)


def enhanced_pixels(width: int, **how):
    """A column function: grey pixels (row by row) to (width, pixels, error) of the enhanced image."""

    @pandas_udf("struct<width:int,pixels:array<float>,error:string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for images in batches:
            rows = []
            for pixels in images:
                try:
                    got = enhanced(np.asarray(pixels, float).reshape(-1, width), **how)
                    rows.append((got.shape[1], got.ravel().astype(np.float32), None))
                except (TypeError, ValueError) as e:
                    rows.append((None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["width", "pixels", "error"])

    return run
