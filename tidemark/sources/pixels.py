"""Uncompressed video as rows, and cuts on its pixels.

A Y4M clip is a header line and frames of one size, so a frame's place is known without
reading those before it. A clip is one binary value (a file by Spark's reader of binary
files, or a row of a table); its wanted frames are cut into ranges of bytes by Spark's own
expressions, and the ranges are dealt over tasks. ``start``, ``end`` and ``step`` are part of that
plan: bytes of frames that are not wanted go no further than the reader.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sessions import boundaries_kept

#: Frames of a range, bytes of a clip's first line at most, and bins of a histogram.
RANGE, HEAD, BINS = 256, 256, 16
#: Content score over the mean of WINDOW frames to each side, least score, and the ratio where that mean is 0.
ADAPTIVE, WINDOW, FLOOR, MOST = 3.0, 2, 15.0, 255.0
_MARK = "FRAME\n"


def y4m_bytes(frames: list[np.ndarray], fps: int = 25, chroma: str = "mono") -> bytes:
    """A Y4M clip of luma planes of one size; chroma planes, if any, are grey."""
    height, width = frames[0].shape if frames else (2, 2)
    rest = bytes([128]) * int(width * height * ({"420": 1.5, "422": 2.0, "444": 3.0}.get(chroma, 1.0) - 1))
    return b"".join([f"YUV4MPEG2 W{width} H{height} F{fps}:1 Ip A1:1 C{chroma}\n".encode(), *(_MARK.encode() + f.astype(np.uint8).tobytes() + rest for f in frames)])


def read_clips(spark: SparkSession, folder: str, pattern: str = "*.y4m") -> DataFrame:
    """(name, content) of the files of a folder; a file may have 2 GB."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "content")


def headers(clips: DataFrame) -> DataFrame:
    """Clips (name, content) with at (bytes of the first line), width, height, fps, size (bytes of a frame) and n (whole frames).

    A null content has no frames; another one that is not Y4M is an error that names the clip.
    """
    line = F.substring_index(F.decode(F.substring("content", 1, HEAD), "ISO-8859-1"), "\n", 1)
    bad = F.raise_error(F.concat(F.col("name"), F.lit(": not a Y4M clip"))).cast("string")
    line = F.when(line.startswith("YUV4MPEG2 ") & (F.length(line) < HEAD), line).when(line.isNotNull(), bad)
    tag = lambda t, pattern: F.nullif(F.regexp_extract("line", f" {t}{pattern}", 1), F.lit(""))
    kind = tag("C", r"(mono|\d{3})")
    planes = F.when(kind == "mono", 1.0).when(kind == "422", 2.0).when(kind == "444", 3.0).otherwise(1.5)
    known = clips.withColumn("line", line).withColumns({
        "at": F.length("line") + 1, "width": tag("W", r"(\d+)").cast("int"), "height": tag("H", r"(\d+)").cast("int"),
        "fps": F.coalesce(F.try_divide(tag("F", r"(\d+):").cast("double"), tag("F", r"\d+:(\d+)").cast("double")), F.lit(25.0)),
    })
    known = known.withColumn("size", (F.length(F.lit(_MARK)) + F.floor(F.col("width") * F.col("height") * planes)).cast("long"))
    return known.withColumn("n", F.coalesce(F.floor((F.octet_length("content") - F.col("at")) / F.col("size")), F.lit(0)).cast("long")).drop("line")


def _ranges(clips: DataFrame, start: int, end: int | None, step: int, before: int) -> DataFrame:
    """Ranges of RANGE wanted frames as bytes, with ``before`` frames in front where there are any."""
    known = headers(clips)
    n = F.col("n") if end is None else F.least(F.col("n"), F.lit(end))
    firsts = F.when(n > start, F.sequence(F.lit(start).cast("long"), n - 1, F.lit(RANGE * step).cast("long")))
    cut = known.withColumn("last", n).select("*", F.explode(firsts).alias("first")).withColumn("from", F.greatest(F.col("first") - before, F.lit(0)))
    cut = cut.withColumn("last", F.least("last", F.col("first") + RANGE * step))
    place, many = F.col("at") + F.col("from") * F.col("size") + 1, (F.col("last") - F.col("from")) * F.col("size")
    part = F.substring(F.col("content"), place.cast("int"), many.cast("int"))
    return cut.select("name", "width", "height", "fps", "size", "from", "first", "last", part.alias("part")).repartition("name", "first")


def frames(clips: DataFrame, start: int = 0, end: int | None = None, step: int = 1) -> DataFrame:
    """(name, frame, time, width, height, luma): every ``step``-th frame from ``start`` to before ``end``."""
    rows = _ranges(clips, start, end, step, 0).select("*", F.explode(F.sequence("first", F.col("last") - 1, F.lit(step).cast("long"))).alias("frame"))
    place = ((F.col("frame") - F.col("from")) * F.col("size")).cast("int")
    mark = F.decode(F.substring(F.col("part"), place + 1, F.lit(len(_MARK))), "ISO-8859-1")
    luma = F.substring(F.col("part"), place + len(_MARK) + 1, F.col("width") * F.col("height"))
    checked = F.when(mark == _MARK, luma).otherwise(F.raise_error(F.concat(F.col("name"), F.lit(": no frame at "), F.col("frame").cast("string"))).cast("binary"))
    return rows.select("name", "frame", (F.col("frame") / F.col("fps")).alias("time"), "width", "height", checked.alias("luma"))


SCORES = "name string, frame long, time double, mean double, diff double, hist array<int>"


def scores(clips: DataFrame) -> DataFrame:
    """(name, frame, time, mean, diff, hist) of all frames: mean luma, mean absolute difference to the frame before (null at the first), and a histogram of BINS bins.

    A range brings the frame before it along, so that no frame is exchanged for its neighbour.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, width, height, fps, size, at, first, last, part = (batch.column(c)[i] for c in range(9))
                n, area = last.as_py() - at.as_py(), width.as_py() * height.as_py()
                raw = np.frombuffer(part.as_buffer(), np.uint8).reshape(n, size.as_py())
                if (raw[:, : len(_MARK)] != np.frombuffer(_MARK.encode(), np.uint8)).any():
                    raise ValueError(f"{name.as_py()}: a frame is not where it should be")
                luma = raw[:, len(_MARK) : len(_MARK) + area]
                skip = first.as_py() - at.as_py()
                diff = [None] * (1 - skip) + [float(np.abs(a.astype(np.int16) - b).mean()) for a, b in zip(luma[1:], luma[:-1], strict=True)]
                hist = [np.bincount(f >> 4, minlength=BINS).tolist() for f in luma[skip:]]
                k = np.arange(first.as_py(), last.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(k)), pa.array(k), pa.array(k / fps.as_py()), pa.array(luma[skip:].mean(1)), pa.array(diff, pa.float64()), pa.array(hist, pa.list_(pa.int32()))], ["name", "frame", "time", "mean", "diff", "hist"])

    return _ranges(clips, 0, None, 1, 1).mapInArrow(run, SCORES)


def _spaced(cuts: DataFrame, all_frames: DataFrame, least: int) -> DataFrame:
    """Cuts at least ``least`` frames after the one before; the first frame counts as one and is not told."""
    points = cuts.select("name", F.col("frame").cast("double").alias("frame")).unionByName(all_frames.where("frame = 0").select("name", F.lit(0.0).alias("frame")))
    return boundaries_kept(points, ["name"], "frame", float(least)).where("frame > 0").select("name", F.col("frame").cast("long").alias("frame"))


def content_cuts(scored: DataFrame, threshold: float = 27.0, least: int = 15) -> DataFrame:
    """(name, frame) of cuts: frames whose difference to the one before is ``threshold`` or more."""
    return _spaced(scored.where(F.col("diff") >= threshold), scored, least)


def adaptive_cuts(scored: DataFrame, threshold: float = ADAPTIVE, least: int = 15) -> DataFrame:
    """(name, frame) of cuts: differences of FLOOR or more that are ``threshold`` times the mean of the WINDOW frames to each side; frames without a full window are none."""
    w = Window.partitionBy("name").orderBy("frame").rowsBetween(-WINDOW, WINDOW)
    around: Column = (F.sum("diff").over(w) - F.col("diff")) / (2 * WINDOW)
    known = scored.withColumns({"__n": F.count("diff").over(w), "__around": around})
    ratio = F.when(F.col("__around") > 1e-5, F.least(F.col("diff") / F.col("__around"), F.lit(MOST))).otherwise(MOST)
    return _spaced(known.where((F.col("__n") == 2 * WINDOW + 1) & (F.col("diff") >= FLOOR) & (ratio >= threshold)), scored, least)
