"""Readers: nested JSON documents to flat tables, sessions, keyframes, fixed tilings, synthetic input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import DOCUMENTS, LIST_OF


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def listing(spark: SparkSession, folder: str, endings: tuple[str, ...] = (".json", ".srt", ".vtt", ".html")) -> list[str]:
    """File names under a folder of any file system, by name."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(endings)) if fs.exists(p) else []


def read_document(spark: SparkSession, path: str, kind: str, lines: bool = False) -> DataFrame:
    """Whole documents (one a file, or one a line) with their declared schema; what cannot be parsed is kept in _corrupt_record."""
    return spark.read.schema(DOCUMENTS[kind]).option("multiLine", not lines).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def rows_of(documents: DataFrame, kind: str) -> DataFrame:
    """One row per list element, with aliases settled: start/start_time, shots/contained_shots, dialogue/dialogue_segment."""
    out = documents.select("video_id", F.posexplode(LIST_OF[kind]).alias("ord", "r")).select("video_id", "ord", "r.*")
    if kind in ("shots", "scenes"):
        name = kind[:-1] + "_id"
        out = out.withColumns({name: F.coalesce(name, "id"), "start": F.coalesce("start", "start_time"), "end": F.coalesce("end", "end_time")}).drop("id", "start_time", "end_time")
        if kind == "scenes":
            out = out.withColumn("shots", F.coalesce("contained_shots", "shots")).drop("contained_shots")
        else:
            out = out.withColumn("duration", F.coalesce("duration", F.col("end") - F.col("start")))
    if kind == "d":
        out = out.withColumn("dialogue", F.coalesce("dialogue", "dialogue_segment")).drop("dialogue_segment")
    return out


def characters_of(documents: DataFrame) -> DataFrame:
    """Rows of the character map of C documents; integer keys of nested maps become integers again."""
    rows = documents.select("video_id", F.explode("characters").alias("key", "c")).select("video_id", "key", "c.*")
    return rows.withColumn("scene_appearances", F.map_from_entries(F.transform(F.map_entries("scene_appearances"), lambda e: F.struct(e["key"].cast("int"), e["value"]))))


def read_or_empty(spark: SparkSession, path: str, kind: str, lines: bool = False) -> DataFrame:
    """Rows of a document, or an empty table of its schema where there is no file."""
    if exists(spark, path):
        return rows_of(read_document(spark, path, kind, lines), kind)
    return rows_of(spark.createDataFrame([], DOCUMENTS[kind]), kind)


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """The first path that is there: transcripts with emotions are preferred by listing them first."""
    return next((p for p in paths if exists(spark, p)), None)


def require(spark: SparkSession, path: str, kind: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return rows_of(read_document(spark, path, kind), kind)


def session_stamp(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"session_(\d{8}_\d{6})", 1), F.lit(""))


def session_name(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def latest_session(spark: SparkSession, root: str) -> str | None:
    """The session folder of the latest stamp, by name."""
    fs, p = _fs(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("session_")] if fs.exists(p) else []
    return f"{root}/{max(names)}" if names else None


def session_documents(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Rows of the documents a, b, c, d of the latest session: files ``a.json`` or folders ``a`` of one document a line; a missing one is empty."""
    session = latest_session(spark, root)
    if session is None:
        raise FileNotFoundError(f"no session under {root}")
    out = {}
    for kind in ("a", "b", "c", "d"):
        path = first_existing(spark, [f"{session}/{kind}.json", f"{session}/{kind}"]) or f"{session}/{kind}"
        out[kind] = read_or_empty(spark, path, kind, lines=not path.endswith(".json"))
    return out


def keyframes(spark: SparkSession, folder: str) -> DataFrame:
    """(shot_id, path, length) of keyframe images; their bytes are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(folder).select("path", "length")
    return files.select(F.regexp_extract("path", r"shot_(\d+)", 1).try_cast("int").alias("shot_id"), "path", "length").where("shot_id is not null")


def fallback_scenes(videos: DataFrame, width: int = 30) -> DataFrame:
    """Tiles of ``width`` seconds: int(d / width) + 1 of them, so a whole multiple ends in an empty one."""
    k = F.explode(F.sequence(F.lit(0), F.floor(F.col("duration") / width).cast("int")))
    return videos.select("video_id", "duration", k.alias("k")).select("video_id", (F.col("k") + 1).alias("scene_id"), (F.col("k") * width).cast("double").alias("start"), F.least((F.col("k") + 1) * width, F.col("duration")).cast("double").alias("end"))


def tiles_ceil(videos: DataFrame, width: int = 300, first: int = 3) -> DataFrame:
    """Tiles of ``width`` seconds, ceil(d / width) of them, the last clipped, the first few only."""
    k = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("duration") / width).cast("int") - 1)))
    return videos.select("video_id", "duration", k.alias("k")).where((F.col("k") < first) & (F.col("duration") > 0)).select("video_id", F.col("k").alias("tile"), (F.col("k") * width).cast("double").alias("start"), F.least((F.col("k") + 1) * width, F.col("duration")).cast("double").alias("end"))


def nested_tiles(videos: DataFrame, scene: int = 30, shot: int = 5) -> DataFrame:
    """Scenes of ``scene`` seconds with whole shots of ``shot`` seconds in them; a shorter tail has no shot."""
    scenes = fallback_scenes(videos, scene)
    n = F.floor((F.col("end") - F.col("start")) / shot).cast("int")
    shots = scenes.where(n > 0).withColumn("k", F.explode(F.sequence(F.lit(0), n - 1)))
    return shots.select("video_id", "scene_id", (F.col("k") + 1).alias("shot_id"), (F.col("start") + F.col("k") * shot).alias("start"), (F.col("start") + (F.col("k") + 1) * shot).alias("end"))


def mock_shots(spark: SparkSession) -> DataFrame:
    return spark.range(4).select((F.col("id") + 1).cast("int").alias("shot_id"), (F.col("id") * 30).cast("double").alias("start"), ((F.col("id") + 1) * 30).cast("double").alias("end"))


def mock_scene_count(shots: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(shots / 2)).cast("bigint")


def frame_index(time: Column, fps: Column) -> Column:
    return (time * fps).cast("int")


def frame_at(requests: DataFrame, frames: DataFrame, fps: float) -> DataFrame:
    """Requests (video_id, t) with the frame at that time; null outside the video."""
    wanted = requests.withColumn("frame", frame_index(F.col("t"), F.lit(fps)))
    return wanted.join(frames, ["video_id", "frame"], "left")


def fourcc(code: Column) -> Column:
    """Four characters of a codec number."""
    return F.concat(*[F.chr(F.shiftright(code, 8 * k).bitwiseAND(255).cast("int")) for k in range(4)])


def scene_cuts(frames: DataFrame, threshold: float, least: int) -> DataFrame:
    """Cuts where the difference is over the threshold, ``least`` frames after the last cut kept."""
    from ..operators.sessions import boundaries_kept

    return boundaries_kept(frames.where(F.col("diff") > threshold).withColumn("frame", F.col("frame").cast("double")), ["video_id"], "frame", float(least))


def synthetic(spark: SparkSession, videos: int = 3, minutes: int = 30, seed: int = 7) -> DataFrame:
    """Seeded stand-in dialogues (video_id, ord, start, end, speaker, confidence)."""
    n = minutes * 5
    base = spark.range(videos * n).select(F.floor(F.col("id") / n).alias("video_id"), (F.col("id") % n).alias("ord"), F.pmod(F.col("id") * 7919 + seed * 104729, F.lit(1000)).alias("h"))
    start = F.col("ord") * 12.0 + F.col("h") / 250
    return base.select("video_id", "ord", start.alias("start"), (start + 2 + F.col("h") / 200).alias("end"), F.format_string("SPEAKER_%02d", F.col("h") % 4).alias("speaker"), (F.lit(0.5) + F.col("h") / 2000).alias("confidence"))
