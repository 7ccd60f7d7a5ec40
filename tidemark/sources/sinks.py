"""Writers: nested documents, caption files and pages, all assembled as columns per video."""

from __future__ import annotations

import html
import logging
import os
from collections.abc import Callable
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import html_escape
from ..functions.time import readable, srt, vtt, vtt_rounded

_log = logging.getLogger(__name__)


def nested(rows: DataFrame, name: str, order: str, *columns: str) -> DataFrame:
    """One row per video: the ordered list of its rows under ``name`` and their number."""
    body = F.array_sort(F.collect_list(F.struct(order, *[c for c in columns if c != order])))
    out = rows.groupBy("video_id").agg(body.alias(name))
    return out.withColumn(f"total_{name}", F.size(name))


def analysis(videos: DataFrame, shots: DataFrame, scenes: DataFrame) -> DataFrame:
    """Header, shots and scenes of each video in one nested row."""
    s, c = nested(shots, "shots", "id", "start", "end"), nested(scenes, "scenes", "id", "start", "end")
    return videos.join(s, "video_id", "left").join(c, "video_id", "left")


def _joined(captions: DataFrame, line: Column, mark: str, head: str = "") -> DataFrame:
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("scene_id", line.alias("line")))), lambda x: x["line"]), mark)
    return captions.groupBy("video_id").agg(F.concat(F.lit(head), body, F.lit(mark)).alias("body"))


def _named() -> Column:
    show = F.col("has_dialogue") & (F.size("characters") > 0)
    return F.when(show, F.concat(F.lit("["), F.array_join(F.slice("characters", 1, 2), ", "), F.lit("] "))).otherwise("")


def srt_file(captions: DataFrame) -> DataFrame:
    """(video_id, body): numbered cues, with at most two names before a caption that has dialogue."""
    n = F.row_number().over(Window.partitionBy("video_id").orderBy("scene_id")).cast("string")
    numbered = captions.withColumn("n", n)
    line = F.concat("n", F.lit("\n"), srt(F.col("start")), F.lit(" --> "), srt(F.col("end")), F.lit("\n"), _named(), "caption", F.lit("\n"))
    return _joined(numbered, line, "\n")


def vtt_file(captions: DataFrame) -> DataFrame:
    who = F.when(F.col("has_dialogue") & (F.size("characters") > 0), F.concat(F.lit("<v "), F.array_join(F.slice("characters", 1, 2), ", "), F.lit(">"))).otherwise("")
    line = F.concat(F.format_string("SCENE_%03d\n", "scene_id"), vtt(F.col("start")), F.lit(" --> "), vtt(F.col("end")), F.lit(" align:left line:90%\n"), who, "caption", F.lit("\n"))
    return _joined(captions, line, "\n", "WEBVTT\nKind: captions\n\n")


def plain_srt(captions: DataFrame) -> DataFrame:
    """Cues that carry the caption's own id."""
    return _joined(captions, F.concat(F.col("scene_id").cast("string"), F.lit("\n"), srt(F.col("start")), F.lit(" --> "), srt(F.col("end")), F.lit("\n"), "caption", F.lit("\n")), "\n")


def plain_vtt(captions: DataFrame) -> DataFrame:
    return _joined(captions, F.concat(vtt_rounded(F.col("start")), F.lit(" --> "), vtt_rounded(F.col("end")), F.lit("\n"), "caption", F.lit("\n")), "\n", "WEBVTT\n\n")


def text_file(captions: DataFrame) -> DataFrame:
    return _joined(captions, F.concat(F.lit("["), readable(F.col("start")), F.lit(" - "), readable(F.col("end")), F.lit("] "), "caption"), "\n")


def html_file(captions: DataFrame) -> DataFrame:
    line = F.concat(F.lit("<p><b>"), readable(F.col("start")), F.lit("</b> "), html_escape(F.col("caption")), F.lit("</p>"))
    return _joined(captions, line, "\n", "<!DOCTYPE html>\n<meta charset=\"utf-8\">\n")


def json_file(captions: DataFrame) -> DataFrame:
    return nested(captions, "captions", "scene_id", "start", "end", "caption", "characters", "has_dialogue").select("video_id", F.to_json(F.struct("total_captions", "captions")).alias("body"))


FORMATS: dict[str, Callable[[DataFrame], DataFrame]] = {"srt": srt_file, "vtt": vtt_file, "txt": text_file, "html": html_file, "json": json_file}


def write_all(captions: DataFrame, folder: str, formats: list[str]) -> dict[str, str]:
    """Write every format under the folder as (video_id, body) rows, in as many files as there are partitions; an unknown or failing one is reported and the rest go on.

    Call ``raise_failures`` on the result where a failure must fail the job.
    """
    said = {}
    for name in formats:
        if name not in FORMATS:
            _log.warning("unknown format %s", name)
            said[name] = "unknown"
            continue
        try:
            write_document(FORMATS[name](captions), f"{folder}/{name}")
            said[name] = "written"
        except Exception as e:  # noqa: BLE001  one format's failure must not lose the others
            _log.warning("%s failed: %s", name, e)
            said[name] = f"failed: {type(e).__name__}: {str(e)[:200]}"
    return said


def raise_failures(said: dict[str, str]) -> dict[str, str]:
    if bad := {k: v for k, v in said.items() if v.startswith("failed")}:
        raise RuntimeError(str(bad))
    return said


def write_document(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").json(folder)


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """One small file on any file system, written by the driver; data of tables goes through Spark's writers."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def result_page(title: str, names: list[str]) -> str:
    """The listing that a static server of result files shows."""
    rows = "\n".join(f'<li><a href="{html.escape(quote(n), quote=True)}">{html.escape(n)}</a></li>' for n in names)
    return f"<!DOCTYPE html>\n<meta charset=\"utf-8\">\n<title>{html.escape(title)}</title>\n<ul>\n{rows}\n</ul>\n"


def serve(folder: str, port: int = 0, title: str = "Results"):
    """A static HTTP server of a local result folder (``serve_forever`` is the caller's); / lists the pages in it."""

    class Handler(SimpleHTTPRequestHandler):
        def __init__(self, *a, **k):
            super().__init__(*a, directory=folder, **k)

        def do_GET(self):  # noqa: N802
            if self.path != "/":
                super().do_GET()
                return
            body = result_page(title, sorted(n for n in os.listdir(folder) if n.endswith((".html", ".json", ".srt", ".vtt")))).encode()
            self.send_response(200)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, text, *args):
            _log.info(text, *args)

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)


def transcode_command(source: str, target: str, width: int, height: int, target_height: int, fps: float | None = None, crf: int = 23) -> list[str]:
    """The ffmpeg call that converts a file to H.264 at another height, its width rounded down to an even number."""
    even = int(width * target_height / height) // 2 * 2
    rate = ["-r", f"{fps:g}"] if fps else []
    return ["ffmpeg", "-y", "-i", source, "-vf", f"scale={even}:{target_height}", *rate, "-c:v", "libx264", "-crf", str(crf), "-c:a", "aac", target]
