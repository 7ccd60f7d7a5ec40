"""Plug-in points: models, backends and writers by name, with a deterministic stand-in each."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..sources import media

MODELS: dict[str, Callable[[], Callable[[str], str]]] = {}
BACKENDS: dict[str, Callable[..., DataFrame]] = {}
#: Factories of speech models: (samples, rate) -> [(start, end, text, confidence)], and of speaker models: -> [(start, end, speaker)].
TRANSCRIBERS: dict[str, Callable[[], Callable]] = {}
DIARIZERS: dict[str, Callable[[], Callable]] = {}


def mock_model() -> Callable[[str], str]:
    def caption(prompt: str) -> str:
        who = next((x[12:] for x in prompt.splitlines() if x.startswith("Characters: ")), "")
        return f"{who or 'Nobody'} in a scene described from {len(prompt.split())} words."

    return caption


MODELS["mock"] = mock_model


def model_column(name: str, attempts: int = 3, least: int = 10, wait: float = 0.0):
    """A column function prompt -> (text, error): the model is made once a worker and retried a few times."""
    make = MODELS[name]

    @pandas_udf("struct<text:string,error:string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make()
        for prompts in batches:
            rows = []
            for prompt in prompts:
                text, error = None, None
                for _ in range(attempts):
                    try:
                        got = model(prompt)
                        if got and len(got) > least:
                            text, error = got, None
                            break
                        error = "too short"
                    except Exception as e:  # noqa: BLE001  a model may raise anything; the row says so
                        error = f"{type(e).__name__}: {e}"
                    time.sleep(wait)
                rows.append((text, error))
            yield pd.DataFrame(rows, columns=["text", "error"])

    return run


def captioned(packets: DataFrame, name: str = "mock", fallback: str = "A scene.") -> DataFrame:
    """Packets with caption and error; a failed prompt gets the fallback text."""
    got = packets.withColumn("__m", model_column(name)(F.col("prompt")))
    return got.withColumns({"caption": F.coalesce("__m.text", F.lit(fallback)), "error": F.col("__m.error")}).drop("__m")


def backend(name: str, *args, **kw) -> DataFrame:
    """The named diarization (or other) backend; 'auto' takes the first registered."""
    chosen = next(iter(BACKENDS)) if name == "auto" and BACKENDS else name
    if chosen not in BACKENDS:
        raise KeyError(f"unknown backend {name!r}")
    return BACKENDS[chosen](*args, **kw)


def cinematic(videos: DataFrame) -> DataFrame:
    return videos.select("video_id", F.lit("disabled").alias("status"))


def energy_transcriber() -> Callable:
    """Stand-in: a loud span is a segment whose text tells its length."""
    return lambda samples, rate: [(a, b, f"{b - a:.1f} seconds of sound", 1.0) for a, b in media.bursts(samples, rate)]


def pitch_diarizer() -> Callable:
    """Stand-in: loud spans of about the same pitch are one speaker, named by first appearance."""

    def run(samples: np.ndarray, rate: int) -> list[tuple[float, float, str]]:
        names: dict[int, str] = {}
        spans = media.bursts(samples, rate)
        keys = [round(media.pitch(samples[int(a * rate) : int(b * rate)], rate) / 100) for a, b in spans]
        return [(a, b, names.setdefault(k, f"SPEAKER_{len(names):02d}")) for (a, b), k in zip(spans, keys, strict=True)]

    return run


TRANSCRIBERS["energy"] = energy_transcriber
DIARIZERS["pitch"] = pitch_diarizer
SEGMENTS = "path string, segment_id string, start double, end double, text string, confidence double, duration double, error string"
SPEAKERS = "path string, segment_id string, start double, end double, speaker_id string, duration double, error string"


def _spoken(audio: DataFrame, make: Callable, schema: str, form: str, whole: bool) -> DataFrame:
    """Model spans of each audio row; a failing or unreadable file is one row with the error. ``whole``: the file's duration, else the end of its last span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        kinds = {"string": pa.string(), "double": pa.float64()}
        fields = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in schema.split(", "))])
        for batch in batches:
            for row in batch.to_pylist():
                found, error = [], row["error"]
                if error is None:
                    try:
                        found = model(np.asarray(row["samples"], float), row["rate"])
                    except Exception as e:  # noqa: BLE001  a model may raise anything; the row says so
                        error = f"{type(e).__name__}: {e}"
                length = row["duration"] if whole else max((x[1] for x in found), default=0.0)
                rows = [(row["path"], form % k, *x, length, None) for k, x in enumerate(found) if not whole or x[0] < length]
                rows += [(row["path"], *[None] * (len(fields) - 2), error)] if error else []
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(fields)], schema=fields)

    return audio.select("path", "rate", "duration", "samples", "error").mapInArrow(run, schema)


def transcribed(audio: DataFrame, name: str = "energy", whole: bool = False) -> DataFrame:
    """Segments of audio rows by the named speech model; ``whole`` for files whose own duration counts."""
    return _spoken(audio, TRANSCRIBERS[name], SEGMENTS, "SEG_%04d", whole)


def diarized(audio: DataFrame, name: str = "auto") -> DataFrame:
    """Speaker turns of audio rows; 'auto' takes the first registered model."""
    return _spoken(audio, DIARIZERS[next(iter(DIARIZERS)) if name == "auto" else name], SPEAKERS, "SPK_SEG_%04d", True)
