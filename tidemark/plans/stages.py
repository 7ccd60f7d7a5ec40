"""A lazy stage graph per corpus of videos: components in a fixed order, isolated failures, optional checkpoints."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[SparkSession, dict[str, DataFrame]], dict[str, DataFrame]]
ORDER = ["video", "audio", "caption"]


@dataclass
class Pipeline:
    """Stages make named tables from named tables; with a folder, each table is written once and read back on resume."""

    stages: dict[str, Stage] = field(default_factory=dict)
    folder: str | None = None

    def run(self, spark: SparkSession, tables: dict[str, DataFrame], components: list[str] | None = None, skip: tuple[str, ...] = ()) -> tuple[dict[str, DataFrame], dict[str, str]]:
        """(tables, status of each component). Captions need the video component to have ended well."""
        from ..sources.readers import exists

        wanted = [c for c in (components or ORDER) if c not in skip]
        out, status = dict(tables), {}
        for name in sorted(wanted, key=lambda c: ORDER.index(c) if c in ORDER else len(ORDER)):
            if name == "caption" and status.get("video", "ok") != "ok":
                status[name] = "skipped"
                continue
            try:
                for key, df in self.stages[name](spark, out).items():
                    if self.folder:
                        path = f"{self.folder}/{key}"
                        if not exists(spark, path + "/_SUCCESS"):
                            df.write.mode("overwrite").parquet(path)
                        df = spark.read.parquet(path)
                    out[key] = df
                status[name] = "ok"
            except Exception as e:  # noqa: BLE001  a component's failure is reported, the others go on
                status[name] = f"failed: {type(e).__name__}: {str(e)[:200]}"
        return out, status


def verify() -> dict[str, bool]:
    """Which libraries and programs are there; yaml and ffmpeg are optional."""
    import importlib.util
    import os
    import shutil

    found = {name: importlib.util.find_spec(name) is not None for name in ("pyspark", "pyarrow", "pandas", "numpy", "yaml")}
    found["java"] = shutil.which("java") is not None or os.path.exists(os.path.join(os.environ.get("JAVA_HOME", "/none"), "bin", "java"))
    found["ffmpeg"] = shutil.which("ffmpeg") is not None
    return found
