"""Send the package to the executors, whose Python does not know the driver's folders."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package as an archive to the session's application, once."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tidemark-ship-")
    target = os.path.join(folder, "tidemark")
    shutil.copytree(package, target, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "tidemark-package"), "zip", folder, "tidemark"))
    _sent.add(sc.applicationId)
