"""What the corpus operators share: shared-folder checkpoints and row batching."""

from __future__ import annotations

import gc
import itertools
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; make a folder only in a local session that names none."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))


_made = itertools.count(1)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a replicated copy in the shared checkpoint folder.

    After every fourth copy the driver's garbage is collected: plans, shuffle files and
    copies that an iteration no longer needs go then, and not whenever its heap is full.
    """
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if next(_made) % 4 == 0:
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fold(col: Column, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus``: the split of every contract."""
    return F.crc32(F.col(col).cast("string") if isinstance(col, str) else col.cast("string")) % modulus


def text_bytes(df: DataFrame, column: str) -> int:
    """Total UTF-8 bytes of a text column; sizes the number of exchange buckets."""
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows of about ``limit`` text bytes, one row at least."""
    index = batch.schema.get_field_index(column)
    array = batch.column(index)
    if not len(array):
        return
    import numpy as np

    width = np.dtype(np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32)
    ends = np.frombuffer(array.buffers()[1], width)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    at = 0
    while at < len(array):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
