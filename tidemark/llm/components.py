"""Connected components of an edge table: tasks merge their own edges, what they disagree on is merged again.

Each task of about EDGES edges joins them by minimum hooking and pointer jumping on
arrays. Every id then points to its smallest root, these pointers are shortened, and
edges whose ends still point apart are the next level, of half the ids at most, dealt
by their smaller end. The last level fits one task, whose
size is bounded by EDGES. No row comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

#: Edges that one task merges.
EDGES = 1_000_000


def merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, smallest id of the component of each) of edges (a, b)."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, root = place[: len(a)], place[len(a) :], np.arange(len(ids))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        open_ = low != high
        if not open_.any():
            return ids, ids[root]
        x, y = x[open_], y[open_]
        np.minimum.at(root, high[open_], low[open_])
        while not np.array_equal(up := root[root], root):
            root = up


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) to (id, root) of all edges of a task; edges that came before are kept as one star a component."""
    a, b, size = [], [], 0
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
        size += batch.num_rows
        if size > 2_000_000:
            ids, root = merged(np.concatenate(a), np.concatenate(b))
            a, b, size = [ids], [root], 0
    if a:
        ids, root = merged(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(root)], ["id", "root"])


def _shortened(least: DataFrame) -> DataFrame:
    """(id, m) with m replaced by its own m until none has a smaller one: the depth halves each time."""
    least = checkpoint(least)
    while True:
        up = least.select(F.col("id").alias("m"), F.col("m").alias("over"))
        nxt = checkpoint(least.join(up, "m").select("id", F.col("over").alias("m"), (F.col("over") < F.col("m")).alias("moved")))
        least = nxt.select("id", "m")
        if nxt.where("moved").isEmpty():
            return least


def components(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, comp) of every id in ``edges`` (a, b), comp the smallest id of its component; and the edges, computed once."""
    links = checkpoint(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    level, below = links, []
    while True:
        tasks = -(-level.count() // EDGES)
        dealt = level.coalesce(1) if tasks <= 1 else level.repartition(tasks, "a") if below else level
        local = checkpoint(dealt.mapInArrow(_merge, "id long, root long"))
        if tasks <= 1:
            comp = local.select("id", F.col("root").alias("comp"))
            break
        least = _shortened(local.groupBy("id").agg(F.min("root").alias("m")))
        below.append(least)
        ends = local.join(least, "id").join(least.select(F.col("id").alias("root"), F.col("m").alias("n")), "root").where("m <> n")
        level = checkpoint(ends.select(F.least("m", "n").alias("a"), F.greatest("m", "n").alias("b")).distinct())
    for least in reversed(below):
        upper = comp.select(F.col("id").alias("m"), "comp")
        comp = checkpoint(least.join(upper, "m", "left").select("id", F.coalesce("comp", "m").alias("comp")))
    return comp, links
