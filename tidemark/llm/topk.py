"""Exact top-k inner products: tiled matrix products, partial selection, tree merging.

Defined cases: rows whose id or vector is null, or whose vector holds a null or
non-finite component, take no part; of rows that share an id the smallest vector
counts; vectors score only against vectors of the same length; ties go to the
smaller id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a candidate tile and in a query tile, and tiles merged by one step of the tree.
CANDIDATES, QUERIES, FAN_IN = 8192, 1024, 64
_TILE = "tile long, dim int, ids binary, matrix binary"


def _pack(rows_per_tile: int):
    """Rows to tiles of scaled integer components, sorted by id, one vector length each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            vectors = batch.column(1)
            sizes = np.asarray(vectors.value_lengths())
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for dim in np.unique(sizes):
                of = np.flatnonzero(sizes == dim)
                of = of[np.argsort(ids[of], kind="stable")]
                for at in range(0, len(of), rows_per_tile):
                    part = of[at : at + rows_per_tile]
                    scaled = np.floor(1024.0 * flat[starts[part][:, None] + np.arange(dim)])
                    yield pa.RecordBatch.from_pydict(
                        {"tile": [int(ids[part[0]])], "dim": pa.array([int(dim)], pa.int32()), "ids": [ids[part].astype(np.int64).tobytes()], "matrix": [scaled.tobytes()]}
                    )

    return pack


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where every partial sum is exact, else in Python integers."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if bound < 2.0**53:
        return (q @ c.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return exact(q).dot(exact(c).T).astype(np.int64)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Column indices of the k highest of each row, ties to the left."""
    n = scores.shape[1]
    if n <= k:
        return np.argsort(-scores, axis=1, kind="stable")
    if np.abs(scores).max(initial=0) < 2**48:
        unique = scores * n + np.arange(n - 1, -1, -1)
        part = np.argpartition(-unique, k - 1, axis=1)[:, :k]
        return np.take_along_axis(part, np.argsort(-np.take_along_axis(unique, part, 1), axis=1), 1)
    return np.argsort(-scores, axis=1, kind="stable")[:, :k]


def _score(k: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cell, dim, q_ids, q_matrix, c_ids, c_matrix = (batch.column(i)[row] for i in range(6))
                qi, ci = (np.frombuffer(x.as_buffer(), np.int64) for x in (q_ids, c_ids))
                d = dim.as_py()
                q = np.frombuffer(q_matrix.as_buffer(), np.float64).reshape(len(qi), d)
                c = np.frombuffer(c_matrix.as_buffer(), np.float64).reshape(len(ci), d)
                scores = _product(q, c)
                top = _best(scores, k + 1)  # one more, as the query itself may be there
                ids, values = ci[top], np.take_along_axis(scores, top, 1)
                other = ids != qi[:, None]
                other &= np.cumsum(other, axis=1) <= k
                where = np.nonzero(other)
                yield pa.RecordBatch.from_pydict(
                    {"cell": np.full(len(where[0]), cell.as_py()), "query_id": qi[where[0]], "vec_id": ids[where], "score": values[where]}
                )

    return score


def exact_top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each row where ``is_query`` holds.

    Candidate tiles are dealt over cells; each query tile visits every cell, so a
    task holds one query tile and one candidate tile and no row pair is ever made.
    """
    component = F.col(vector_col)
    clean = vectors.select(F.col(id_col).cast("long").alias("vec_id"), component.cast("array<double>").alias("v"), is_query.alias("q"))
    clean = clean.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    clean = clean.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("q").alias("q"))
    n = clean.count()
    cells = max(1, -(-n // (4 * CANDIDATES)))
    candidates = clean.select("vec_id", "v").mapInArrow(_pack(CANDIDATES), _TILE)
    candidates = candidates.select(F.pmod(F.xxhash64("tile"), F.lit(cells)).alias("cell"), "dim", F.col("ids").alias("c_ids"), F.col("matrix").alias("c_matrix"))
    queries = clean.where("q").select("vec_id", "v").repartition(max(1, n // (100 * QUERIES))).mapInArrow(_pack(QUERIES), _TILE)
    queries = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell"), "dim", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"))
    tiles = queries.join(candidates, ["cell", "dim"]).select("cell", "dim", "q_ids", "q_matrix", "c_ids", "c_matrix")
    found = tiles.mapInArrow(_score(k), "cell long, query_id long, vec_id long, score long")
    while cells > FAN_IN:
        cells = -(-cells // FAN_IN)
        found = _merge(found.withColumn("cell", F.expr(f"cell div {FAN_IN}")), ["query_id", "cell"], k).drop("rank")
    return _merge(found, ["query_id"], k).select("query_id", "rank", "vec_id", "score")


def _merge(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
