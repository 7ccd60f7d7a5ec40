"""Density clusters of a scene's faces without a table of all pairs.

Cosine distance of at most eps is an angle of at most a. Some faces are pivots, about one
in CELL, so crowded places have many; each face lives in the cell of its nearest pivot.
If two faces are at most a apart, then each is at most 2a further from the other's pivot
than from its own: so a face visits the cells of those pivots, and its neighbours are all
at home in a cell that it visits.

In its cell a home face counts its neighbours among the visitors, which tells whether it
is a core. In a second visit cells link cores with cores, and every other home face with
the groups of cores next to it. A scene's links (two numbers each, no vectors) are then
merged: clusters are numbered by their first core, and a face that is not a core joins the
first cluster that it touches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tracking import unit

#: Faces of a cell (about), faces that one task gives to cells, and rows and columns of a tile of similarities.
CELL, DEALT, TILE = 2000, 20_000, (512, 4096)
_SCENE = ["video_id", "scene_id"]
_EDGE = 1e-12  # distances up to eps + _EDGE count as eps


def lowest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest number in the component of each of n nodes under links (a, b), from a forest of such labels on."""
    label = np.arange(n) if label is None else label
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]
    return label


def _tiles(home: np.ndarray, other: np.ndarray, eps: float) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """(rows, columns, whether they are neighbours) of all pairs, a tile at a time."""
    for i in range(0, len(home), TILE[0]):
        for j in range(0, len(other), TILE[1]):
            r, c = slice(i, i + TILE[0]), slice(j, j + TILE[1])
            yield r, c, 1 - home[r] @ other[c].T <= eps + _EDGE


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def _cells(angle: float):
    """Home and other cells of a part of a scene's faces, given the scene's pivots."""

    def run(faces: pa.Table, pivots: pa.Table) -> pa.Table:
        pivots = pivots.sort_by("ord")
        v, p = unit(_vectors(faces["embedding"])), unit(_vectors(pivots["embedding"]))
        ords = faces["ord"].to_numpy()
        row, cell, home = [], [], []
        for at in range(0, len(v), 1024):
            far = np.arccos(np.clip(v[at : at + 1024] @ p.T, -1, 1))
            near = far.min(1, keepdims=True)
            tied = far <= near + 1e-9  # equal faces are shared out over equal pivots
            turn = (ords[at : at + 1024] * 2654435761 >> 7) % tied.sum(1)
            own = (np.cumsum(tied, 1) == turn[:, None] + 1).argmax(1)
            r, c = np.nonzero(far <= near + 2 * angle + 1e-6)
            row.append(r + at)
            cell.append(c)
            home.append(c == own[r])
        row, cell, home = (np.concatenate(x) for x in (row, cell, home))
        took = faces.select([*_SCENE, "ord", "embedding"]).take(pa.array(row))
        return took.append_column("cell", pa.array(cell, pa.int64())).append_column("home", pa.array(home))

    return run


def _cores(eps: float, least: int):
    def run(cell: pa.Table) -> pa.Table:
        v, home = unit(_vectors(cell["embedding"])), cell["home"].to_numpy()
        mine = np.flatnonzero(home)
        many = np.zeros(len(mine), np.int64)
        for r, _, near in _tiles(v[mine], v, eps):
            many[r] += near.sum(1)
        took = cell.select([*_SCENE, "ord"]).take(pa.array(mine))
        return took.append_column("core", pa.array(many >= least))

    return run


def _links(eps: float):
    """Links (ord, to, core): a core with the first core of its group in this cell, another home face with each group next to it."""

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by("ord")
        v, ords = unit(_vectors(cell["embedding"])), cell["ord"].to_numpy()
        home, core = cell["home"].to_numpy(), cell["core"].to_numpy()
        cores, mine, edge = np.flatnonzero(core), np.flatnonzero(core & home), np.flatnonzero(home & ~core)
        place = np.searchsorted(cores, mine)
        label = np.arange(len(cores))
        for r, c, near in _tiles(v[mine], v[cores], eps):
            i, j = np.nonzero(near & (label[place[r]][:, None] != label[c][None, :]))
            label = lowest(len(cores), place[r][i], np.arange(len(cores))[c][j], label)
        a, b, kind = [ords[cores]], [ords[cores[label]]], [np.ones(len(cores), bool)]
        for r, c, near in _tiles(v[edge], v[cores], eps):
            i, j = np.nonzero(near)
            pair = np.unique(np.arange(len(edge))[r][i] * len(cores) + label[c][j])
            a.append(ords[edge[pair // len(cores)]])
            b.append(ords[cores[pair % len(cores)]])
            kind.append(np.zeros(len(pair), bool))
        a, b, kind = (np.concatenate(x) for x in (a, b, kind))
        first = [np.full(len(a), cell[c][0].as_py()) for c in _SCENE] if len(cell) else [a, a]
        return pa.table({"video_id": pa.array(first[0], pa.int64()), "scene_id": pa.array(first[1], pa.int64()), "ord": pa.array(a, pa.int64()), "to": pa.array(b, pa.int64()), "core": kind})

    return run


def _numbered(scene: pa.Table) -> pa.Table:
    """Clusters of a scene from its links."""
    ords, to, core = (scene[c].to_numpy(zero_copy_only=False) for c in ("ord", "to", "core"))
    nodes = np.unique(ords[core])
    label = lowest(len(nodes), np.searchsorted(nodes, ords[core]), np.searchsorted(nodes, to[core]))
    number = np.unique(label, return_inverse=True)[1]
    edge, of = np.unique(ords[~core], return_inverse=True)
    best = np.full(len(edge), len(nodes))
    np.minimum.at(best, of, number[np.searchsorted(nodes, to[~core])])
    out = np.concatenate([nodes, edge])
    key = [pa.array(np.full(len(out), scene[c][0].as_py()), pa.int64()) for c in _SCENE]
    return pa.table({"video_id": key[0], "scene_id": key[1], "ord": pa.array(out, pa.int64()), "cluster": pa.array(np.concatenate([number, best]), pa.int64())})


def clusters(faces: DataFrame, eps: float, least: int) -> DataFrame:
    """(video_id, scene_id, ord, cluster) of the faces (video_id, scene_id, ord, embedding, and n, the faces of the scene) that are not noise.

    An ``ord`` stands once in a scene; vectors of a scene have one length.
    """
    angle = float(np.arccos(np.clip(1 - eps, -1, 1)))
    rows = faces.select(*_SCENE, "ord", "embedding", "n", F.xxhash64("ord").alias("h"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / DEALT)).cast("long")
    first = rows.groupBy(*_SCENE).agg(F.min("ord").alias("first"))  # a scene has one pivot at least
    pivots = rows.join(first, _SCENE).where((F.pmod("h", F.lit(CELL)) == 0) | (F.col("ord") == F.col("first")))
    pivots = pivots.select(*_SCENE, F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), "ord", "embedding")
    pivots = pivots.select(*(F.col(c).alias(c) for c in pivots.columns))  # both sides of a cogroup need names of their own
    dealt = rows.select(*_SCENE, F.pmod(F.shiftright("h", 20), parts).alias("part"), "ord", "embedding")
    kind = dealt.schema["embedding"].dataType.simpleString()
    schema = f"video_id long, scene_id long, ord long, embedding {kind}, cell long, home boolean"
    visits = dealt.groupBy(*_SCENE, "part").cogroup(pivots.groupBy(*_SCENE, "part")).applyInArrow(_cells(angle), schema)
    cores = visits.groupBy(*_SCENE, "cell").applyInArrow(_cores(eps, least), "video_id long, scene_id long, ord long, core boolean")
    links = visits.join(cores, [*_SCENE, "ord"]).groupBy(*_SCENE, "cell").applyInArrow(_links(eps), "video_id long, scene_id long, ord long, to long, core boolean")
    return links.groupBy(*_SCENE).applyInArrow(_numbered, "video_id long, scene_id long, ord long, cluster long")
