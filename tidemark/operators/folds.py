"""Ordered folds with feedback, one Arrow group per video: matching, tracking, association, clustering.

These are the operators whose next step depends on what the last one decided. A group is
one video, whose records are bounded by its length; videos run in parallel.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import density
from .tracking import unit as _unit

def dbscan(vectors: np.ndarray, eps: float, least: int) -> np.ndarray:
    """Density clusters under cosine distance; -1 is noise."""
    near = 1 - _unit(vectors) @ _unit(vectors).T <= eps + 1e-12
    core, label = near.sum(1) >= least, np.full(len(vectors), -1)
    current = 0
    for seed in range(len(vectors)):
        if label[seed] >= 0 or not core[seed]:
            continue
        label[seed], todo = current, [seed]
        while todo:
            for k in np.flatnonzero(near[todo.pop()] & (label < 0)):
                label[k] = current
                if core[k]:
                    todo.append(k)
        current += 1
    return label


def average_linkage(vectors: np.ndarray, most: float) -> np.ndarray:
    """Clusters joined while the mean cosine distance between two of them is at most ``most``.

    A chain of nearest neighbours grows until two are each other's; these are joined. The
    mean distance of two clusters is one minus the product of their mean vectors, so that
    only a vector a cluster is held. A cluster whose nearest one is over ``most`` away is
    done, as later clusters are no nearer. Of equal neighbours the one before in the chain
    is taken, else the first.
    """
    n = len(vectors)
    mean, size, first = _unit(vectors).copy(), np.ones(n), np.arange(n)  # live clusters stand in front
    parent, live, chain = np.arange(n), n, []

    def move(k: int) -> None:
        """The last live cluster takes place k."""
        nonlocal live
        live -= 1
        for held in (mean, size, first):
            held[k] = held[live]
        for at, c in enumerate(chain):
            if c == live:
                chain[at] = k

    while live:
        if not chain:
            chain.append(int(first[:live].argmin()))
        top = chain[-1]
        far = 1 - mean[:live] @ mean[top]
        far[top] = np.inf
        before = chain[-2] if len(chain) > 1 else -1
        least = far.min()
        if not least <= most:
            chain.pop()
            move(top)
        elif before >= 0 and far[before] <= least:
            chain[-2:] = []
            a, b = sorted((top, before), key=lambda k: first[k])
            mean[a] = (mean[a] * size[a] + mean[b] * size[b]) / (size[a] + size[b])
            size[a] += size[b]
            parent[first[b]] = first[a]
            move(b)
        else:
            tied = np.flatnonzero(far == least)
            chain.append(int(tied[first[tied].argmin()]))
    while (parent[parent] != parent).any():
        parent = parent[parent]
    return np.unique(parent, return_inverse=True)[1]


def greedy(vectors: np.ndarray, least: float) -> np.ndarray:
    """Each vector joins the first seed that it is similar enough to; not transitive."""
    sims, seed = _unit(vectors) @ _unit(vectors).T, np.full(len(vectors), -1)
    for i in range(len(vectors)):
        if seed[i] < 0:
            seed[(seed < 0) & (sims[i] >= least) & (np.arange(len(vectors)) >= i)] = i
    return seed


#: Faces of a scene that one task compares as a table.
DENSE = 2000
CLUSTER = "video_id long, scene_id long, ord long, cluster long"


def clustered(rows: DataFrame, min_cluster: int = 3, eps: float = 0.35, method: str = "dbscan") -> DataFrame:
    """Rows (video_id, scene_id, ord, embedding) clustered in each scene; noise is dropped, a small scene is one cluster.

    A scene of at most ``DENSE`` faces is one task's table of pairs; for density, a larger
    one is dealt over tasks by ``density.clusters``, with the same result.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        vectors = np.stack(pdf["embedding"].to_numpy()).astype(float)
        if len(pdf) < min_cluster:
            label = np.zeros(len(pdf), int)
        elif method == "dbscan":
            label = dbscan(vectors, eps, max(2, min_cluster // 2))
        else:
            label = average_linkage(vectors, eps)
        return pdf[["video_id", "scene_id", "ord"]].assign(cluster=label)[label >= 0]

    if method != "dbscan":
        return rows.groupBy("video_id", "scene_id").applyInPandas(run, CLUSTER)
    sizes = rows.groupBy("video_id", "scene_id").agg(F.count("*").alias("n"))
    known = rows.join(sizes, ["video_id", "scene_id"])
    small = known.where(F.col("n") <= DENSE).drop("n").groupBy("video_id", "scene_id").applyInPandas(run, CLUSTER)
    return small.unionByName(density.clusters(known.where(F.col("n") > DENSE), eps, max(2, min_cluster // 2)))


def merged_clusters(centroids: DataFrame, least: float = 0.75) -> DataFrame:
    """Cluster centroids (video_id, cluster_id, embedding) with the seed cluster that each joins."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cluster_id")
        ids = pdf["cluster_id"].to_numpy()
        return pdf[["video_id", "cluster_id"]].assign(global_id=ids[greedy(np.stack(pdf["embedding"].to_numpy()).astype(float), least)])

    return centroids.groupBy("video_id").applyInPandas(run, "video_id long, cluster_id long, global_id long")


def smoothed_in_place(rows: DataFrame, reach: int = 3) -> DataFrame:
    """As ``sessions.smoothed``, but neighbours before a row count with their smoothed scores."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        s, who = pdf["score"].to_numpy(float).copy(), pdf["character_id"].to_numpy()
        for i in range(len(s)):
            near = [s[j] for j in range(max(0, i - reach), min(len(s), i + reach + 1)) if j != i and who[j] == who[i]]
            if near:
                s[i] = 0.7 * s[i] + 0.3 * float(np.mean(near))
        return pdf[["video_id", "ord", "character_id"]].assign(score=s)

    return rows.select("video_id", "ord", "character_id", "score").groupBy("video_id").applyInPandas(run, "video_id long, ord long, character_id string, score double")


def short_merged(scenes: DataFrame, least: float) -> DataFrame:
    """Scenes shorter than ``least`` joined with the next one, pairwise; the result is not tested again."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, out, i = pdf.sort_values(["start", "id"]).to_dict("records"), [], 0
        while i < len(rows):
            a = rows[i]
            if a["end"] - a["start"] < least and i + 1 < len(rows):
                out.append((a["video_id"], a["start"], rows[i + 1]["end"]))
                i += 2
            else:
                out.append((a["video_id"], a["start"], a["end"]))
                i += 1
        return pd.DataFrame([(v, k + 1, s, e) for k, (v, s, e) in enumerate(out)], columns=["video_id", "id", "start", "end"])

    return scenes.select("video_id", "id", "start", "end").groupBy("video_id").applyInPandas(run, "video_id long, id long, start double, end double")


def peaks(x: np.ndarray, apart: int = 2) -> np.ndarray:
    """Local maxima of at least mean + half a deviation, the higher first, ``apart`` samples from each other."""
    if len(x) < 3:
        return np.zeros(0, int)
    high = x.mean() + 0.5 * x.std()
    at = [i for i in range(1, len(x) - 1) if x[i] > x[i - 1] and x[i] >= x[i + 1] and x[i] >= high]
    kept: list[int] = []
    for i in sorted(at, key=lambda i: (-x[i], i)):
        if all(abs(i - j) >= apart for j in kept):
            kept.append(i)
    return np.array(sorted(kept), int)


def regular_peaks(rows: DataFrame, value: str) -> DataFrame:
    """Per video and character: peaks of the ordered values, and whether their spacing is regular (cv < 0.5)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        at = peaks(pdf.sort_values("ord")[value].to_numpy(float))
        space = np.diff(at)
        regular = len(at) >= 2 and space.std() / space.mean() < 0.5
        return pd.DataFrame([(pdf["video_id"].iloc[0], pdf["character_id"].iloc[0], len(at), bool(regular))], columns=["video_id", "character_id", "peaks", "regular"])

    return rows.select("video_id", "character_id", "ord", value).groupBy("video_id", "character_id").applyInPandas(run, "video_id long, character_id string, peaks long, regular boolean")


def associated(rows: DataFrame, least: float = 0.7, refresh: int = 10) -> DataFrame:
    """Faces (video_id, ord, embedding) to characters, online: the best centroid with (cos + 1) / 2 over ``least``, else a new one.

    A centroid is set again after every ``refresh`` appearances; younger characters are matched by their first face.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        people: list[dict] = []
        out = []
        for r in pdf.sort_values("ord").itertuples():
            v = np.asarray(r.embedding, float)
            v = v / max(np.linalg.norm(v), 1e-12)
            scores = [(float(p["centre"] @ v) + 1) / 2 for p in people]
            k = int(np.argmax(scores)) if scores else -1
            if k < 0 or scores[k] <= least:
                people.append({"centre": v, "all": [v]})
                k = len(people) - 1
            else:
                people[k]["all"].append(v)
                if len(people[k]["all"]) % refresh == 0:
                    c = np.mean(people[k]["all"][-refresh:], 0)
                    people[k]["centre"] = c / max(np.linalg.norm(c), 1e-12)
            out.append((r.video_id, r.ord, k))
        return pd.DataFrame(out, columns=["video_id", "ord", "character"])

    return rows.select("video_id", "ord", "embedding").groupBy("video_id").applyInPandas(run, "video_id long, ord long, character long")


def chained_captions(packets: DataFrame, model, words: int = 30) -> DataFrame:
    """Captions in scene order; each prompt holds the summary of the caption before (the first: 'The story begins.').

    ``model``: prompt -> text. A failing scene keeps its row, with the error.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        before, out = "The story begins.", []
        for r in pdf.sort_values("scene_id").itertuples():
            try:
                text, error = model(r.prompt.replace("{before}", before)), None
                listed = text.split()
                before = text if len(listed) <= words else " ".join(listed[:words]) + "..."
            except Exception as e:  # noqa: BLE001  a model may raise anything; the row says so
                text, error = None, f"{type(e).__name__}: {e}"
            out.append((r.video_id, r.scene_id, text, error))
        return pd.DataFrame(out, columns=["video_id", "scene_id", "caption", "error"])

    return packets.select("video_id", "scene_id", "prompt").groupBy("video_id").applyInPandas(run, "video_id long, scene_id long, caption string, error string")
