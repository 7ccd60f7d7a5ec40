"""Kalman tracks of boxes, many sequences at a time.

A video is cut where more than ``max_age`` empty frames lie between two detections: no
track survives that, so the parts are independent, and a long video is shared out. A task
runs its parts in step, frame by frame: the states of all tracks of all parts are arrays,
and so are the pairs of a track and a box of the same part. Where boxes alone decide,
only tracks and boxes that overlap more than one partner need an assignment, as pairs
without overlap all cost the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .slices import Scan

#: Sequences that run in step, rows held for them, and frames of a slice of a long video.
TOGETHER, ROWS, FRAMES = 512, 200_000, 18_000

#: Constant-velocity Kalman filter over (centre x, centre y, area, aspect): step, and noise of step and measurement.
_STEP = np.eye(7) + np.diag([1.0, 1.0, 1.0], 4)[:7, :7]
_Q, _R = np.diag([1, 1, 1, 1, 0.01, 0.01, 0.0001]), np.diag([1.0, 1.0, 10.0, 10.0])
_START = np.diag([10.0] * 4 + [1e4] * 3)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Least-cost one-to-one pairs of rows and columns (shortest augmenting paths with potentials)."""
    if not cost.size:
        return []
    if 1 in cost.shape:
        return [(int(k) if cost.shape[1] == 1 else 0, 0 if cost.shape[1] == 1 else int(k)) for k in [cost.argmin()]]
    turned = cost.shape[0] > cost.shape[1]
    c = cost.T if turned else cost
    n, m = c.shape
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    row_of = np.zeros(m + 1, int)
    for i in range(1, n + 1):
        row_of[0], j0 = i, 0
        least, way, done = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            done[j0] = True
            free = np.flatnonzero(~done[1:]) + 1
            slack = c[row_of[j0] - 1, free - 1] - u[row_of[j0]] - v[free]
            better = slack < least[free]
            least[free[better]], way[free[better]] = slack[better], j0
            j1 = free[np.argmin(least[free])]
            step = least[j1]
            u[row_of[done]] += step
            v[done] -= step
            least[~done] -= step
            j0 = j1
            if row_of[j0] == 0:
                break
        while j0:
            row_of[j0], j0 = row_of[way[j0]], way[j0]
    pairs = [(row_of[j] - 1, j - 1) for j in range(1, m + 1) if row_of[j]]
    return sorted((b, a) if turned else (a, b) for a, b in pairs)


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of boxes, pair by pair."""
    size = np.clip(np.minimum(a[:, 2:], b[:, 2:]) - np.maximum(a[:, :2], b[:, :2]), 0, None)
    common = size[:, 0] * size[:, 1]
    union = (a[:, 2] - a[:, 0]) * (a[:, 3] - a[:, 1]) + (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1]) - common
    return np.divide(common, union, out=np.zeros(len(a)), where=union > 0)


def box_states(boxes: np.ndarray) -> np.ndarray:
    """(centre x, centre y, area, aspect) of each box."""
    size = boxes[:, 2:] - boxes[:, :2]
    aspect = np.divide(size[:, 0], size[:, 1], out=np.zeros(len(boxes)), where=size[:, 1] != 0)
    return np.column_stack([boxes[:, :2] + size / 2, size[:, 0] * size[:, 1], aspect])


class Tracks:
    """The live tracks of sequences 0 to n - 1: predict, assign, update, birth, death after ``max_age`` frames.

    The cost of a pair is 1 - IoU or, where faces have vectors, half of that and half of
    1 - cosine with the track's running mean vector; pairs that cost ``reject`` or more are
    none. A track is told from its ``min_hits``-th frame in a row on, or at once in the first
    ``min_hits`` frames of a sequence.
    """

    FIELDS = ("x", "p", "ids", "age", "streak", "seq")

    def __init__(self, n: int = 1, max_age: int = 30, min_hits: int = 3, reject: float = 0.7, alpha: float = 0.3):
        self.max_age, self.min_hits, self.reject, self.alpha = max_age, min_hits, reject, alpha
        self.x, self.p, self.vectors = np.zeros((0, 7)), np.zeros((0, 7, 7)), None
        self.ids, self.age, self.streak, self.seq = (np.zeros(0, np.int64) for _ in range(4))
        self.frames, self.next_id = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def keep(self, mask: np.ndarray) -> None:
        if mask.all():
            return
        for f in self.FIELDS:
            setattr(self, f, getattr(self, f)[mask])
        if self.vectors is not None:
            self.vectors = self.vectors[mask]

    def _advance(self, some: np.ndarray) -> None:
        """Move states one frame on."""
        x = self.x[some]
        x[x[:, 2] + x[:, 6] <= 0, 6] = 0
        self.x[some] = x @ _STEP.T
        self.p[some] = _STEP @ self.p[some] @ _STEP.T + _Q
        self.age[some] += 1

    def skip(self, frames: np.ndarray) -> None:
        """Frames without a detection, a number for each sequence."""
        self.frames += frames
        if not len(self.seq):
            return
        left = frames[self.seq]
        lasting = self.age + left <= self.max_age  # the others end on the way, with no frame to tell them in
        left = left[lasting]
        self.keep(lasting)
        for k in range(int(left.max(initial=0))):
            some = np.flatnonzero(left > k)
            if not len(some):
                break
            self._advance(some)
            self.streak[some] = 0

    def boxes(self) -> np.ndarray:
        area, aspect = np.maximum(self.x[:, 2], 1e-6), np.maximum(self.x[:, 3], 1e-6)
        w = np.sqrt(area * aspect)
        half = np.column_stack([w, area / w]) / 2
        return np.column_stack([self.x[:, :2] - half, self.x[:, :2] + half])

    def pairs(self, boxes: np.ndarray, seq: np.ndarray, vectors: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(track, box, cost) of all pairs of one sequence; both sides are sorted by sequence."""
        first, many = np.searchsorted(self.seq, seq), None
        many = np.searchsorted(self.seq, seq, "right") - first
        box = np.repeat(np.arange(len(seq)), many)
        track = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        cost = 1 - overlaps(self.boxes()[track], boxes[box])
        if vectors is not None:
            cost = 0.5 * cost + 0.5 * (1 - (self.vectors[track] * vectors[box]).sum(1))
        return track, box, cost

    def _matched(self, track, box, cost, boxes_only: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of the assignment of least cost of each sequence, without those that are rejected."""
        if boxes_only:
            edge = cost < 1
            track, box, cost = track[edge], box[edge], cost[edge]
        n = max(track.max(initial=-1), box.max(initial=-1)) + 1
        single = (np.bincount(track, minlength=n)[track] == 1) & (np.bincount(box, minlength=n)[box] == 1)
        i, j, c = [track[single]], [box[single]], [cost[single]]
        track, box, cost = track[~single], box[~single], cost[~single]
        of = self.seq[track]
        width = [np.bincount(of[np.unique(side, return_index=True)[1]], minlength=len(self.frames)) for side in (track, box)]
        lone = np.minimum(*width)[of] == 1  # one track or one box: its best pair
        by = np.lexsort((box[lone], track[lone], cost[lone], of[lone]))
        best = np.flatnonzero(lone)[by[np.flatnonzero(np.diff(of[lone][by], prepend=-1))]]
        i.append(track[best])
        j.append(box[best])
        c.append(cost[best])
        track, box, cost = track[~lone], box[~lone], cost[~lone]
        by = np.argsort(self.seq[track], kind="stable")
        bounds = np.flatnonzero(np.diff(self.seq[track][by], prepend=-1, append=-2))
        for a, b in zip(bounds, bounds[1:], strict=False):
            some = by[a:b]
            rows, r = np.unique(track[some], return_inverse=True)
            columns, k = np.unique(box[some], return_inverse=True)
            table = np.ones((len(rows), len(columns)))
            table[r, k] = cost[some]
            got = np.array(assign(table), int).reshape(-1, 2)
            i.append(rows[got[:, 0]])
            j.append(columns[got[:, 1]])
            c.append(table[got[:, 0], got[:, 1]])
        i, j, c = (np.concatenate(x) for x in (i, j, c))
        return i[c < self.reject], j[c < self.reject]

    def step(self, boxes: np.ndarray, seq: np.ndarray, vectors: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """One frame of the sequences that have boxes (sorted by ``seq``): (box index, track id) of the tracks that are told."""
        live = np.unique(seq)
        self.frames[live] += 1
        if vectors is not None:
            vectors = unit(vectors)
            self.vectors = np.zeros((0, vectors.shape[1])) if self.vectors is None else self.vectors
        here = np.isin(self.seq, live)
        self._advance(np.flatnonzero(here))
        i, j = self._matched(*self.pairs(boxes, seq, vectors), vectors is None)
        missed = here.copy()
        missed[i] = False
        self.streak[missed] = 0
        if len(i):
            p = self.p[i]
            gain = p[:, :, :4] @ np.linalg.inv(p[:, :4, :4] + _R)
            self.x[i] += (gain @ (box_states(boxes[j]) - self.x[i, :4])[:, :, None])[:, :, 0]
            self.p[i] = p - gain @ p[:, :4, :]
            self.age[i] = 0
            self.streak[i] += 1
            if vectors is not None:
                self.vectors[i] = unit((1 - self.alpha) * self.vectors[i] + self.alpha * vectors[j])
        shown = (self.streak[i] >= self.min_hits) | (self.frames[self.seq[i]] <= self.min_hits)
        told = [j[shown]], [self.ids[i[shown]]]
        new = np.setdiff1d(np.arange(len(boxes)), j)
        of = seq[new]
        ids = self.next_id[of] + np.arange(len(new)) - np.searchsorted(of, of)
        np.add.at(self.next_id, of, 1)
        early = (self.frames[of] <= self.min_hits) | (self.min_hits <= 1)
        told[0].append(new[early])
        told[1].append(ids[early])
        self.keep(self.age <= self.max_age)
        if len(new):
            self.add(box_states(boxes[new]), ids, of, None if vectors is None else vectors[new])
        return np.concatenate(told[0]), np.concatenate(told[1])

    def add(self, states: np.ndarray, ids: np.ndarray, seq: np.ndarray, vectors: np.ndarray | None) -> None:
        """New tracks, in the order of their sequences."""
        n = len(ids)
        fresh = {"x": np.column_stack([states, np.zeros((n, 3))]), "p": np.broadcast_to(_START, (n, 7, 7)), "ids": ids, "age": np.zeros(n, np.int64), "streak": np.ones(n, np.int64), "seq": seq}
        by = np.argsort(np.concatenate([self.seq, seq]), kind="stable")
        for f in self.FIELDS:
            setattr(self, f, np.concatenate([getattr(self, f), fresh[f]])[by])
        if vectors is not None:
            self.vectors = np.concatenate([self.vectors, vectors])[by]


def run_together(seq: np.ndarray, frame: np.ndarray, boxes: np.ndarray, vectors: np.ndarray | None, tracks: Tracks, lasting: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, track id) of all told rows; rows are sorted by (seq, frame). ``tracks`` keeps those of the ``lasting`` sequences (a mask)."""
    lasting = np.zeros(len(tracks.frames), bool) if lasting is None else lasting
    start = np.flatnonzero((np.diff(seq, prepend=-1) != 0) | (np.diff(frame, prepend=frame[:1] - 1) != 0))
    stop = np.append(start[1:], len(seq))
    of, at = seq[start], frame[start]
    first = np.searchsorted(of, of)
    turn = np.arange(len(start)) - first
    gap = np.where(turn > 0, at - np.concatenate([at[:1], at[:-1]]) - 1, 0)
    last = np.bincount(of, minlength=len(tracks.frames)) - 1
    rows, ids = [], []
    by = np.argsort(turn, kind="stable")
    bounds = np.searchsorted(turn[by], np.arange(turn.max(initial=-1) + 2))
    for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
        now = by[a:b]
        empty = np.zeros(len(tracks.frames), np.int64)
        empty[of[now]] = gap[now]
        tracks.keep((last[tracks.seq] >= k) | lasting[tracks.seq])
        tracks.skip(empty)
        some = np.concatenate([np.arange(start[g], stop[g]) for g in now])
        j, found = tracks.step(boxes[some], seq[some], None if vectors is None else vectors[some])
        rows.append(some[j])
        ids.append(found)
    return np.concatenate(rows), np.concatenate(ids)


def tracked(detections: DataFrame, max_age: int = 30, min_hits: int = 3, vector: str | None = None) -> DataFrame:
    """Detections (video_id, frame, ord, box, and their ``vector`` if named) with the track that each belongs to, where one is told.

    A frame without detections counts as one. Tracks of a video are numbered from 0 on in
    the order of their births. Rows without a video or frame are left out.
    """
    vectors = [F.col(vector).cast("array<double>").alias("vector")] if vector else []
    rows = detections.where("video_id is not null and frame is not null").select("video_id", F.col("frame").cast("long").alias("frame"), F.col("ord").cast("long").alias("ord"), "box.x1", "box.y1", "box.x2", "box.y2", *vectors)
    scan = Scan(rows, ["video_id"], "frame", "ord", width=FRAMES).last_before("__before", F.col("frame"))
    apart = F.coalesce((F.col("frame") - F.col("__before") > max(max_age + 1, min_hits)).cast("long"), F.lit(0))
    parts = scan.with_column("__new", apart).total_before("part", "__new").done()
    parts = parts.select(*rows.columns, (F.col("part") + F.col("__new")).alias("part"))
    tasks = int(detections.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a fixed number: the rows are few and the work on each is not
    dealt = parts.repartition(tasks, "video_id", "part").sortWithinPartitions("video_id", "part", "frame", "ord")
    found = dealt.mapInArrow(_run(max_age, min_hits, bool(vector)), "video_id long, part long, frame long, ord long, track_id long").repartition("video_id", "part")
    births = found.groupBy("video_id", "part").agg(F.sum(F.when(F.col("frame").isNull() & F.col("ord").isNull(), F.col("track_id"))).alias("n"))
    before = F.sum("n").over(Window.partitionBy("video_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    joined = found.join(births.select("video_id", "part", before.alias("shift")), ["video_id", "part"])
    # the condition names both sides, so that it stays behind the join and the tracks are made once for both
    return joined.where("frame is not null or shift < 0").select("video_id", "frame", "ord", (F.col("track_id") + F.coalesce("shift", F.lit(0))).alias("track_id"))


def _run(max_age: int, min_hits: int, faces: bool):
    """Tracks of sorted parts; each part also has a row without a frame that holds its number of births."""

    def told(table: pa.Table) -> pa.RecordBatch:
        video, part, frame, ordinal = (table[c].to_numpy() for c in ("video_id", "part", "frame", "ord"))
        new = np.concatenate([[True], (video[1:] != video[:-1]) | (part[1:] != part[:-1])])
        seq, first = np.cumsum(new) - 1, np.flatnonzero(new)
        tracks = Tracks(len(first), max_age, min_hits)
        tracks.frames[part[first] > 0] = min_hits  # a later part is past the first frames
        boxes = np.column_stack([table[c].to_numpy() for c in ("x1", "y1", "x2", "y2")]).astype(float)
        vectors = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(seq), -1) if faces else None
        row, ids = run_together(seq, frame, boxes, vectors, tracks)
        gone = pa.nulls(len(first), pa.int64())
        columns = [(video[row], video[first]), (part[row], part[first]), (frame[row], gone), (ordinal[row], gone), (ids, tracks.next_id)]
        made = [pa.concat_arrays([pa.array(a, pa.int64()), b if isinstance(b, pa.Array) else pa.array(b, pa.int64())]) for a, b in columns]
        return pa.RecordBatch.from_arrays(made, ["video_id", "part", "frame", "ord", "track_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = starts = 0
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            video, part = batch.column("video_id").to_numpy(), batch.column("part").to_numpy()
            cuts = np.flatnonzero((video[1:] != video[:-1]) | (part[1:] != part[:-1])) + 1
            if last is not None and last != (video[0], part[0]):
                cuts = np.concatenate([[0], cuts])
            at = 0
            for cut in cuts.tolist():
                starts += 1
                if starts >= TOGETHER or rows + cut - at >= ROWS:
                    held.append(batch.slice(at, cut - at))
                    yield told(pa.Table.from_batches([h for h in held if h.num_rows]))
                    held, rows, starts, at = [], 0, 0, cut
            held.append(batch.slice(at))
            rows += batch.num_rows - at
            last = video[-1], part[-1]
        if rows:
            yield told(pa.Table.from_batches([h for h in held if h.num_rows]))

    return run
