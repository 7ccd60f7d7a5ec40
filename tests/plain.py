"""Plain, frame-by-frame forms that the operators are held against."""

import numpy as np

from tidemark.operators.tracking import assign


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def iou_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Box overlaps, one row per box of ``a``."""
    lo, hi = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, 2:], b[None, :, 2:])
    common = np.prod(np.clip(hi - lo, 0, None), axis=2)
    area = lambda x: np.prod(x[:, 2:] - x[:, :2], axis=1)
    union = area(a)[:, None] + area(b)[None, :] - common
    return np.divide(common, union, out=np.zeros_like(common), where=union > 0)


#: Constant-velocity Kalman filter over (centre x, centre y, area, aspect): step, and noise of step and measurement.
_STEP = np.eye(7) + np.diag([1.0, 1.0, 1.0], 4)[:7, :7]
_Q, _R = np.diag([1, 1, 1, 1, 0.01, 0.01, 0.0001]), np.diag([1.0, 1.0, 10.0, 10.0])


def box_states(boxes: np.ndarray) -> np.ndarray:
    """(centre x, centre y, area, aspect) of each box."""
    size = boxes[:, 2:] - boxes[:, :2]
    aspect = np.divide(size[:, 0], size[:, 1], out=np.zeros(len(boxes)), where=size[:, 1] != 0)
    return np.column_stack([boxes[:, :2] + size / 2, size[:, 0] * size[:, 1], aspect])


class Tracker:
    """Frame-by-frame tracks: predict, assign, update, birth, death after ``max_age`` frames; the states of all tracks are one array.

    The cost of a pair is 1 - IoU or, where faces have vectors, half of that and half of
    1 - cosine with the track's running mean vector; pairs that cost ``reject`` or more are none.
    """

    def __init__(self, max_age: int = 30, min_hits: int = 3, reject: float = 0.7, alpha: float = 0.3):
        self.max_age, self.min_hits, self.reject, self.alpha = max_age, min_hits, reject, alpha
        self.x, self.p, self.vectors = np.zeros((0, 7)), np.zeros((0, 7, 7)), None
        self.ids, self.age, self.streak = (np.zeros(0, np.int64) for _ in range(3))
        self.frames = self.next_id = 0

    def predict(self) -> np.ndarray:
        """Boxes of all tracks one frame on."""
        x = self.x
        x[x[:, 2] + x[:, 6] <= 0, 6] = 0
        self.x, self.p = x @ _STEP.T, _STEP @ self.p @ _STEP.T + _Q
        area, aspect = np.maximum(self.x[:, 2], 1e-6), np.maximum(self.x[:, 3], 1e-6)
        w = np.sqrt(area * aspect)
        half = np.column_stack([w, area / w]) / 2
        return np.column_stack([self.x[:, :2] - half, self.x[:, :2] + half])

    def update(self, of: np.ndarray, boxes: np.ndarray) -> None:
        p = self.p[of]
        gain = p[:, :, :4] @ np.linalg.inv(p[:, :4, :4] + _R)
        self.x[of] += (gain @ (box_states(boxes) - self.x[of, :4])[:, :, None])[:, :, 0]
        self.p[of] = p - gain @ p[:, :4, :]

    def cost(self, guess: np.ndarray, boxes: np.ndarray, vectors: np.ndarray | None) -> np.ndarray:
        if not len(guess) or not len(boxes):
            return np.zeros((len(guess), len(boxes)))
        apart = 1 - iou_matrix(guess, boxes)
        return apart if vectors is None else 0.5 * apart + 0.5 * (1 - self.vectors @ vectors.T)

    def step(self, boxes: np.ndarray, vectors: np.ndarray | None = None) -> list[tuple[int, int]]:
        """(box index, track id) of the tracks that are reported in this frame."""
        self.frames += 1
        if vectors is not None:
            vectors = _unit(vectors)
            self.vectors = np.zeros((0, vectors.shape[1])) if self.vectors is None else self.vectors
        cost = self.cost(self.predict(), boxes, vectors)
        pairs = np.array([(i, j) for i, j in assign(cost) if cost[i, j] < self.reject], int).reshape(-1, 2)
        i, j = pairs.T
        self.age += 1
        missed = np.ones(len(self.ids), bool)
        missed[i] = False
        self.streak[missed] = 0
        told = []
        if len(i):
            self.update(i, boxes[j])
            self.age[i], self.streak[i] = 0, self.streak[i] + 1
            if vectors is not None:
                self.vectors[i] = _unit((1 - self.alpha) * self.vectors[i] + self.alpha * vectors[j])
            shown = (self.streak[i] >= self.min_hits) | (self.frames <= self.min_hits)
            told = list(zip(j[shown].tolist(), self.ids[i[shown]].tolist(), strict=True))
        new = np.setdiff1d(np.arange(len(boxes)), j)
        keep = self.age <= self.max_age
        ids = self.next_id + np.arange(len(new))
        self.next_id += len(new)
        if self.frames <= self.min_hits or self.min_hits <= 1:
            told += list(zip(new.tolist(), ids.tolist(), strict=True))
        if len(new) or not keep.all():
            start = np.diag([10.0] * 4 + [1e4] * 3)
            self.x = np.concatenate([self.x[keep], np.column_stack([box_states(boxes[new]), np.zeros((len(new), 3))])])
            self.p = np.concatenate([self.p[keep], np.broadcast_to(start, (len(new), 7, 7))])
            self.ids, self.age = np.concatenate([self.ids[keep], ids]), np.concatenate([self.age[keep], np.zeros(len(new), np.int64)])
            self.streak = np.concatenate([self.streak[keep], np.ones(len(new), np.int64)])
            if vectors is not None:
                self.vectors = np.concatenate([self.vectors[keep], vectors[new]])
        return told


def average_linkage(vectors: np.ndarray, most: float) -> np.ndarray:
    """Clusters joined, by a table of all pairs, while the mean cosine distance between two of them is at most ``most``; the first of equal pairs is joined."""
    n = len(vectors)
    d = 1 - _unit(vectors) @ _unit(vectors).T
    np.fill_diagonal(d, np.inf)
    size, label = np.ones(n), np.arange(n)
    for _ in range(n - 1):
        i, j = divmod(int(d.argmin()), n)
        if d[i, j] > most:
            break
        i, j = min(i, j), max(i, j)
        row = (d[i] * size[i] + d[j] * size[j]) / (size[i] + size[j])  # the mean to the union is the weighted mean
        d[i], d[:, i] = row, row
        d[j], d[:, j], d[i, i] = np.inf, np.inf, np.inf
        size[i] += size[j]
        label[label == j] = i
    return np.unique(label, return_inverse=True)[1]
