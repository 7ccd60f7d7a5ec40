"""Streaming variants: windows, sessions, dedup and stateful tracking over event time.

All append: a window or session is told once, when the watermark passes its end, and its
state goes then. Late rows are dropped after a watermark of ten seconds unless another is
given, and counted by the operators (``dropped``, ``progress``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LATE = "10 seconds"


def coverage(stream: DataFrame, at: str = "ts", width: str = "1 second", late: str = LATE) -> DataFrame:
    """Detections in tumbling windows."""
    return stream.withWatermark(at, late).groupBy("video_id", F.window(at, width)).agg(F.count("*").alias("n"))


def sliding(stream: DataFrame, at: str = "ts", width: str = "10 seconds", step: str = "1 second", late: str = LATE) -> DataFrame:
    return stream.withWatermark(at, late).groupBy("video_id", F.window(at, width, step)).agg(F.count("*").alias("n"), F.avg("value").alias("mean"))


def appearances(stream: DataFrame, at: str = "ts", gap: str = "2 seconds", late: str = LATE) -> DataFrame:
    """Sessions of each character; the end is the last detection, not the session's timeout."""
    return stream.withWatermark(at, late).groupBy("video_id", "character_id", F.session_window(at, gap)).agg(F.min(at).alias("start"), F.max(at).alias("end"), F.count("*").alias("points"))


def first_frames(stream: DataFrame, at: str = "ts", late: str = LATE) -> DataFrame:
    """Frames whose hash was not seen within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(["video_id", "hash"])


def frames_of_slot(stream: DataFrame, slot: str = "slot", late: str = LATE) -> DataFrame:
    """The first frame of each hash in its time slot (a timestamp); a slot's hashes are kept until the watermark passes it."""
    return stream.withWatermark(slot, late).dropDuplicates(["video_id", "hash", slot])


def dropped(query) -> int:
    """Late rows that a stream has dropped behind its watermarks so far."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"])


def progress(query) -> list[tuple[int, int, int, int, int]]:
    """(batch, rows in, rows of state, rows of state removed, late rows dropped) of each micro-batch."""
    rows = []
    for p in query.recentProgress:
        total = lambda name, ops=p["stateOperators"]: sum(int(op.get(name, 0)) for op in ops)
        rows.append((int(p["batchId"]), int(p["numInputRows"]), total("numRowsTotal"), total("numRowsRemoved"), total("numRowsDroppedByWatermark")))
    return rows


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """What ``tracks`` needs; holds for streams that start later in this session."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


#: A video, its frames, births, last frame and the time (ms) from which it is idle; its live tracks, whose numbers are float64 bytes.
_VIDEO = "video_id long, frames long, next_id long, last long, due long, ids array<long>, age array<long>, streak array<long>, x binary, p binary, vectors binary"
_NONE = ([], [], [], b"", b"", b"")
_OUT = "video_id long, frame long, ord long, track_id long"


class _Tracking(StatefulProcessor):
    """A bucket's videos are a list, a row each, read and written as a whole; those of a micro-batch run in step; a timer drops what is idle."""

    def __init__(self, max_age: int, min_hits: int, vector: str | None, timed: bool, idle_ms: int, reset: tuple[str, ...]):
        self.max_age, self.min_hits, self.vector, self.timed, self.idle_ms, self.reset = max_age, min_hits, vector, timed, idle_ms, reset

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.videos = handle.getListState("videos", _VIDEO)

    def _held(self) -> dict[int, tuple]:
        return {row[0]: tuple(row[1:]) for row in self.videos.get()} if self.videos.exists() else {}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(["video_id", "frame", "ord"])
        videos, first = np.unique(pdf["video_id"].to_numpy(np.int64), return_index=True)
        frame, of = pdf["frame"].to_numpy(np.int64), np.repeat(np.arange(len(videos)), np.diff(first, append=len(pdf)))
        kept = self._held()
        held = [kept.pop(v, None) for v in videos.tolist()]
        frames, next_id, last, due = np.array([h[:4] if h else (0, 0, f - 1, 0) for h, f in zip(held, frame[first].tolist(), strict=True)], np.int64).T
        live = [h[4:] if h else _NONE for h in held]
        if self.timed:
            seen = np.maximum.reduceat(pdf["ms"].to_numpy(np.int64), first)
            due = np.maximum(due, np.maximum(seen, timerValues.getCurrentWatermarkInMs()) + self.idle_ms)
        after = frame > last[of]
        if after.any():
            yield self._run(pdf[after], of[after], live, frames, next_id, last)
        now = zip(videos.tolist(), frames.tolist(), next_id.tolist(), last.tolist(), due.tolist(), live, strict=True)
        self.videos.put([(v, *state) for v, state in kept.items()] + [(*counts, *tracks) for *counts, tracks in now])
        if self.timed:
            self._wake(int(due.min()))

    def _run(self, pdf: pd.DataFrame, of: np.ndarray, live: list[tuple], frames: np.ndarray, next_id: np.ndarray, last: np.ndarray) -> pd.DataFrame:
        """The told rows of sorted new rows of videos ``of``. What is given of each video is brought up to date.

        A video is cut where none of its tracks survives. Parts run in step, and a video's
        first part goes on with its live tracks.
        """
        from ..operators.tracking import TOGETHER, Tracks, run_together

        frame = pdf["frame"].to_numpy(np.int64)
        new = np.diff(of, prepend=-1) != 0
        before = np.where(new, last[of], np.concatenate([frame[:1], frame[:-1]]))
        reset = np.zeros(len(frame), bool)
        if self.reset:
            start = np.flatnonzero(frame != before)
            reset[start] = np.logical_or.reduceat(pdf["kind"].isin(self.reset).to_numpy(), start)
        cut = new | reset | (frame - before > max(self.max_age + 1, self.min_hits))
        part, first = np.cumsum(cut) - 1, np.flatnonzero(cut)
        video, stop = of[first], np.append(first[1:], len(frame))
        is_head, is_tail = np.diff(video, prepend=-1) != 0, np.diff(video, append=-1) != 0
        head = np.flatnonzero(is_head)
        counted = frames[video] + frame[first] - 1 - last[video]
        gap, first_id = np.where(is_head, frame[first] - before[first] - 1, 0), np.where(is_head, next_id[video], 0)

        goes_on = [(k, live[v]) for k, v, anew in zip(head.tolist(), video[head].tolist(), reset[first[head]].tolist(), strict=True) if live[v][0] and not anew]
        ids, age, streak = (np.array([i for _, t in goes_on for i in t[c]], np.int64) for c in range(3))
        x, p, vectors = (np.frombuffer(b"".join(t[c] for _, t in goes_on)) for c in (3, 4, 5))
        on = np.repeat(np.array([k for k, _ in goes_on], np.int64), [len(t[0]) for _, t in goes_on])
        boxes = pdf[["x1", "y1", "x2", "y2"]].to_numpy(float)
        faces = np.stack(pdf[self.vector].to_numpy()).astype(float) if self.vector else None

        births, told, left = np.zeros(len(first), np.int64), [], []
        for a in range(0, len(first), TOGETHER):
            b = min(a + TOGETHER, len(first))
            some, r = slice(*np.searchsorted(on, [a, b])), slice(first[a], stop[b - 1])
            tracks = Tracks(b - a, self.max_age, self.min_hits)
            tracks.seq, tracks.ids, tracks.age, tracks.streak = on[some] - a, ids[some], age[some].copy(), streak[some].copy()
            tracks.x, tracks.p = x.reshape(-1, 7)[some].copy(), p.reshape(-1, 7, 7)[some].copy()
            if self.vector and len(tracks.ids):
                tracks.vectors = vectors.reshape(len(ids), -1)[some].copy()
            tracks.skip(gap[a:b])
            tracks.frames, tracks.next_id = counted[a:b].copy(), first_id[a:b].copy()
            row, found = run_together(part[r] - a, frame[r], boxes[r], faces[r] if self.vector else None, tracks, is_tail[a:b])
            tracks.keep(is_tail[tracks.seq + a])
            births[a:b] = tracks.next_id - first_id[a:b]
            told.append((row + first[a], found))
            left.append((tracks.seq + a, tracks.ids, tracks.age, tracks.streak, tracks.x, tracks.p, tracks.vectors if tracks.vectors is not None else np.zeros((len(tracks.ids), 0))))

        earlier = np.cumsum(births) - births
        shift = np.where(is_head, 0, next_id[video] + earlier - np.repeat(earlier[head], np.diff(head, append=len(first))))
        on, ids, age, streak, x, p = (np.concatenate([t[c] for t in left]) for c in range(6))
        vectors = np.concatenate([t[6] for t in left if len(t[0])] or [np.zeros((0, 0))])
        ids = ids + shift[on]
        tails = np.flatnonzero(is_tail)
        for v, lo, hi in zip(video[tails].tolist(), *np.searchsorted(on, [tails, tails + 1]).tolist(), strict=True):
            live[v] = (ids[lo:hi].tolist(), age[lo:hi].tolist(), streak[lo:hi].tolist(), x[lo:hi].tobytes(), p[lo:hi].tobytes(), vectors[lo:hi].tobytes())
        frames[video[tails]] += frame[stop[tails] - 1] - last[video[tails]]
        next_id[video[tails]] += np.add.reduceat(births, head)
        last[video[tails]] = frame[stop[tails] - 1]
        row, found = (np.concatenate(t) for t in zip(*told, strict=True))
        return pd.DataFrame({"video_id": pdf["video_id"].to_numpy()[row], "frame": frame[row], "ord": pdf["ord"].to_numpy()[row], "track_id": found + shift[part[row]]})

    def _wake(self, due: int) -> None:
        """One timer a bucket, not after the first of its videos is idle."""
        timers = list(self.handle.listTimers())
        if not timers or min(timers) > due:
            for timer in timers:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        if kept := [(v, *state) for v, state in self._held().items() if state[3] > now]:
            self.videos.put(kept)
            self.handle.registerTimer(min(row[4] for row in kept))
        else:
            self.videos.clear()
        yield pd.DataFrame([], columns=["video_id", "frame", "ord", "track_id"])

    def close(self) -> None:
        pass


def tracks(stream: DataFrame, max_age: int = 30, min_hits: int = 1, at: str | None = None, idle: str = "10 minutes", late: str = LATE, reset: tuple[str, ...] = (), vector: str | None = None, buckets: int = 512) -> DataFrame:
    """Online Kalman tracks of boxes (video_id, frame, ord, x1, y1, x2, y2, ``vector`` if named, kind if ``reset`` is given).

    As ``tracking.tracked`` on rows whose frames come in order; rows of a frame that is not
    after a video's last one are not told. Tracks end after ``max_age`` frames without a box,
    and a video's tracks where a row of a kind in ``reset`` comes. With an event time ``at``,
    a video's whole state goes once the watermark is ``idle`` past its last row; without one
    it stays. Videos are dealt by a hash to ``buckets``: a micro-batch reads and writes the
    state of each bucket that it has rows of as a whole, which is fast where most videos
    have rows; the more videos live at a time, and the fewer of them in a micro-batch, the
    more buckets are right. The number bounds the tasks that have work and must stay the same
    as long as a checkpoint is used. Rows without a video or frame are left out. States are
    kept in RocksDB (``keep_state_in_rocksdb``).
    """
    columns = ["video_id", "frame", "ord", "x1", "y1", "x2", "y2", *([vector] if vector else []), *(["kind"] if reset else []), *([at] if at else [])]
    stream = stream.select(*columns)
    stream = stream.withWatermark(at, late) if at else stream
    stream = stream.where("video_id is not null and frame is not null").withColumn("bucket", F.pmod(F.hash("video_id"), F.lit(buckets)))
    stream = stream.withColumn("ms", F.coalesce(F.unix_millis(F.col(at).cast("timestamp")), F.lit(0))) if at else stream
    processor = _Tracking(max_age, min_hits, vector, bool(at), int(pd.Timedelta(idle).total_seconds() * 1000), reset)
    return stream.groupBy("bucket").transformWithStateInPandas(processor, _OUT, "Append", "EventTime" if at else "None")
