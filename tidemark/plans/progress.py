"""Progress that can be watched: rows and failures counted while a batch or a stream runs."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class Progress:
    """Counts of one batch job. ``tell(done, failed)`` is called, from a thread, whenever they have changed.

    While the job runs the counts come from tasks that have ended, so a task that runs again
    may count twice; ``total`` is exact, as it comes from the job's own result.
    """

    def __init__(self, spark: SparkSession, tell: Callable[[int, int], None], every: float = 0.2):
        self.done, self.failed = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
        self.tell, self.every, self.observation = tell, every, Observation()
        self._stop = threading.Event()

    def watch(self, rows: DataFrame, failed: Column | None = None) -> DataFrame:
        """``rows``, counted; ``failed`` tells which of them count as failures."""
        bad = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
        done, lost = self.done, self.failed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flags = batch.column(batch.num_columns - 1)
                done.add(batch.num_rows)
                lost.add(sum(flags.to_pylist()))
                yield batch.select(batch.schema.names[:-1])

        marked = rows.withColumn("__failed", bad)
        counted = marked.observe(self.observation, F.count("*").alias("done"), F.count_if("__failed").alias("failed"))
        return counted.mapInArrow(run, rows.schema)

    def __enter__(self) -> Progress:
        def poll() -> None:
            told = None
            while not self._stop.is_set():
                now = self.done.value, self.failed.value
                if now != told and now[0]:
                    self.tell(*now)
                    told = now
                self._stop.wait(self.every)

        self._thread = threading.Thread(target=poll, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *error) -> None:
        self._stop.set()
        self._thread.join()

    @property
    def total(self) -> tuple[int, int]:
        """(rows, failures) once an action on the watched rows has ended."""
        got = self.observation.get
        return got["done"], got["failed"]


class StreamProgress(StreamingQueryListener):
    """Adds up the observed metrics ``name`` (done, failed) of a stream's micro-batches; ``tell`` gets the sums so far."""

    def __init__(self, name: str, tell: Callable[[int, int], None]):
        self.name, self.tell, self.sums = name, tell, [0, 0]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None and row["done"]:
            self.sums = [self.sums[0] + row["done"], self.sums[1] + row["failed"]]
            self.tell(*self.sums)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def observed(stream: DataFrame, name: str, failed: Column | None = None) -> DataFrame:
    """A stream whose micro-batches tell ``StreamProgress`` their rows and failures."""
    bad = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
    return stream.observe(name, F.count("*").alias("done"), F.count_if(bad).alias("failed"))
