"""Throughput and queue length of a running queue, window by window and without gaps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gleanery.operators.metrics import SAMPLE_SECONDS, window_number, window_start
from gleanery.streaming.jobs import _per_batch, _start

CHUNK = 10_000  # rows of a frame
ROWS = "queue string, id bigint, completed bigint, queue_length bigint"
SUMS = "queue string, id bigint, completed bigint, change bigint, ts timestamp"


class Windows(StatefulProcessor):
    """The windows of one queue that late events may still change, and the queue's length before them.

    Events give the rows of all windows from the first that they change to the last, empty ones too. A timer at the end of
    the first open window closes what the watermark has passed: its counts go into the length and leave the state.
    """

    def __init__(self, seconds: int) -> None:
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "id bigint", "completed bigint, change bigint")
        self.place = handle.getValueState("place", "first bigint, last bigint, length bigint")

    def _end(self, window: int) -> int:
        return (window + 1) * self.seconds * 1000

    def _counts(self, window: int) -> tuple[int, int]:
        return tuple(self.open.getValue((window,))) if self.open.containsKey((window,)) else (0, 0)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sums = pd.concat([r.groupby("id")[["completed", "change"]].sum() for r in rows]).groupby(level=0).sum()
        known = self.place.exists()
        first, last, length = self.place.get() if known else (int(sums.index.min()), int(sums.index.max()), 0)
        if known and not first <= last:  # all closed; what lies between is empty
            last = first - 1
        early = int(sums.index.min())
        if early < first and not (known and self._end(early) <= timerValues.getCurrentWatermarkInMs()):
            first = early
        sums = sums[sums.index >= first]
        if not len(sums):
            return
        for window, completed, change in sums.itertuples():
            had = self._counts(int(window))
            self.open.updateValue((int(window),), (had[0] + int(completed), had[1] + int(change)))
        # What lies between the last window so far and the new ones is empty, and has no row yet.
        changed, out = min(int(sums.index.min()), last + 1), []
        last = max(last, int(sums.index.max()))
        self.place.update((first, last, length))
        self.handle.registerTimer(self._end(first))
        for window in range(first, last + 1):
            completed, change = self._counts(window)
            length += change
            if window >= changed:
                out.append((key[0], window, completed, length))
            if len(out) == CHUNK:
                yield pd.DataFrame(out, columns=["queue", "id", "completed", "queue_length"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["queue", "id", "completed", "queue_length"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, last, length = self.place.get()
        while first <= last and self._end(first) <= timerValues.getCurrentWatermarkInMs():
            length += self._counts(first)[1]
            if self.open.containsKey((first,)):
                self.open.removeKey((first,))
            first += 1
        self.place.update((first, last, length))
        if first <= last:
            self.handle.registerTimer(self._end(first))
        yield from ()

    def close(self) -> None:
        pass


def _summed(stream: DataFrame) -> DataFrame:
    """One row per queue, window and Arrow batch, so that a busy queue sends few rows to its task."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums = batch.groupby(["queue", "id"], as_index=False, dropna=False).agg({"completed": "sum", "change": "sum", "ts": "max"})
            yield sums[["queue", "id", "completed", "change", "ts"]]

    return stream.mapInPandas(add, SUMS)


def queue_series(log: DataFrame, out: str, seconds: int = SAMPLE_SECONDS, late: str = "1 minute", once: bool = False,
                 checkpoint: str | None = None) -> StreamingQuery:
    """Completions and queue length of every window of a log ``(ts, url, kind[, queue])``; :func:`read_series` gives them.

    A window in which nothing happens has a row as soon as a later event is there. The length is the number of URLs enqueued
    less those dispatched up to the window's end; an event that comes out of order corrects all later windows. Events later
    than ``late`` are ignored, which bounds the state. Without a column ``queue`` there is one queue.
    """
    queue = F.col("queue") if "queue" in log.columns else F.lit("")
    counted = log.select(
        F.coalesce(queue.cast("string"), F.lit("")).alias("queue"), window_number(F.col("ts"), seconds).alias("id"),
        F.when(F.col("kind") == "complete", 1).otherwise(0).cast("bigint").alias("completed"),
        F.when(F.col("kind") == "enqueue", 1).when(F.col("kind") == "dispatch", -1).otherwise(0).cast("bigint").alias("change"), "ts",
    ).filter("ts is not null")
    rows = _summed(counted).withWatermark("ts", late).groupBy("queue").transformWithStateInPandas(
        statefulProcessor=Windows(seconds), outputStructType=ROWS, outputMode="Update", timeMode="EventTime"
    )
    found = rows.select("queue", window_start(F.col("id"), seconds).alias("window_start"), "completed", "queue_length")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _start(_per_batch(found, "update", save), log.sparkSession, once, seconds, checkpoint, out)


def read_series(spark: SparkSession, out: str) -> DataFrame:
    """``(queue, window_start, completed, queue_length)`` from the newest batch that changed each window."""
    newest = F.max_by(F.struct("completed", "queue_length"), "batch").alias("row")
    found = spark.read.parquet(out).groupBy("queue", "window_start").agg(newest)
    return found.select("queue", "window_start", "row.completed", "row.queue_length")
