"""Throughput and queue length over fixed windows of the queue log."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_SECONDS = 5
WINDOWS_PER_CHUNK = 4096


def window_number(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("bigint")


def window_start(number: Column, seconds: int) -> Column:
    return F.timestamp_seconds(number * F.lit(seconds))


def _per_window(log: DataFrame, seconds: int, value: Column) -> DataFrame:
    """``(id, n)``: sum of ``value`` for every window from the first event to the last, without gaps."""
    numbered = log.select(window_number(F.col("ts"), seconds).alias("id"), value.alias("value"))
    first, last = numbered.agg(F.min("id"), F.max("id")).first()
    if first is None:
        first, last = 0, -1
    sums = numbered.groupBy("id").agg(F.sum("value").alias("value"))
    windows = log.sparkSession.range(first, last + 1)
    return windows.join(sums, "id", "left").select("id", F.coalesce("value", F.lit(0)).alias("n"))


def completion_rate(log: DataFrame, seconds: int = SAMPLE_SECONDS) -> DataFrame:
    """``(window_start, completed)``; windows in which nothing was completed have a zero row."""
    rates = _per_window(log, seconds, F.when(F.col("kind") == "complete", 1).otherwise(0))
    return rates.select(window_start(F.col("id"), seconds).alias("window_start"), F.col("n").alias("completed"))


def queue_length(log: DataFrame, seconds: int = SAMPLE_SECONDS) -> DataFrame:
    """``(window_start, queue_length)`` at the end of every window: enqueued minus dispatched so far.

    The running sum works in two levels: over the totals of chunks of windows, then inside chunks.
    """
    change = F.when(F.col("kind") == "enqueue", 1).when(F.col("kind") == "dispatch", -1).otherwise(0)
    changes = _per_window(log, seconds, change).withColumn(
        "chunk", F.expr(f"id div {WINDOWS_PER_CHUNK}")
    )
    earlier = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = changes.groupBy("chunk").agg(F.sum("n").alias("total")).select(
        "chunk", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before")
    )
    so_far = Window.partitionBy("chunk").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    inside = changes.withColumn("inside", F.sum("n").over(so_far))
    return inside.join(chunks, "chunk").select(
        window_start(F.col("id"), seconds).alias("window_start"),
        (F.col("before") + F.col("inside")).alias("queue_length"),
    )


def throughput(log: DataFrame, seconds: int = SAMPLE_SECONDS) -> DataFrame:
    """``(window_start, completed, queue_length)``: the rows of the throughput file."""
    return completion_rate(log, seconds).join(queue_length(log, seconds), "window_start")


def index_metrics(index, seconds: float) -> DataFrame:
    """One row ``(timestamp, time_taken, docs_count, terms_count)`` for a finished index build."""
    return index.spark.range(1).select(
        F.lit(datetime.now(timezone.utc)).alias("timestamp"),
        F.lit(float(seconds)).alias("time_taken"),
        F.lit(index.stats["docs_count"]).cast("bigint").alias("docs_count"),
        F.lit(index.stats["terms_count"]).cast("bigint").alias("terms_count"),
    )


def search_timings(queries: DataFrame, seconds: float) -> DataFrame:
    """``(term, time_taken_s)``: queries of a batch share one job, hence one time."""
    return queries.select(F.col("query").alias("term"), F.lit(float(seconds)).alias("time_taken_s"))
