"""The stream of throughput and queue length over several batches against the batch job on the same events."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gleanery.operators import metrics
from gleanery.streaming import jobs
from gleanery.streaming.series import queue_series, read_series

NOON = datetime(2024, 1, 1, 12)
DDL = "ts timestamp, url string, kind string, queue string"


def rows(spark, events):
    return spark.createDataFrame([(NOON + timedelta(seconds=s), "u", kind, queue) for s, kind, queue in events], DDL)


def fed(spark, path, out, batches, **how):
    for n, events in enumerate(batches):
        rows(spark, events).coalesce(1).write.parquet(f"{path}/part{n}")
        stream = jobs.stream_folder(spark, f"{path}/part*", rows(spark, []).schema, files_per_batch=1)
        queue_series(stream, out, 5, once=True, **how).awaitTermination()
    return {(r.queue, r.window_start.replace(tzinfo=None)): (r.completed, r.queue_length) for r in read_series(spark, out).collect()}


def batch(spark, events, queue):
    found = metrics.throughput(rows(spark, [e for e in events if e[2] == queue]), 5)
    return {(queue or "", r.window_start.replace(tzinfo=None)): (r.completed, r.queue_length) for r in found.collect()}


def test_rows_equal_the_batch_job_with_gaps_and_late_events(spark, tmp_path):
    batches = [
        [(0, "enqueue", "a"), (1, "enqueue", "a"), (2, "dispatch", "a"), (12, "complete", "a"), (3, "enqueue", "b")],
        [(40, "dispatch", "a"), (14, "enqueue", "a"), (41, "complete", "a")],  # a gap, and an event out of order
        [(33, "enqueue", "a"), (300, "enqueue", "a")],  # a gap that closes what is before it
        [(310, "complete", "b"), (311, "dispatch", "a")],
    ]
    got = fed(spark, str(tmp_path / "in"), str(tmp_path / "out"), batches)
    events = [e for part in batches for e in part]
    assert got == batch(spark, events, "a") | batch(spark, events, "b")
    assert got["a", NOON + timedelta(seconds=100)] == (0, 2) and len([k for k in got if k[0] == "a"]) == 63


def test_events_beyond_the_delay_are_ignored_and_state_goes_on(spark, tmp_path):
    batches = [[(0, "enqueue", None), (4, "complete", None)], [(100, "enqueue", None)], [(200, "dispatch", None)], [(1, "enqueue", None), (202, "complete", None)]]
    got = fed(spark, str(tmp_path / "in"), str(tmp_path / "out"), batches, late="10 seconds")
    kept = [e for part in batches for e in part if e != (1, "enqueue", None)]
    assert got == batch(spark, kept, None)


def test_an_empty_stream(spark, tmp_path):
    stream = jobs.stream_folder(spark, str(tmp_path), rows(spark, []).schema)
    query = queue_series(stream.withColumn("queue", F.lit(None).cast("string")), str(tmp_path / "out"), 5, once=True, checkpoint=str(tmp_path / "c"))
    query.awaitTermination()
    assert query.exception() is None
