"""Streams over growing folders of pages and queue events.

Every function starts a query and returns it. ``once=True`` processes what is there and stops;
otherwise the query runs on with the given trigger. Sinks that replace earlier results write one
folder per batch, so a batch that is run again after a failure overwrites its own output only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from gleanery.operators.frontier import REQUEUE_SECONDS, latest_pages
from gleanery.operators.metrics import SAMPLE_SECONDS, window_number, window_start
from gleanery.sources.incremental import refresh
from gleanery.sources.index_store import _file_system, write_index
from gleanery.sources.page_store import read_store, upsert
from gleanery.sources.segments import FACTS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REFRESH_SECONDS = 60


def stream_folder(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000,
                  only: str | None = None) -> DataFrame:
    """Rows of the Parquet files of a folder, as they appear; ``only`` is a file name pattern."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if only:
        reader = reader.option("pathGlobFilter", only)
    return reader.parquet(path)


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a Parquet table that is a single file, or a folder of files as they appear."""
    schema = spark.read.parquet(path).schema
    fs, root = _file_system(spark, path)
    if fs.getFileStatus(root).isDirectory():
        return stream_folder(spark, path, schema)
    folder, _, name = path.rstrip("/").rpartition("/")
    return stream_folder(spark, folder or ".", schema, only=name)


def _start(writer: DataStreamWriter, spark: SparkSession, once: bool, every: int,
           checkpoint: str | None, out: str) -> StreamingQuery:
    """Start with state in RocksDB, so that it may outgrow memory.

    The checkpoint lies beside the output unless another is given: a stream that is started again goes on.
    """
    trigger = {"availableNow": True} if once else {"processingTime": f"{every} seconds"}
    location = checkpoint or f"{out.rstrip('/')}.checkpoint"
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        return writer.option("checkpointLocation", location).trigger(**trigger).start()
    finally:
        spark.conf.set(key, before)


def _per_batch(stream: DataFrame, mode: str, handle: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    return stream.writeStream.outputMode(mode).foreachBatch(handle)


def _thinned(stream: DataFrame, order: list[str], keep: str) -> DataFrame:
    """One row per ``url`` and Arrow batch, the first or last in ``order``.

    Stateful steps have no combining of their own before their exchange; this keeps a URL that makes up
    much of a stream from sending all its rows to one task.
    """
    def thin(batches):
        for batch in batches:
            ordered = batch.sort_values(order) if order else batch
            yield ordered.drop_duplicates("url", keep=keep)

    return stream.mapInPandas(thin, stream.schema)


def copy_pages(pages: DataFrame, out: str, once: bool = False, every: int = REFRESH_SECONDS,
               checkpoint: str | None = None) -> StreamingQuery:
    """Page store rows ``(url, content)`` appended to ``out`` as they arrive."""
    writer = pages.select("url", "content").writeStream.format("parquet").option("path", out)
    return _start(writer, pages.sparkSession, once, every, checkpoint, out)


def seen_urls(urls: DataFrame, out: str, within: str | None = None, once: bool = False, every: int = 5,
              checkpoint: str | None = None) -> StreamingQuery:
    """First sighting of each ``url``.

    State is kept for ever, as a crawl needs it. With ``within`` (and a column ``ts``) a URL is only
    remembered that long, which bounds the state and lets it come back later.
    """
    if within:
        offered = _thinned(urls.select("url", "ts"), ["ts"], "first")
        first = offered.withWatermark("ts", within).dropDuplicatesWithinWatermark(["url"])
    else:
        first = _thinned(urls.select("url"), [], "first").dropDuplicates(["url"])
    writer = first.writeStream.format("parquet").option("path", out)
    return _start(writer, urls.sparkSession, once, every, checkpoint, out)


def completion_counts(log: DataFrame, out: str, seconds: int = SAMPLE_SECONDS, late: str | None = None,
                      once: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Completions per window; :func:`read_counts` gives the current counts."""
    done = log.filter(F.col("kind") == "complete")
    if late:
        done = done.withWatermark("ts", late).groupBy(F.window("ts", f"{seconds} seconds")).count()
        counts = done.select(F.col("window.start").alias("window_start"), F.col("count").alias("completed"))
    else:
        counts = done.groupBy(window_number(F.col("ts"), seconds).alias("id")).count().select(
            window_start(F.col("id"), seconds).alias("window_start"), F.col("count").alias("completed")
        )

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _start(_per_batch(counts, "update", save), log.sparkSession, once, seconds, checkpoint, out)


def read_counts(spark: SparkSession, out: str) -> DataFrame:
    """``(window_start, completed)`` from the newest batch that touched each window."""
    return spark.read.parquet(out).groupBy("window_start").agg(F.max_by("completed", "batch").alias("completed"))


def store_pages(pages: DataFrame, out: str, once: bool = False, every: int = 5,
                checkpoint: str | None = None) -> StreamingQuery:
    """Arriving versions ``(url, content, last_scraped)``; :func:`read_pages` gives the page store."""
    def save(batch: DataFrame, number: int) -> None:
        latest_pages(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _start(_per_batch(pages, "append", save), pages.sparkSession, once, every, checkpoint, out)


def read_pages(spark: SparkSession, out: str) -> DataFrame:
    return latest_pages(spark.read.parquet(out))


def upsert_store(pages: DataFrame, store: str, once: bool = False, every: int = 5,
                 checkpoint: str | None = None) -> StreamingQuery:
    """Write arriving versions ``(url, content, last_scraped)`` into the segments of a page store.

    Unlike with :func:`store_pages`, who reads the store afterwards does not go through every version there ever was.
    """
    def save(batch: DataFrame, _: int) -> None:
        upsert(batch, store)

    return _start(_per_batch(pages, "append", save), pages.sparkSession, once, every, checkpoint, store)


def page_changes(spark: SparkSession, store: str, out: str, once: bool = False, every: int = 5,
                 checkpoint: str | None = None) -> StreamingQuery:
    """``(version, url, kind, content, last_scraped)`` of every page that an upsert writes into the page store ``store``.

    The stream follows the statistics of the store's segments, one file for each complete upsert, so its offsets are
    upserts: one that did not finish is not seen, and a stream that is started again goes on behind the last one it wrote.
    """
    facts = spark.readStream.schema(FACTS).option("basePath", f"{store}/stats").parquet(f"{store}/stats/segment=*")

    def save(batch: DataFrame, number: int) -> None:
        # A row for each upsert and merge since the last batch; merges bring no versions.
        versions = [v for row in batch.filter(F.size("replaces") == 0).select("versions").collect() for v in row["versions"]]
        read_store(spark, store).changes(versions).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _start(_per_batch(facts, "append", save), spark, once, every, checkpoint, out)


def refresh_index(pages: DataFrame, store: str, index: str, once: bool = False,
                  every: int = REFRESH_SECONDS, checkpoint: str | None = None) -> StreamingQuery:
    """Store arriving pages and rebuild the index of the whole page store after each batch."""
    spark = pages.sparkSession

    def rebuild(batch: DataFrame, number: int) -> None:
        latest_pages(batch).write.mode("overwrite").parquet(f"{store}/batch={number}")
        write_index(read_pages(spark, store), index)

    return _start(_per_batch(pages, "append", rebuild), spark, once, every, checkpoint, store)


def refresh_segments(pages: DataFrame, index: str, once: bool = False, every: int = REFRESH_SECONDS,
                     checkpoint: str | None = None) -> StreamingQuery:
    """Write arriving pages ``(url, content, last_scraped)`` into the segments of an index, batch by batch.

    Unlike :func:`refresh_index` this reads no page twice. A batch that is run again replaces its own pages.
    """
    def write(batch: DataFrame, _: int) -> None:
        refresh(batch, index)

    return _start(_per_batch(pages, "append", write), pages.sparkSession, once, every, checkpoint, index)


def requeue(log: DataFrame, out: str, seconds: int = REQUEUE_SECONDS, late: str = "1 minute",
            once: bool = False, every: int = REQUEUE_SECONDS, checkpoint: str | None = None) -> StreamingQuery:
    """URLs not completed within ``seconds`` of their dispatch, as ``(url, dispatched_at)``.

    One state value per URL: its last event. A dispatch sets a timer on event time. A completion replaces it
    and is remembered until no earlier dispatch can arrive any more. Events up to ``late`` out of order are
    waited for; older ones are ignored.
    Only the last event of a URL in a batch matters, so its rows are looked at piece by piece.
    """
    import pandas as pd

    def follow(key, pieces, state):
        if state.hasTimedOut:
            us, _, in_flight = state.get
            state.remove()
            if in_flight:
                yield pd.DataFrame({"url": [key[0]], "sent_us": [us]})
            return
        last, in_flight = (tuple(state.get[:2]), state.get[2]) if state.exists else (None, False)
        for piece in pieces:
            newest = piece.sort_values(["us", "seq"]).iloc[-1]
            event = (int(newest["us"]), int(newest["seq"]))
            if last is None or event > last:
                last, in_flight = event, newest["kind"] == "dispatch"
        state.update((*last, in_flight))
        due = last[0] // 1000 + (seconds * 1000 if in_flight else 1)
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    moved = log.filter(F.col("kind").isin("dispatch", "complete")).select(
        "ts", "seq", "url", "kind", F.unix_micros("ts").alias("us")
    )
    back = (
        _thinned(moved, ["us", "seq"], "last")
        .withWatermark("ts", late)
        .groupBy("url")
        .applyInPandasWithState(
            follow, "url string, sent_us bigint", "us bigint, seq bigint, in_flight boolean", "append", "EventTimeTimeout"
        )
        .select("url", F.timestamp_micros("sent_us").alias("dispatched_at"))
    )
    writer = back.writeStream.format("parquet").option("path", out)
    return _start(writer, log.sparkSession, once, every, checkpoint, out)
