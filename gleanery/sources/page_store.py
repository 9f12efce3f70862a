"""The page store as segments in shards by URL: an upsert writes its own pages and reads URLs and times of the others.

The content of stored pages is in no exchange: pages that a later version has replaced are left out where they are read, and
compaction rewrites segments of like size in place.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.frontier import latest_pages
from gleanery.operators.joins import union_all
from gleanery.session import removes_stages, stage
from gleanery.sources.segments import Segment, commit, current, folder, like_segments, list_size, next_number, sweep

SHARDS = 64
FAN = 4
LIST_BYTES = 32 << 20  # of ended versions that go to every task at once

PAGES = "url string, content string, last_scraped timestamp, version bigint, first boolean, shard int"
DEAD = "url string, version bigint, shard int"


def page_shard(url: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(shards)).cast("int")


@dataclass(frozen=True)
class PageStore:
    spark: SparkSession
    path: str
    segments: tuple[Segment, ...]

    @property
    def shards(self) -> int:
        return self.segments[0].shards if self.segments else SHARDS

    @property
    def rows(self) -> int:
        return sum(s.docs for s in self.segments)

    def _read(self, what: str, ddl: str, chosen: Iterable[Segment] | None = None) -> DataFrame:
        parts = list(self.segments if chosen is None else chosen)
        if not parts:
            return self.spark.createDataFrame([], ddl)
        read = self.spark.read.schema(ddl).option("basePath", f"{self.path}/{what}")
        return read.parquet(*[folder(self.path, what, s.number) for s in parts]).drop("segment")

    def living(self, rows: DataFrame) -> DataFrame:
        """``rows`` (url, version, shard, ...) without replaced versions, without an exchange of ``rows``.

        The list of replaced versions goes to every task; a long one in parts, each with the shards that it speaks of.
        """
        size = sum(s.dead_bytes for s in self.segments)
        if not size:
            return rows
        dead, parts = self._read("dead", DEAD), min(self.shards, math.ceil(size / LIST_BYTES))
        part = lambda found, n: found.filter(F.col("shard") % parts == n) if parts > 1 else found
        return union_all([
            part(rows, n).join(F.broadcast(part(dead, n).select("url", "version")), ["url", "version"], "left_anti").select(*rows.columns)
            for n in range(parts)
        ])

    def stored(self, chosen: Iterable[Segment] | None = None) -> DataFrame:
        return self.living(self._read("pages", PAGES, chosen))

    def changes(self, versions: Iterable[int]) -> DataFrame:
        """``(version, url, kind, content, last_scraped)`` of the pages that some versions wrote: ``new`` or ``changed``.

        A page that a later version had replaced when segments were merged is left out: its place is in the later one.
        """
        wanted = sorted(set(versions))
        holding = [s for s in self.segments if set(s.versions) & set(wanted)]
        written = self._read("pages", PAGES, holding).filter(F.col("version").isin(wanted))
        kind = F.when(F.col("first"), "new").otherwise("changed")
        return written.select("version", "url", kind.alias("kind"), "content", "last_scraped")

    def pages(self) -> DataFrame:
        """``(url, content, last_scraped)``, one row per URL."""
        return self.stored().select("url", "content", "last_scraped")


def read_store(spark: SparkSession, path: str) -> PageStore:
    """The store as of its last complete upsert; an empty one if there was none."""
    return PageStore(spark, path, current(spark, path))


@removes_stages
def upsert(batch: DataFrame, path: str, shards: int = SHARDS, fan: int = FAN) -> PageStore:
    """Write ``batch (url, content, last_scraped)`` over the pages of the store at ``path``.

    Of several versions of a URL the last scraped stays, of those scraped at one time the one written last. Pages without
    content are no versions. An upsert that is run again leaves the same pages. ``shards`` counts for a new store.
    """
    spark = batch.sparkSession
    store = read_store(spark, path)
    sweep(spark, path, ("pages", "dead"))
    shards = store.shards if store.segments else shards
    fresh = stage(latest_pages(batch).withColumn("shard", page_shard(F.col("url"), shards)), "fresh")
    touched = [r["shard"] for r in fresh.select("shard").distinct().collect()]
    times = fresh.select("url", F.col("last_scraped").alias("new"))
    known = store.stored().filter(F.col("shard").isin(touched)).select("url", "version", "last_scraped", "shard")
    old = stage(known.join(times, "url"), "known")
    replaced = F.col("last_scraped") <= F.col("new")
    number = next_number(spark, path)
    dead = old.filter(replaced).select("url", "version", "shard")
    dead.write.mode("overwrite").partitionBy("shard").parquet(folder(path, "dead", number))
    written = fresh.join(old.select("url", replaced.alias("replaced")), "url", "left").filter(F.coalesce("replaced", F.lit(True)))
    written = written.withColumn("version", F.lit(number).cast("bigint")).withColumn("first", F.col("replaced").isNull())
    written = written.hint("rebalance", "shard").sortWithinPartitions("shard", "url").select(*_names())
    written.write.mode("overwrite").partitionBy("shard").parquet(folder(path, "pages", number))
    rows = spark.read.schema(PAGES).parquet(folder(path, "pages", number)).count()
    size = list_size(dead)
    commit(spark, path, Segment(number, rows - size[0], rows, *size, shards, (number,), ()))
    return _compacted(spark, path, fan)


def _names() -> list[str]:
    return [column.split()[0] for column in PAGES.split(", ")]


def _compacted(spark: SparkSession, path: str, fan: int) -> PageStore:
    while True:
        store = read_store(spark, path)
        like = like_segments(store.segments, fan)
        if not like:
            return store
        number, versions = next_number(spark, path), tuple(sorted(v for s in like for v in s.versions))
        store.stored(like).select(*_names()).write.mode("overwrite").partitionBy("shard").parquet(folder(path, "pages", number))
        dead = store._read("dead", DEAD, like).filter(~F.col("version").isin(*versions))
        dead.write.mode("overwrite").partitionBy("shard").parquet(folder(path, "dead", number))
        rows = spark.read.schema(PAGES).parquet(folder(path, "pages", number)).count()
        facts = (sum(s.docs for s in like), rows, *list_size(dead), store.shards, versions, tuple(s.number for s in like))
        commit(spark, path, Segment(number, *facts))
