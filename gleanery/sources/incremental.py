"""An index that grows by segments: a refresh writes what its pages change and reads no other page.

A segment holds the term counts of its pages, their postings ordered by term inside shards, the pages' earlier versions
that it ends, and by how much it changes the document frequency of each term and the number of pages. All of it is written
once. Sums over the segments give N and DF, and postings of ended versions are left out, when the index is read. Segments of
like size are merged into one, so there are few, and each posting is rewritten a logarithmic number of times.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.frontier import latest_pages
from gleanery.operators.index import document_frequency, idf, term_counts
from gleanery.operators.joins import lookup_join, union_all
from gleanery.session import removes_stages, stage
from gleanery.sources.index_store import MAX_SHARDS, MIN_SHARDS, POSTINGS_PER_SHARD, any_of
from gleanery.sources.segments import Segment, commit, current, folder, like_segments, list_size, next_number, sweep

FAN = 4  # segments of like size that are merged
MAX_BROADCAST_DEAD = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20

PAGES = "url string, version bigint, last_scraped timestamp, counts array<struct<term: string, tf: bigint>>"
POSTINGS = "term string, url string, tf bigint, version bigint, shard int"
DF = "term string, df bigint"
DEAD = "url string, version bigint"


@dataclass(frozen=True)
class IncrementalIndex:
    """The segments that make up an index at one moment, read as one table of postings."""

    spark: SparkSession
    path: str
    segments: tuple[Segment, ...]

    def _read(self, what: str, ddl: str, chosen: Iterable[Segment] | None = None) -> DataFrame:
        parts = [s for s in (self.segments if chosen is None else chosen)]
        if not parts:
            return self.spark.createDataFrame([], ddl)
        read = self.spark.read.schema(ddl).option("basePath", f"{self.path}/{what}")
        return read.parquet(*[folder(self.path, what, s.number) for s in parts]).drop("segment")

    @cached_property
    def stats(self) -> dict[str, int]:
        terms = self.document_frequency().count()
        return {"docs_count": self.docs, "terms_count": terms, "postings_count": sum(s.postings for s in self.segments)}

    @property
    def docs(self) -> int:
        return sum(s.docs for s in self.segments)

    def document_frequency(self) -> DataFrame:
        """``(term, df)``: the sum of what every segment adds and takes away."""
        return self._read("df", DF).groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")

    @cached_property
    def _ended(self) -> list[int]:
        """The versions of which a segment has ended some page, no more than there were refreshes."""
        return sorted(r["version"] for r in self._read("dead", DEAD).select("version").distinct().collect())

    def _living(self, rows: DataFrame) -> DataFrame:
        """``rows`` (url, version, ...) without versions that a segment has ended.

        Beyond a list that can be broadcast, rows of versions of which no page was ended stay out of the join.
        """
        dead = self._read("dead", DEAD)
        if not sum(s.dead for s in self.segments):
            return rows
        few = sum(s.dead for s in self.segments) <= MAX_BROADCAST_DEAD and sum(s.dead_bytes for s in self.segments) <= MAX_BROADCAST_BYTES
        if few:
            return rows.join(F.broadcast(dead), ["url", "version"], "left_anti")
        hit = F.col("version").isin(self._ended)
        return rows.filter(~hit).unionByName(rows.filter(hit).join(dead, ["url", "version"], "left_anti"))

    def pages(self) -> DataFrame:
        """``(url, version, last_scraped, counts)`` of the pages in the index."""
        return self._living(self._read("pages", PAGES))

    def counts(self) -> DataFrame:
        """``(term, url, tf)`` of the pages in the index."""
        return self._living(self._read("postings", POSTINGS).select("term", "url", "tf", "version")).drop("version")

    def postings(self) -> DataFrame:
        """``(term, url, tf, df, tfidf)``."""
        frequency = stage(self.document_frequency(), "df")
        return self._scored(lookup_join(self.counts(), frequency, key="term", weight="df"))

    def _scored(self, found: DataFrame) -> DataFrame:
        return found.select("term", "url", "tf", "df", (F.col("tf") * idf(F.col("df"), self.docs)).alias("tfidf"))

    def placed(self, terms: DataFrame) -> DataFrame:
        """``terms`` with the hash of each ``term``, from which every segment has its shard."""
        return terms.withColumn("shard", F.xxhash64("term"))

    def lookup(self, terms: Iterable[Row]) -> DataFrame:
        """Postings of terms given with their hashes, from those shards and row groups of every segment."""
        found = {row["term"]: row["shard"] for row in terms}
        parts = [
            self._read("postings", POSTINGS, [s]).filter(F.col("shard").isin(sorted({h % s.shards for h in found.values()})))
            for s in self.segments if found
        ]
        if not parts:
            return self.postings().filter(F.lit(False))
        wanted = any_of("term", sorted(found))
        rows = self._living(union_all(parts).filter(wanted).select("term", "url", "tf", "version")).drop("version")
        frequency = self._read("df", DF).filter(wanted).groupBy("term").agg(F.sum("df").alias("df"))
        return self._scored(rows.join(F.broadcast(frequency), "term"))


def read_incremental(spark: SparkSession, path: str) -> IncrementalIndex:
    """The index as of its last complete refresh; an empty one if there was none."""
    return IncrementalIndex(spark, path, current(spark, path))


@removes_stages
def refresh(pages: DataFrame, path: str, removed: DataFrame | None = None, fan: int = FAN) -> IncrementalIndex:
    """Write ``pages (url, content, last_scraped)`` over those of the index at ``path`` and take out the URLs of ``removed``.

    Of several versions of a URL the last counts, and it replaces the one in the index unless that was scraped later. Pages
    without content are ignored. A URL both removed and scraped is written anew. Of the index only URLs and times are
    read, and the term lists in segments that hold a page which this refresh replaces. What is written becomes visible as a
    whole; running a refresh again gives the same index.
    """
    spark = pages.sparkSession
    index = read_incremental(spark, path)
    sweep(spark, path, ("postings", "pages", "dead", "df"))
    fresh = stage(latest_pages(pages), "fresh")
    offered = fresh.select("url", F.col("last_scraped").alias("new"), F.lit(False).alias("removed"))
    if removed is not None:
        gone = removed.select("url").filter("url is not null").distinct().join(fresh.select("url"), "url", "left_anti")
        offered = offered.unionByName(gone.select("url", F.lit(None).cast("timestamp").alias("new"), F.lit(True).alias("removed")))
        again = removed.select("url").distinct().withColumn("again", F.lit(True))
        offered = offered.join(again, "url", "left").withColumn("removed", F.col("removed") | F.coalesce("again", F.lit(False))).drop("again")
    old = stage(index.pages().select("url", "version", "last_scraped").join(offered, "url"), "offered")
    ends = F.col("removed") | (F.col("last_scraped") <= F.col("new"))
    later = old.filter(~ends).select("url")
    some_later = not later.isEmpty()
    number = next_number(spark, path)
    to = lambda what: folder(path, what, number)

    counted = (fresh.join(later, "url", "left_anti") if some_later else fresh).select(
        "url", F.lit(number).cast("bigint").alias("version"), "last_scraped", term_counts(F.col("content")).alias("counts")
    )
    counted.write.mode("overwrite").parquet(to("pages"))
    written = spark.read.schema(PAGES).parquet(to("pages"))
    old.filter(ends).select("url", "version").write.mode("overwrite").parquet(to("dead"))
    dead = spark.read.schema(DEAD).parquet(to("dead"))
    rows = written.select(F.explode("counts").alias("count"), "url", "version").select("count.term", "url", "count.tf", "version")

    ended = [r["version"] for r in dead.select("version").distinct().collect()]
    hit = [s for s in index.segments if set(s.versions) & set(ended)]
    lost = index._read("pages", PAGES, hit).join(dead, ["url", "version"], "left_semi").select(F.explode("counts.term").alias("term"))
    change = union_all([
        document_frequency(rows), lost.groupBy("term").agg((-F.count("*")).alias("df"))
    ]).groupBy("term").agg(F.sum("df").alias("df")).filter("df <> 0")
    change.write.mode("overwrite").parquet(to("df"))
    _commit(spark, path, number, rows, dead, docs=written.count() - dead.count(), versions=(number,), replaces=())
    return _merged(spark, path, fan)


def _merged(spark: SparkSession, path: str, fan: int) -> IncrementalIndex:
    """Merge segments until no ``fan`` of them are of like size."""
    while True:
        index = read_incremental(spark, path)
        like = like_segments(index.segments, fan)
        if not like:
            return index
        number = next_number(spark, path)
        to = lambda what, n=number: folder(path, what, n)
        versions = tuple(sorted(v for s in like for v in s.versions))
        index._living(index._read("pages", PAGES, like)).write.mode("overwrite").parquet(to("pages"))
        # Versions ended in the merged segments are left out above; only those in other segments are still to be known.
        others = index._read("dead", DEAD, like).filter(~F.col("version").isin(*versions))
        others.write.mode("overwrite").parquet(to("dead"))
        change = index._read("df", DF, like).groupBy("term").agg(F.sum("df").alias("df")).filter("df <> 0")
        change.write.mode("overwrite").parquet(to("df"))
        rows = index._living(index._read("postings", POSTINGS, like).drop("shard"))
        dead = spark.read.schema(DEAD).parquet(to("dead"))
        _commit(spark, path, number, rows, dead, docs=sum(s.docs for s in like), versions=versions, replaces=tuple(s.number for s in like))


def _commit(
    spark: SparkSession, path: str, number: int, rows: DataFrame, dead: DataFrame, docs: int, versions: tuple, replaces: tuple
) -> None:
    """Write the postings of a segment, then the row that makes it visible."""
    postings = spark.read.schema(PAGES).parquet(folder(path, "pages", number)).agg(F.coalesce(F.sum(F.size("counts")), F.lit(0))).first()[0]
    shards = int(min(MAX_SHARDS, max(MIN_SHARDS, postings // POSTINGS_PER_SHARD)))
    placed = rows.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))
    # Rebalancing splits the shard of a very frequent term over several files.
    dealt = placed.hint("rebalance", "shard").sortWithinPartitions("shard", "term")
    dealt.write.mode("overwrite").partitionBy("shard").parquet(folder(path, "postings", number))
    commit(spark, path, Segment(number, docs, int(postings), *list_size(dead), shards, tuple(versions), tuple(replaces)))
