"""Character trigrams of the terms and URLs of a saved index, to find the entries that hold a string anywhere.

A string of three or more characters can only be where its rarest trigram is: those few terms and URLs are looked at. Shorter
strings are looked for in the lists of all terms and URLs. Postings are read by the terms found, never as a whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.joins import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, lookup_join
from gleanery.operators.search import MAX_QUERY_BYTES, MAX_QUERY_TERMS
from gleanery.session import stage
from gleanery.sources.index_store import MAX_SHARDS, MIN_SHARDS, SavedIndex

GRAM = 3
ROWS_PER_SHARD = 5_000_000
TERM, URL = 0, 1

GRAMS = "gram string, kind int, value string, entries bigint, shard int"
COUNTS = "gram string, kind int, n bigint, shard int"
PAGES = "url string, terms array<string>, shard int"
TERMS = "term string, entries bigint"


def grams(text: Column) -> Column:
    """The distinct trigrams of a text; none of a shorter one."""
    places = F.sequence(F.lit(1), F.length(text) - F.lit(GRAM - 1))
    found = F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))
    return F.when(F.length(text) >= GRAM, found).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class GramIndex:
    """Trigrams of one generation of an index, in folders beside its postings."""

    index: SavedIndex

    def _read(self, what: str, ddl: str) -> DataFrame:
        return self.index.spark.read.schema(ddl).parquet(f"{self.index.path}/grams/{what}")

    def _shards(self) -> int:
        return self.index.spark.read.parquet(f"{self.index.path}/grams/facts").first()["shards"]

    def _holders(self, needle: str) -> tuple[DataFrame, DataFrame]:
        """``(term, entries)`` and ``(url)`` that contain ``needle``."""
        spark = self.index.spark
        if len(needle) < GRAM:
            terms, urls = self._read("terms", TERMS), self._read("pages", PAGES).select("url")
            return terms.filter(F.col("term").contains(needle)), urls.filter(F.col("url").contains(needle))
        wanted = sorted({needle[i : i + GRAM] for i in range(len(needle) - GRAM + 1)})
        row = spark.createDataFrame([(g,) for g in wanted], "gram string").select("gram", _place(F.col("gram"), self._shards()).alias("shard"))
        shards = {r["gram"]: r["shard"] for r in row.collect()}
        some = F.col("shard").isin(sorted(set(shards.values()))) & F.col("gram").isin(wanted)
        counts = {(r["kind"], r["gram"]): r["n"] for r in self._read("counts", COUNTS).filter(some).collect()}

        def holders(kind: int) -> DataFrame:
            rarest = min(wanted, key=lambda g: (counts.get((kind, g), 0), g))
            rows = self._read("grams", GRAMS).filter((F.col("shard") == shards[rarest]) & (F.col("gram") == rarest) & (F.col("kind") == kind))
            return rows.filter(F.col("value").contains(needle)).select("value", "entries")

        return holders(TERM).withColumnRenamed("value", "term"), holders(URL).select(F.col("value").alias("url"))

    def grep(self, needle: str) -> DataFrame:
        """Whole entries ``(term, url, tf, df, tfidf, shard)`` of the terms that contain ``needle`` or are on a page whose URL does."""
        terms, urls = self._holders(needle)
        urls = stage(urls, "found-urls")
        size = urls.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("url")), F.lit(0))).first()
        found = terms.select("term")
        if size[0]:
            few = size[0] <= MAX_BROADCAST_ROWS and size[1] <= MAX_BROADCAST_BYTES
            places = urls.withColumn("shard", _place(F.col("url"), self._shards()))
            at = [r["shard"] for r in places.select("shard").distinct().collect()]
            pages = self._read("pages", PAGES).filter(F.col("shard").isin(sorted(at)))
            pages = pages.join(F.broadcast(urls) if few else urls, "url", "left_semi")
            found = found.unionByName(pages.select(F.explode("terms").alias("term")))
        found = stage(found.distinct().join(self._read("terms", TERMS), "term"), "found-terms")
        size = found.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
        if size[0] <= MAX_QUERY_TERMS and size[1] <= MAX_QUERY_BYTES:
            return self.index.lookup(self.index.placed(found).collect())
        return lookup_join(self.index.postings(), found, key="term", weight="entries").drop("entries")


def _place(value: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(shards)).cast("int")


def write_grams(index: SavedIndex) -> GramIndex:
    """Write the trigrams of an index's terms and URLs beside it.

    A trigram that most URLs share is many rows, in files of limited size; it is no group. The facts are written last.
    """
    spark, path = index.spark, f"{index.path}/grams"
    shards = int(min(MAX_SHARDS, max(MIN_SHARDS, math.ceil(index.stats["postings_count"] / ROWS_PER_SHARD))))
    postings = index.postings().select("term", "url", "df")
    postings.groupBy("term").agg(F.max("df").alias("entries")).write.mode("overwrite").parquet(f"{path}/terms")
    pages = postings.groupBy("url").agg(F.collect_list("term").alias("terms")).withColumn("shard", _place(F.col("url"), shards))
    pages.hint("rebalance", "shard").sortWithinPartitions("shard", "url").write.mode("overwrite").partitionBy("shard").parquet(f"{path}/pages")
    read = GramIndex(index)
    values = read._read("terms", TERMS).select(F.lit(TERM).alias("kind"), F.col("term").alias("value"), "entries").unionByName(
        read._read("pages", PAGES).select(F.lit(URL).alias("kind"), F.col("url").alias("value"), F.lit(None).cast("bigint").alias("entries"))
    )
    rows = values.select(F.explode(grams(F.col("value"))).alias("gram"), "kind", "value", "entries").withColumn("shard", _place(F.col("gram"), shards))
    rows.hint("rebalance", "shard").sortWithinPartitions("shard", "gram", "kind").write.mode("overwrite").partitionBy("shard").parquet(f"{path}/grams")
    counts = read._read("grams", GRAMS).groupBy("gram", "kind", "shard").agg(F.count("*").alias("n"))
    counts.hint("rebalance", "shard").sortWithinPartitions("shard", "gram").write.mode("overwrite").partitionBy("shard").parquet(f"{path}/counts")
    spark.createDataFrame([(shards,)], "shards int").coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")
    return read
