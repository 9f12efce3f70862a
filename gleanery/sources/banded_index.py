"""An index in bands of documents of like length, with the greatest score of each frequent term in each band.

A score is a sum of counts times weights, so a band of short documents can't score high. All postings of a document lie
in its band; what a query can reach there at most is known before any of them is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.index import idf, term_counts
from gleanery.operators.joins import lookup_join, lookup_size
from gleanery.session import fan_out, removes_stages, stage
from gleanery.sources.index_store import MAX_SHARDS, POSTINGS_PER_SHARD, any_of, shard_of

BANDS_PER_DOUBLING = 2
LONG = 64  # a term with fewer postings has no maxima; all of it is read
MAXIMA_SHARDS = 16
POSTINGS = "term string, url string, tf bigint, df bigint, tfidf double, band int, shard int"
MAXIMA = "term string, band int, most double, postings bigint, shard int"


def band_of(length: Column) -> Column:
    """Number of the band of documents with ``length`` tokens: the lengths of a band differ by a constant factor."""
    return F.floor(F.lit(float(BANDS_PER_DOUBLING)) * F.log2(length.cast("double"))).cast("int")


@dataclass(frozen=True)
class BandedIndex:
    spark: SparkSession
    path: str

    @cached_property
    def bands(self) -> dict[int, int]:
        """Shards of each band."""
        return {r["band"]: r["shards"] for r in self.spark.read.parquet(f"{self.path}/bands").collect()}

    def postings(self) -> DataFrame:
        return self.spark.read.schema(POSTINGS).parquet(f"{self.path}/postings")

    def maxima(self, terms: Iterable[str]) -> DataFrame:
        """``(term, band, most, postings)`` of the terms that have many postings."""
        found = sorted(set(terms))
        read = self.spark.read.schema(MAXIMA).parquet(f"{self.path}/maxima")
        return read.filter(any_of("term", found) if found else F.lit(False)).drop("shard")

    def hashed(self, terms: DataFrame) -> DataFrame:
        return terms.withColumn("hash", F.xxhash64("term"))

    def lookup(self, wanted: Iterable[Row]) -> DataFrame:
        """Postings of the pairs ``(term, hash, band)``; a null band stands for all. Only their shards of their bands are read."""
        by_band: dict[int, set[int]] = {}
        terms = set()
        for row in wanted:
            terms.add(row["term"])
            for band in self.bands if row["band"] is None else [row["band"]]:
                by_band.setdefault(band, set()).add(row["hash"] % self.bands[band])
        folders = " OR ".join(f"(band = {b} AND shard IN ({', '.join(map(str, sorted(s)))}))" for b, s in sorted(by_band.items()))
        if not folders:
            return self.postings().filter(F.lit(False))
        return self.postings().filter(F.expr(folders)).filter(any_of("term", sorted(terms)))


@removes_stages
def write_banded(pages: DataFrame, path: str, long: int = LONG) -> BandedIndex:
    """Write the index of ``pages (url, content)``, one row per URL, to ``path``. Pages without tokens count as documents."""
    spark = pages.sparkSession
    counted = fan_out(pages.select("url", "content")).select("url", term_counts(F.col("content")).alias("counts"))
    counted = stage(counted, "counted")
    docs = counted.count()
    length = F.aggregate("counts", F.lit(0).cast("bigint"), lambda total, c: total + c["tf"])
    rows = counted.filter(F.size("counts") > 0).withColumn("band", band_of(length)).select("url", "band", F.explode("counts").alias("c"))
    rows = rows.select("c.term", "url", "c.tf", "band")
    df = stage(rows.groupBy("term").agg(F.count("*").alias("df")), "df")
    joined = lookup_join(rows, df, key="term", weight="df", size=lookup_size(df, "term", "df"))
    scored = joined.withColumn("tfidf", F.col("tf") * idf(F.col("df"), max(1, docs)))

    sizes = {r["band"]: r["postings"] for r in counted.filter(F.size("counts") > 0).groupBy(band_of(length).alias("band")).agg(
        F.sum(F.size("counts")).alias("postings")).collect()}
    shards = {band: int(min(MAX_SHARDS, max(1, math.ceil(n / POSTINGS_PER_SHARD)))) for band, n in sizes.items()}
    # Few bands: their number grows with the logarithm of the longest document.
    each = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(shards.items()) for x in pair]), F.col("band")) if shards else F.lit(1)
    placed = scored.withColumn("shard", F.pmod(F.xxhash64("term"), each).cast("int"))
    placed = placed.hint("rebalance", "band", "shard").sortWithinPartitions("band", "shard", "term")
    placed.select("term", "url", "tf", "df", "tfidf", "band", "shard").write.partitionBy("band", "shard").parquet(f"{path}/postings")
    index = BandedIndex(spark, path)
    often = index.postings().filter(F.col("df") >= long)
    most = often.groupBy("term", "band").agg(F.max("tfidf").alias("most"), F.count("*").alias("postings"))
    most = most.withColumn("shard", shard_of(F.col("term"), MAXIMA_SHARDS)).hint("rebalance", "shard").sortWithinPartitions("shard", "term")
    most.write.partitionBy("shard").parquet(f"{path}/maxima")
    facts = spark.createDataFrame(sorted(shards.items()), "band int, shards int")
    facts.coalesce(1).write.parquet(f"{path}/bands")
    return index
