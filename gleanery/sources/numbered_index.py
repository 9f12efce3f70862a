"""A compact index: documents have dense numbers in order of URL, postings are sorted numbers in blocks of a number range.

A block of a term holds places inside its range and counts, as integers that Parquet packs into few bits. Weights follow from
the counts, so they are not stored. URLs are looked up by number, after a search only for what it returns.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, DataFrameWriter, Row, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.index import idf, posting_lists
from gleanery.operators.joins import lookup_join
from gleanery.operators.ranking import rank_all
from gleanery.session import removes_stages, stage
from gleanery.sources.index_store import MAX_SHARDS, MIN_SHARDS, POSTINGS_PER_SHARD, any_of, shard_of

RANGE = 1 << 16  # documents of a block

BLOCKS = "term string, block int, df bigint, places array<int>, counts array<int>, shard int"
DOCUMENTS = "number bigint, url string, block int"


@dataclass(frozen=True)
class NumberedIndex:
    spark: SparkSession
    path: str

    @cached_property
    def stats(self) -> dict[str, int]:
        return self.spark.read.parquet(f"{self.path}/stats").first().asDict()

    def documents(self) -> DataFrame:
        """``(number, url, block)``; numbers run from 0 in order of the URL."""
        return self.spark.read.schema(DOCUMENTS).parquet(f"{self.path}/documents")

    def blocks(self) -> DataFrame:
        return self.spark.read.schema(BLOCKS).parquet(f"{self.path}/blocks")

    def placed(self, terms: DataFrame) -> DataFrame:
        return terms.withColumn("shard", shard_of(F.col("term"), self.stats["shards"]))

    def numbers(self, blocks: DataFrame) -> DataFrame:
        """``(term, number, block, tf, df, tfidf)`` of some blocks, without their URLs."""
        df = F.coalesce("df", F.size("places").cast("bigint")).alias("df")
        pairs = blocks.select("term", "block", df, F.explode(F.arrays_zip("places", "counts")).alias("p"))
        number = F.col("block").cast("bigint") * F.lit(self.stats["range"]) + F.col("p.places")
        rows = pairs.select("term", number.alias("number"), "block", F.col("p.counts").cast("bigint").alias("tf"), "df")
        return rows.withColumn("tfidf", F.col("tf") * idf(F.col("df"), max(1, self.stats["docs_count"])))

    def named(self, rows: DataFrame) -> DataFrame:
        """``rows`` (number, ...) with their ``url``."""
        return rows.join(self.documents().select("number", "url"), "number").drop("number", "block")

    def postings(self) -> DataFrame:
        """``(term, url, tf, df, tfidf)``."""
        return self.named(self.numbers(self.blocks())).select("term", "url", "tf", "df", "tfidf")

    def lookup(self, terms: Iterable[Row]) -> DataFrame:
        """Postings of terms given with their shards, reading only those shards and row groups."""
        found = {row["term"]: row["shard"] for row in terms}
        wanted = F.col("shard").isin(sorted(set(found.values()))) & any_of("term", sorted(found)) if found else F.lit(False)
        return self.named(self.numbers(self.blocks().filter(wanted))).select("term", "url", "tf", "df", "tfidf")


def _packed(writer: DataFrameWriter) -> DataFrameWriter:
    """Integers as packed differences instead of through a dictionary."""
    writer = writer.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
    return writer.option("parquet.enable.dictionary#places.list.element", "false")


@removes_stages
def write_numbered(pages: DataFrame, path: str, span: int = RANGE) -> NumberedIndex:
    """Write the compact index of ``pages (url, content)``, one row per URL, to ``path``.

    Pages are sorted by URL once, with their texts; a number is the place inside a part plus the rows of earlier parts.
    A block has at most ``span`` postings, so a term found everywhere is many rows.
    """
    spark = pages.sparkSession
    ranked = rank_all(pages.select("url", "content"), [], [F.col("url").asc()])
    numbered = stage(ranked.select("url", (F.col("rank") - 1).alias("number"), "content").withColumn("block", _block(F.col("number"), span)), "numbered")
    named = numbered.select("number", "url", "block").sortWithinPartitions("block", "number")
    _packed(named.write).partitionBy("block").parquet(f"{path}/documents")
    place = (F.col("number") % F.lit(span)).cast("int").alias("place")
    lists = posting_lists(numbered.select(place, "block", "content"), "place", F.col("block"))
    lists = lists.select("term", "block", F.arrays_zip(F.col("members").alias("place"), F.col("counts").alias("tf")).alias("postings"))
    lists = stage(lists.groupBy("term", "block").agg(F.sort_array(F.flatten(F.collect_list("postings"))).alias("postings")), "lists")
    df = stage(lists.groupBy("term").agg(F.sum(F.size("postings")).alias("df"), F.count("*").alias("blocks")), "df")
    postings, terms = df.agg(F.coalesce(F.sum("df"), F.lit(0)), F.count("*")).first()
    shards = int(min(MAX_SHARDS, max(MIN_SHARDS, postings // POSTINGS_PER_SHARD)))
    rows = lookup_join(lists, df, key="term", weight="blocks").withColumn("shard", shard_of(F.col("term"), shards))
    # A term of one block has as many postings as that.
    several = F.when(F.col("blocks") > 1, F.col("df")).alias("df")
    rows = rows.select("term", "block", several, F.col("postings.place").alias("places"), F.col("postings.tf").alias("counts"), "shard")
    _packed(rows.hint("rebalance", "shard").sortWithinPartitions("shard", "term", "block").write).partitionBy("shard").parquet(f"{path}/blocks")
    facts = [(numbered.count(), int(terms), int(postings), shards, span)]
    ddl = "docs_count bigint, terms_count bigint, postings_count bigint, shards int, range int"
    spark.createDataFrame(facts, ddl).coalesce(1).write.parquet(f"{path}/stats")
    return NumberedIndex(spark, path)


def _block(number: Column, span: int) -> Column:
    return F.floor(number / F.lit(span)).cast("int")
