"""The saved index: postings ordered by term inside shard folders, replaced as a whole."""

from __future__ import annotations

import math
import time
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.index import cut_lists, list_frequency, posting_lists, weighted
from gleanery.operators.joins import lookup_join, lookup_size
from gleanery.session import one_writer, removes_stages

POSTINGS_PER_SHARD = 5_000_000
POSTINGS = "term string, url string, tf bigint, df bigint, tfidf double, shard int"
MIN_SHARDS, MAX_SHARDS = 8, 4096
POSTINGS_PER_FILE = 4_000_000
MIN_POSTINGS_PER_FILE = 50_000
LISTS_PER_FILE = 8  # of a term in several files at least, so that these are of like size
MAX_PUSHED_TERMS = 32


def shard_of(term: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(shards)).cast("int")


def any_of(column: str, values: list[str]) -> Column:
    """Equality with any value, spelled out: every one reaches the Parquet statistics.

    A long IN list would only be pushed down as one range from its least to its greatest value. Terms
    are letters and digits; a value with other signs, or a longer list, falls back to IN: that is one probe of a
    hash set a row, while a long chain of comparisons is more code than the virtual machine compiles.
    """
    if len(values) > MAX_PUSHED_TERMS or not all(value.isalnum() for value in values):
        return F.col(column).isin(values)
    return F.expr(" OR ".join(f"{column} = '{value}'" for value in values))


@dataclass(frozen=True)
class SavedIndex:
    """A committed generation of an index."""

    spark: SparkSession
    path: str

    @cached_property
    def stats(self) -> dict[str, int]:
        return self.spark.read.parquet(f"{self.path}/stats").first().asDict()

    def postings(self) -> DataFrame:
        """``(term, url, tf, df, tfidf, shard)``."""
        return self.spark.read.schema(POSTINGS).parquet(f"{self.path}/postings")

    def placed(self, terms: DataFrame) -> DataFrame:
        """``terms`` with the ``shard`` of each ``term``."""
        return terms.withColumn("shard", shard_of(F.col("term"), self.stats["shards"]))

    def lookup(self, terms: Iterable[Row]) -> DataFrame:
        """Postings of terms given with their shards, reading only those shards and row groups.

        The terms become part of the plan, so there must not be too many.
        """
        found = {row["term"]: row["shard"] for row in terms}
        if not found:
            return self.postings().filter(F.lit(False))
        return self.postings().filter(
            F.col("shard").isin(sorted(set(found.values()))) & any_of("term", sorted(found))
        )


@removes_stages
def write_index(pages: DataFrame, path: str, shards: int | None = None) -> SavedIndex | None:
    """Build the index of ``pages`` and make it the current one at ``path``.

    An empty page table returns ``None`` and leaves the index as it is. The new generation is
    complete before the older ones are removed, so a failed build costs nothing, and the one just
    replaced stays until the next build for searches that still read it.
    """
    spark = pages.sparkSession
    docs = pages.count()
    if docs == 0:
        return None
    lists = posting_lists(pages, "url", F.lit(0))
    df = list_frequency(lists)
    size = lookup_size(df, "term", "lists")
    postings, longest = df.agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.max("longest"), F.lit(0))).first()
    if shards is None:
        shards = int(min(MAX_SHARDS, max(MIN_SHARDS, postings // POSTINGS_PER_SHARD)))

    target = f"{path}/generation={time.time_ns():020d}"
    cores = spark.sparkContext.defaultParallelism
    per_file = min(POSTINGS_PER_FILE, max(MIN_POSTINGS_PER_FILE, postings // (2 * cores)))
    parts = math.ceil(postings / (shards * per_file)) or 1
    # Lists are exchanged and sorted, and become postings as they are written. A task has one shard, if no long
    # list is spread beyond its own, and writes its file in the order of the terms.
    known = lookup_join(lists, df, key="term", weight="lists", size=size).select("term", "members", "counts", "df")
    sorted_lists = (
        (cut_lists(known, max(1, per_file // LISTS_PER_FILE)) if longest > per_file // LISTS_PER_FILE else known)
        .repartitionById(shards * parts, _part(shards, parts, per_file))
        .sortWithinPartitions("term")
    )
    with one_writer(spark):
        (
            weighted(sorted_lists, docs)
            .withColumn("shard", shard_of(F.col("term"), shards))
            .write.partitionBy("shard")
            # A lookup skips files in whose range a term lies without being there.
            .option("parquet.bloom.filter.enabled#term", "true")
            .option("parquet.bloom.filter.expected.ndv#term", str(max(100, size["keys"] // (shards * parts))))
            .parquet(f"{target}/postings")
        )
    spark.range(1).select(
        F.lit(docs).cast("bigint").alias("docs_count"),
        F.lit(size["keys"]).cast("bigint").alias("terms_count"),
        F.lit(postings).cast("bigint").alias("postings_count"),
        F.lit(shards).cast("int").alias("shards"),
    ).coalesce(1).write.parquet(f"{target}/stats")
    _drop_older(spark, path, keep=2)
    return SavedIndex(spark, target)


def _part(shards: int, parts: int, per_file: int) -> Column:
    """The task that writes a list of postings: every shard has ``parts`` tasks.

    A term stays in one part of its shard, except that the lists of one with more than ``per_file`` postings
    are spread by their first URL over as many tasks as they would fill files. The document frequency is at hand
    in every row, so this needs neither sampling nor another pass.
    """
    cuts = F.ceil(F.col("df") / F.lit(per_file))
    spread = F.pmod(F.xxhash64(F.get("members", F.lit(0))), cuts)
    shift = F.when(cuts > 1, spread).otherwise(F.pmod(F.hash("term"), F.lit(parts)))
    return F.pmod(shard_of(F.col("term"), shards) * F.lit(parts) + shift, F.lit(shards * parts)).cast("int")


def read_index(spark: SparkSession, path: str) -> SavedIndex:
    """The newest complete generation."""
    found = _generations(spark, path)
    if not found:
        raise FileNotFoundError(f"no complete index at {path}")
    return SavedIndex(spark, found[-1])


def _generations(spark: SparkSession, path: str) -> list[str]:
    """Complete generations in order of age. The statistics are written last and mark completion."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return []
    names = sorted(
        status.getPath().getName()
        for status in fs.listStatus(root)
        if status.getPath().getName().startswith("generation=")
    )
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    return [f"{path}/{n}" for n in names if fs.exists(jvm_path(f"{path}/{n}/stats/_SUCCESS"))]


def _drop_older(spark: SparkSession, path: str, keep: int) -> None:
    fs, _ = _file_system(spark, path)
    for old in _generations(spark, path)[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root
