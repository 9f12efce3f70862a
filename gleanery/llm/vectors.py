"""Tables of vectors: usable rows, rows of many vectors, and their meetings with batches of queries."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import MAX_PARTITIONS, stage

BATCH = 256  # queries that meet a block together
COPY = 64  # batches that share a copy of a block


def finite(vector: Column) -> Column:
    """Whether a vector is not null and wholly of finite numbers."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector.cast("array<double>"), good), F.lit(False))


def matrix(vectors: pa.ListArray, width: int = 0, kind: type = np.float64) -> np.ndarray:
    """One row per vector; shorter vectors are filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(sizes.max(initial=0)))
    if (sizes == width).all():
        return flat.astype(kind, copy=False).reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), kind)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def best_of_each(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of each group's ``k`` best, by score and then smaller id, and their places from 0."""
    order = np.lexsort((ids, -score, group))
    sorted_group = group[order]
    starts = np.flatnonzero(np.append(True, sorted_group[1:] != sorted_group[:-1])) if len(order) else order
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < k], place[place < k]


def gathered(rows: DataFrame, keys: list[str], columns: list[str], into: str) -> DataFrame:
    """One row per key with an array of the key's rows. Keys must be few enough for an array and spread by the caller."""
    return rows.groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias(into))


def blocks_of(rows: DataFrame, columns: list[str], count: int, size: int, label: str) -> tuple[DataFrame, int]:
    """Staged ``(block, rows)`` with about ``size`` rows each, dealt by ``row``, so that equal rows spread too; how many."""
    blocks = max(1, math.ceil(count / size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return stage(gathered(dealt.repartition(min(blocks, MAX_PARTITIONS), "block"), ["block"], columns, "rows"), label), blocks


def meetings(blocks: DataFrame, queries: DataFrame, key: str, columns: list[str], batch: int = BATCH) -> DataFrame:
    """Every block joined with the batches of queries that have its ``key``; a batch is an array ``asked`` of ``columns``.

    ``queries`` has ``query_id``, one row per query and key, and should be staged. There may be several blocks of a key, but
    there must be few keys: they are counted. A block is copied once per ``COPY`` batches, or more where tasks would be few.
    """
    spark = blocks.sparkSession
    sizes = queries.groupBy(key).agg(F.ceil(F.count("*") / F.lit(batch)).cast("int").alias("batches"))
    sizes = stage(sizes, "batches")
    keys, total = sizes.agg(F.count("*"), F.sum("batches")).first()
    cores = spark.sparkContext.defaultParallelism
    copies = F.greatest(F.ceil(F.col("batches") / F.lit(COPY)), F.least(F.col("batches"), F.lit(math.ceil(2 * cores / max(1, keys)))))
    sizes = F.broadcast(sizes.withColumn("copies", copies.cast("int")))
    parts = max(1, min(int(total or 0), MAX_PARTITIONS))
    dealt = queries.join(sizes, key).withColumn("batch", F.pmod(F.xxhash64("query_id"), F.col("batches")).cast("int"))
    dealt = dealt.withColumn("copy", F.col("batch") % F.col("copies")).repartition(parts, key, "copy")
    asked = gathered(dealt, [key, "copy", "batch"], columns, "asked")
    copied = blocks.join(sizes, key).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return copied.drop("batches", "copies").repartition(parts, key, "copy").join(asked.hint("merge"), [key, "copy"])
