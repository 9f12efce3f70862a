"""Positions inside ordered groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import stage


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows per group with their ``rank``.

    Spark cuts every group to ``k`` rows before the exchange, so a huge group costs no task more
    than ``k`` rows per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def rank_all(df: DataFrame, keys: list[str], order: list[Column], partitions: int | None = None) -> DataFrame:
    """Every row with its ``rank`` in its group, without bringing a group into one task.

    Rows are range-distributed by group and order, which splits a large group over consecutive
    parts. A part then needs one number per group, the rows of the group in earlier parts. Only a
    group that began in an earlier part has a non-zero number, so there is at most one per part
    and the broadcast side has at most as many rows as there are parts.
    """
    by = [*[F.col(k) for k in keys], *order]
    ordered = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    staged = stage(ordered.withColumn("part", F.spark_partition_id()), "ranked")

    sizes = staged.groupBy(*keys, "part").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("before", F.sum("size").over(earlier)).filter(F.col("before") > 0)

    here = Window.partitionBy(*keys, "part").orderBy(*order)
    return (
        staged.withColumn("place", F.row_number().over(here))
        .join(F.broadcast(starts.drop("size")), [*keys, "part"], "left")
        .withColumn("rank", F.col("place") + F.coalesce("before", F.lit(0)))
        .drop("place", "before", "part")
    )
