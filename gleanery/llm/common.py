"""Small helpers of several operators: staged tables, checked broadcasts and places in a long row."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gleanery.session import short_batches, stage  # noqa: F401

WORD = "[^\\x20\\x09-\\x0D]+"
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def staged_count(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` to the shared folder; the rows are then counted from the files' footers."""
    kept = stage(df, label)
    return kept, kept.count()


def small_enough(staged: DataFrame, rows: int, row_bytes: int) -> bool:
    """Whether a staged table may be broadcast; beyond the limits the join is left to a shuffle."""
    return rows <= BROADCAST_ROWS and rows * row_bytes <= BROADCAST_BYTES


def checked(staged: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    return F.broadcast(staged) if small_enough(staged, rows, row_bytes) else staged


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may learn; a row without id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def placed(df: DataFrame, group: list[str], order: list[str], width: str, rows: int, into: str = "before") -> DataFrame:
    """Add the sum of ``width`` over the rows of the same group that come earlier.

    A group is dealt to about sqrt(rows) chunks by a hash of its order, so one group of any size is no
    single task: sums run inside a chunk, and over the few totals of a group's chunks. Group columns must
    not be null; rows equal in ``order`` are interchangeable.
    """
    chunks = max(1, math.isqrt(rows) // 2)
    dealt = df.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    keys = [*group, "_chunk"]
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*keys).agg(F.sum(width).alias("_total"))
    totals = totals.select(*keys, F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_base"))
    inside = dealt.withColumn("_own", F.coalesce(F.sum(width).over(inner), F.lit(0)))
    joined = inside.join(totals, keys)
    return joined.select(*df.columns, (F.col("_base") + F.col("_own")).cast("long").alias(into))


def only(df: DataFrame, **types: str) -> DataFrame:
    """Just these columns, cast; a table may hold others, with any names."""
    return df.select(*[df[c].cast(t).alias(c) for c, t in types.items()])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it if the table has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fields(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
