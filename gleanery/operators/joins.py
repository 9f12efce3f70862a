"""Join of many rows with a one-row-per-key lookup table, safe for very frequent keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def lookup_size(lookup: DataFrame, key: str, weight: str) -> Row:
    """``(keys, bytes, rows)``: keys of a lookup, their bytes, and the rows that will meet them."""
    return lookup.agg(
        F.count("*").alias("keys"),
        F.coalesce(F.sum(F.octet_length(key)), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(weight), F.lit(0)).alias("rows"),
    ).first()


def split_lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    size: Row | None = None,
) -> list[DataFrame]:
    """Inner join of ``rows`` with ``lookup`` on ``key``, as one or two disjoint parts.

    ``lookup`` holds one row per key and, in ``weight``, how many of ``rows`` have that key.
    A lookup of checked small size is broadcast. A larger one is cut in two: keys with more than
    ``total / max_rows`` rows, and more than ``total / max_bytes`` for each of their own bytes, are at most
    ``max_rows`` many and ``max_bytes`` long together. That part can be broadcast and its rows stay where
    they are; the remaining keys have few rows for their length and are joined by a shuffle.
    ``rows`` is read twice in that case and should be a table. ``size`` may be given where it is known.
    """
    size = size or lookup_size(lookup, key, weight)
    if size["keys"] <= max_rows and size["bytes"] <= max_bytes:
        return [rows.join(F.broadcast(lookup), key)]
    is_long = F.octet_length(key) > F.col(weight).cast("double") * (max_bytes / max(1, size["rows"]))
    is_heavy = (F.col(weight) >= F.lit(max(1, size["rows"] // max_rows) + 1)) & ~is_long
    heavy = lookup.filter(is_heavy)
    light = lookup.filter(~is_heavy)
    return [
        rows.join(F.broadcast(heavy), key),
        rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key),
    ]


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, weight: str, **limits) -> DataFrame:
    """The parts of :func:`split_lookup_join` as one table."""
    return union_all(split_lookup_join(rows, lookup, key, weight, **limits))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
