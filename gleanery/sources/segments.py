"""Tables that grow by segments: folders that are written once, become visible as a whole and are merged.

A segment brings rows of a new version and a list of the (url, version) that it ends. Its statistics are written last and
make it visible; a merged segment names those that it replaces.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.sources.index_store import _file_system

FACTS = "docs bigint, postings bigint, dead bigint, dead_bytes bigint, shards int, versions array<bigint>, replaces array<bigint>"


@dataclass(frozen=True)
class Segment:
    """What a committed segment says of itself; ``docs`` is by how many pages it changes the index."""

    number: int
    docs: int
    postings: int
    dead: int
    dead_bytes: int
    shards: int
    versions: tuple[int, ...]
    replaces: tuple[int, ...]


def folder(path: str, what: str, number: int) -> str:
    return f"{path}/{what}/segment={number:012d}"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Complete segments: their statistics are written last."""
    fs, root = _file_system(spark, f"{path}/stats")
    if not fs.exists(root):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("segment="))
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    return [int(n.split("=")[1]) for n in names if fs.exists(as_path(f"{path}/stats/{n}/_SUCCESS"))]


def committed(spark: SparkSession, path: str) -> list[Segment]:
    found_numbers = numbers(spark, path)
    if not found_numbers:
        return []
    read = spark.read.option("basePath", f"{path}/stats").parquet(*[folder(path, "stats", n) for n in found_numbers])
    facts = [row.asDict() for row in read.withColumnRenamed("segment", "number").collect()]
    found = [Segment(**f | {"versions": tuple(f["versions"]), "replaces": tuple(f["replaces"])}) for f in facts]
    return sorted(found, key=lambda s: s.number)


def current(spark: SparkSession, path: str) -> tuple[Segment, ...]:
    """The segments that make up the table now."""
    segments = committed(spark, path)
    gone = {n for s in segments for n in s.replaces}
    return tuple(s for s in segments if s.number not in gone)


def next_number(spark: SparkSession, path: str) -> int:
    return 1 + max((s.number for s in committed(spark, path)), default=0)


def commit(spark: SparkSession, path: str, segment: Segment) -> None:
    values = [segment.docs, segment.postings, segment.dead, segment.dead_bytes, segment.shards, list(segment.versions), list(segment.replaces)]
    spark.createDataFrame([values], FACTS).coalesce(1).write.mode("overwrite").parquet(folder(path, "stats", segment.number))


def list_size(urls: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a list of URLs with a number beside each."""
    rows, size = urls.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("url") + 8), F.lit(0))).first()
    return int(rows), int(size)


def like_segments(segments: tuple[Segment, ...], fan: int) -> list[Segment]:
    """At least ``fan`` segments of like size, the smallest there are, or none."""
    tiers: dict[int, list[Segment]] = defaultdict(list)
    for segment in segments:
        tiers[int(math.log(max(1, segment.postings), fan))].append(segment)
    return next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= fan), [])


def sweep(spark: SparkSession, path: str, tables: tuple[str, ...]) -> None:
    """Remove segments that an earlier merge has replaced; ``tables`` are the folders beside their statistics."""
    fs, _ = _file_system(spark, path)
    kept = {s.number for s in current(spark, path)}
    for number in set(numbers(spark, path)) - kept:
        for what in ("stats", *tables):
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder(path, what, number)), True)
