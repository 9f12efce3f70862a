"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import stage

MAX_ROUNDS = 60


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    both = _both(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a").where(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``; a component is named by its least node.

    A node with very many links is no problem: least neighbours are combined before the exchange, and the
    join back can be split. Each round is written to the shared folder, so lineage stays short. Links with
    a null end are ignored; nodes without links do not appear.
    """
    links = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
        links = stage(_small_star(_large_star(links)), "links")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
