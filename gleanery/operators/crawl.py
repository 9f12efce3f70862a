"""A crawl over stored pages, level by level, and the stored frontier of a crawl that goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.urls import AllowRule, allowed, canonical, with_scheme
from gleanery.operators.frontier import new_urls, offer_urls
from gleanery.operators.joins import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS
from gleanery.operators.pages import extract_links
from gleanery.session import removes_stages, stage
from gleanery.sources.index_store import _file_system


def link_table(pages: DataFrame) -> DataFrame:
    """``(src, dst)`` with both ends canonical, from pages ``(url, html)``; no page is exchanged.

    The canonical URL of a page is put beside it before its links become rows, so it is not made again for each link.
    """
    keyed = pages.select("url", "html", canonical(with_scheme(F.col("url"))).alias("key"))
    return extract_links(keyed, "key").filter("key is not null").select(F.col("key").alias("src"), "dst")


def links_of(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """``(src, dst)`` of the stored pages in ``frontier (url)``.

    Pages are matched by their URLs alone. If the matches are few their HTML is read in place; otherwise the links of all
    pages are extracted in place, and only links go through a join. HTML is in no exchange.
    """
    key = canonical(with_scheme(F.col("url")))
    matched = pages.select("url", key.alias("key")).join(frontier.select(F.col("url").alias("key")).distinct(), "key", "left_semi")
    matched = stage(matched.select("url").distinct(), "matched-urls")
    size = matched.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("url")), F.lit(0))).first()
    if size[0] <= MAX_BROADCAST_ROWS and size[1] <= MAX_BROADCAST_BYTES:
        return link_table(pages.join(F.broadcast(matched), "url", "left_semi"))
    return link_table(pages).join(frontier.select(F.col("url").alias("src")).distinct(), "src", "left_semi")


def frontier_step(frontier: DataFrame, pages: DataFrame, seen: DataFrame, rule: AllowRule) -> DataFrame:
    """``(url, status, offers)`` for the links of the stored pages that are in the frontier."""
    return offer_urls(links_of(frontier, pages).select(F.col("dst").alias("url")), seen, rule)


def crawl(pages: DataFrame, seeds: DataFrame, rule: AllowRule, most: int | None = None) -> DataFrame:
    """``(url, level)``: every URL that a crawl from ``seeds (url)`` takes, with the number of links to it.

    URLs that ``rule`` rejects are left out; of pages that are not stored nothing is followed. With ``most`` the crawl ends
    after the level in which it has taken that many. The links are extracted once; a level is staged, and costs a join of the
    links with the URLs of the last level and a distinct of what it leads to.
    """
    links = stage(link_table(pages), "links")
    start = seeds.select(canonical(with_scheme(F.col("url"))).alias("url")).filter("url is not null").distinct()
    level = stage(start.filter(allowed(F.col("url"), rule)).withColumn("level", F.lit(0)), "level")
    taken, number, total = level, 0, level.count()
    while total and (most is None or total < most):
        number += 1
        offers = links.join(level.select(F.col("url").alias("src")), "src").select(F.col("dst").alias("url"))
        found = new_urls(offer_urls(offers, taken.select("url"), rule)).withColumn("level", F.lit(number))
        level = stage(found, "level")
        added = level.count()
        if not added:
            break
        taken, total = taken.unionByName(level), total + added
    return taken


def first_taken(taken: DataFrame, n: int) -> DataFrame:
    """``(url)`` of the first ``n`` URLs of a crawl: level by level, by URL inside a level."""
    return taken.orderBy("level", "url").limit(n).select("url")


def read_frontier(spark: SparkSession, path: str) -> DataFrame:
    """``(url, batch)`` of all URLs that a stored frontier has ever taken; empty if there is none."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return spark.createDataFrame([], "url string, batch int")
    return spark.read.schema("url string, batch int").parquet(path)


@removes_stages
def advance_frontier(offers: DataFrame, path: str, batch: int, rule: AllowRule) -> DataFrame:
    """Write the URLs of ``offers (url)`` that are admitted and not yet seen as batch ``batch`` of the frontier at ``path``.

    The stored URLs with the new ones are the seen set of the next batch. A batch that is run again is compared with the earlier
    ones and replaces its own rows only, so nothing is lost or taken twice. Returns the new URLs.
    """
    spark = offers.sparkSession
    seen = read_frontier(spark, path).filter(F.col("batch") < batch).select("url")
    found = stage(new_urls(offer_urls(offers, seen, rule)), "new-urls")
    found.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return spark.read.schema("url string").parquet(f"{path}/batch={batch}")
