"""Crawl frontier on tables: admission, new URLs, crawl steps, dispatch order, recency, page store.

The queue log has rows ``(ts, seq, url, kind)`` with kind ``enqueue``, ``dispatch`` or ``complete``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.urls import AllowRule, allowed
from gleanery.session import stage

REJECTED, SEEN, ADDED = 0, -1, 1
RESCRAPE_SECONDS = 3600
REQUEUE_SECONDS = 30
EXPORT_ROWS = 1000


def admit_urls(urls: DataFrame, rule: AllowRule) -> DataFrame:
    """``(url, admitted)``."""
    return urls.select("url", allowed(F.col("url"), rule).alias("admitted"))


def offer_urls(offers: DataFrame, seen: DataFrame, rule: AllowRule) -> DataFrame:
    """``(url, status, offers)`` per distinct offered URL.

    ``status`` is the outcome of the first offer: rejected by the rule, seen before, or added; every
    further offer of an added URL finds it seen. Offers and seen URLs meet in one aggregation, which
    combines before its exchange, so a URL offered very often is no hot key.
    """
    both = offers.select("url", F.lit(1).alias("offered"), F.lit(0).alias("known")).unionByName(
        seen.select("url", F.lit(0).alias("offered"), F.lit(1).alias("known"))
    )
    counted = both.groupBy("url").agg(
        F.sum("offered").alias("offers"), F.max("known").alias("known")
    ).filter(F.col("offers") > 0)
    status = (
        F.when(~allowed(F.col("url"), rule), REJECTED).when(F.col("known") == 1, SEEN).otherwise(ADDED)
    )
    return counted.select("url", status.alias("status"), "offers")


def new_urls(offered: DataFrame) -> DataFrame:
    return offered.filter(F.col("status") == ADDED).select("url")


def queue_state(log: DataFrame) -> DataFrame:
    """``(url, state, since)``: the last event of every URL."""
    last = F.max(F.struct("ts", "seq", "kind"))
    return log.groupBy("url").agg(last.alias("last")).select(
        "url", F.col("last.kind").alias("state"), F.col("last.ts").alias("since")
    )


def next_batch(queued: DataFrame, k: int, newest_first: bool = True) -> DataFrame:
    """The next ``k`` URLs of ``(url, enqueued_at)``.

    Crawl workers take the newest first; the URL export takes the oldest first.
    """
    order = F.desc("enqueued_at") if newest_first else F.asc("enqueued_at")
    return queued.orderBy(order, "url").limit(k)


def recency_gate(
    urls: DataFrame, pages: DataFrame, as_of: datetime | Column, seconds: int = RESCRAPE_SECONDS
) -> DataFrame:
    """``(url, last_scraped)`` of the URLs to scrape: never scraped, or at least ``seconds`` ago."""
    due = F.lit(as_of) - F.expr(f"interval {seconds} seconds")
    return (
        urls.select("url")
        .join(pages.select("url", "last_scraped"), "url", "left")
        .filter(F.col("last_scraped").isNull() | (F.col("last_scraped") <= due))
    )


def requeue_inflight(log: DataFrame, as_of: datetime | Column, seconds: int = REQUEUE_SECONDS) -> DataFrame:
    """``(url, dispatched_at)`` of URLs dispatched, not completed since, and waiting ``seconds`` or more.

    A page counts as completed under its own URL.
    """
    def last(kind: str):
        return F.max(F.when(F.col("kind") == kind, F.struct("ts", "seq")))

    due = F.lit(as_of) - F.expr(f"interval {seconds} seconds")
    return (
        log.filter(F.col("kind").isin("dispatch", "complete"))
        .groupBy("url")
        .agg(last("dispatch").alias("sent"), last("complete").alias("done"))
        .filter(F.col("done").isNull() | (F.col("done") < F.col("sent")))
        .filter(F.col("sent.ts") <= due)
        .select("url", F.col("sent.ts").alias("dispatched_at"))
    )


def latest_pages(versions: DataFrame) -> DataFrame:
    """One row ``(url, content, last_scraped)`` per URL, the last written; empty content is no version."""
    stored = versions.filter(F.coalesce(F.col("content"), F.lit("")) != "")
    last = F.max(F.struct("last_scraped", "content"))
    return stored.groupBy("url").agg(last.alias("last")).select("url", "last.content", "last.last_scraped")


def upsert_pages(store: DataFrame, batch: DataFrame) -> DataFrame:
    """``store`` with ``batch`` written over it; ``store`` has one row per URL.

    Only the batch is aggregated. Stored rows are kept by a join with the URLs and times of the
    batch, so their content passes through untouched.
    """
    fresh = stage(latest_pages(batch), "fresh-pages")
    times = fresh.select("url", F.col("last_scraped").alias("_new"))
    old_times = store.select("url", F.col("last_scraped").alias("_old"))
    kept = (
        store.join(times, "url", "left")
        .filter(F.col("_new").isNull() | (F.col("_new") < F.col("last_scraped")))
        .select("url", "content", "last_scraped")
    )
    written = (
        fresh.join(old_times, "url", "left")
        .filter(F.col("_old").isNull() | (F.col("_old") <= F.col("last_scraped")))
        .select("url", "content", "last_scraped")
    )
    return kept.unionByName(written)


def export_urls(queued: DataFrame, n: int = EXPORT_ROWS) -> DataFrame:
    """Text lines of the first ``n`` URLs, oldest first."""
    return next_batch(queued, n, newest_first=False).select("url")
