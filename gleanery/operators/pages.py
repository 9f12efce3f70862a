"""Jobs on raw pages: links and readable text."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.html import hrefs, page_text
from gleanery.functions.urls import PLAIN_PATH, canonical, let, resolved, site_root, url_parts, with_scheme


@cache
def link_targets() -> Column:
    """Canonical targets of all links of a page, NULL for a malformed one.

    The expressions on ``url`` and ``html`` are large, so each is put together once per process. A plain path from the root
    of the page's site is its own canonical form behind that of the site.
    """
    def target(page: Column, parts: Column, site: Column, href: Column) -> Column:
        plain = site.isNotNull() & href.rlike(PLAIN_PATH)
        return F.when(plain, F.concat(site, F.regexp_extract(href, PLAIN_PATH, 1))).otherwise(canonical(resolved(page, href, parts)))

    return let(with_scheme(F.col("url")), lambda page: let(url_parts(page), lambda parts: let(site_root(parts), lambda site: F.transform(
        hrefs(F.col("html")), lambda href: target(page, parts, site, href)
    ))))


@cache
def readable_text() -> Column:
    return page_text(F.col("html"))


def extract_links(pages: DataFrame, *keep: str) -> DataFrame:
    """``(src, dst)``: the distinct canonical targets of each page, with the columns ``keep`` of it.

    Everything happens inside the row of a page, so the job has no exchange.
    """
    targets = F.array_distinct(
        F.filter(link_targets(), lambda target: target.isNotNull())
    )
    return pages.select(*keep, F.col("url").alias("src"), F.explode(targets).alias("dst"))


def dropped_links(pages: DataFrame) -> DataFrame:
    """One row ``(links, dropped)``: link occurrences, and how many had a malformed address."""
    targets = link_targets()
    counts = pages.select(let(targets, lambda found: F.struct(
        F.size(found).alias("links"), F.size(F.filter(found, lambda t: t.isNull())).alias("dropped")
    )).alias("n"))
    return counts.agg(F.sum("n.links").alias("links"), F.sum("n.dropped").alias("dropped"))


def extract_content(pages: DataFrame) -> DataFrame:
    """``(url, content)``: the readable text of each page."""
    return pages.select("url", readable_text().alias("content"))


def normalise_urls(urls: DataFrame) -> DataFrame:
    """``(url, canonical)`` with a scheme added where it is missing."""
    return urls.select("url", canonical(with_scheme(F.col("url"))).alias("canonical"))
