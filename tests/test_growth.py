"""Steps whose work must not grow faster than their input: what they put into an exchange, a join or a pattern."""

from pyspark.sql import functions as F

from gleanery.functions.urls import PLAIN_PATH, canonical, resolved, url_parts, with_scheme
from gleanery.functions import html
from gleanery.operators import crawl, pages, words
from gleanery.sources import incremental
from gleanery.sources.index_store import any_of

HREFS = [
    "/a", "/a/", "/a/b.html#top", "/a//b", "/./a", "/../a", "/a/..", "/a/.hidden", "/a;x", "/a?b=c", "/a#x?y", "//other/a", "a/b", "",
    "/", "#top", "/a:b", "http://x.org/A/", "/A-_1.2/B", "/a b", "/a%20b", "mailto:x", "/a/b//",
]
BASES = ["http://Shop.Example.com/x/y", "HTTPS://u@Host:80", "shop.example.com/q", "ftp://host/a", "http:///none", "http://[bad/x", "httpx:a", "http://h.org?q=1"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plain_links_are_read_as_all_others(spark):
    rows = spark.createDataFrame([(b, h) for b in BASES for h in HREFS], "url string, href string")
    anchors = rows.withColumn("html", F.concat(F.lit('<a href="'), "href", F.lit('">t</a>')))
    page = with_scheme(F.col("url"))
    slow = anchors.select("url", "href", canonical(resolved(page, F.col("href"), url_parts(page))).alias("dst"))
    quick = anchors.select("url", "href", F.get(pages.link_targets(), F.lit(0)).alias("dst"))
    assert sorted(map(str, quick.collect())) == sorted(map(str, slow.collect()))
    assert [h for h in HREFS if spark.range(1).select(F.lit(h).rlike(PLAIN_PATH)).first()[0]] == ["/a", "/a/", "/a/b.html#top", "/A-_1.2/B"]


def test_url_of_a_page_is_made_once_not_for_each_link(spark):
    found = spark.createDataFrame([("http://a.org/x/", '<a href="/y">y</a><a href="z">z</a>'), ("http://[bad/x", '<a href="/y">')], "url string, html string")
    links = crawl.link_table(found)
    assert "regexp" not in plan(links).split("Generate")[0]
    assert sorted(tuple(r) for r in links.collect()) == [("http://a.org/x", "http://a.org/x/z"), ("http://a.org/x", "http://a.org/y")]


def test_plain_tags_are_read_as_all_others(spark):
    tags = ['<a href="/x">', '<A href="">', '<a href="/x" >', "<a href='/x'>", '<a href="/x"/>', '<a  href="/x">', '<a href="/x&amp;y">', '<a name="b" href="c">']
    rows = spark.createDataFrame([(t,) for t in tags], "tag string")
    for row in rows.select("tag", html.hrefs(F.col("tag")).alias("got"), html.attribute(F.col("tag"), "href").alias("want")).collect():
        assert row["got"] == [row["want"]], row["tag"]


def test_many_terms_are_no_chain_of_comparisons(spark):
    few, many = ([f"t{i}" for i in range(n)] for n in (3, 200))
    rows = spark.createDataFrame([("t7",), ("u",)], "term string")
    assert plan(rows.filter(any_of("term", few))).count(" = t") + plan(rows.filter(any_of("term", few))).count(" IN ") > 0
    assert " OR " not in plan(rows.filter(any_of("term", many)))
    assert [r["term"] for r in rows.filter(any_of("term", many)).collect()] == ["t7"]


def test_words_of_single_rows_are_in_no_exchange(spark):
    single = spark.createDataFrame([("a", "x y x"), ("b", "y")], "doc_id string, text string")
    assert "Aggregate" not in plan(words._distinct_pairs(single))
    lines = spark.createDataFrame([("a", "x y"), ("a", "y z"), (None, "x"), (None, "x"), ("b", "y")], "doc_id string, text string")
    got = sorted((r["doc_id"] or "", r["word"]) for r in words._distinct_pairs(lines).collect())
    assert got == [("", "x"), ("a", "x"), ("a", "y"), ("a", "z"), ("b", "y")]


def test_only_versions_with_ended_pages_meet_a_long_list(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "MAX_BROADCAST_DEAD", 0)
    versions = lambda *rows: spark.createDataFrame(rows, "url string, content string, last_scraped timestamp_ntz").withColumn(
        "last_scraped", F.col("last_scraped").cast("timestamp"))
    from datetime import datetime
    path = str(tmp_path / "index")
    incremental.refresh(versions(("a", "one two", datetime(2024, 1, 1)), ("b", "two", datetime(2024, 1, 1))), path)
    index = incremental.refresh(versions(("a", "three two", datetime(2024, 1, 2))), path)
    assert index._ended == [1]
    assert "LeftAnti" in plan(index.counts()) and "Union" in plan(index.counts())
    got = sorted((r["term"], r["url"], r["df"]) for r in index.postings().collect())
    assert got == [("three", "a", 1), ("two", "a", 2), ("two", "b", 2)]
    merged = incremental.refresh(versions(("c", "two", datetime(2024, 1, 3))), path, fan=2)
    again = sorted((r["term"], r["url"], r["df"]) for r in merged.postings().collect())
    assert again == [("three", "a", 1), ("two", "a", 3), ("two", "b", 3), ("two", "c", 3)]
