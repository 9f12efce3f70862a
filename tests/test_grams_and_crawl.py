"""Entry search by trigrams against a look at every posting; crawls over small webs."""

import pytest
from pyspark.sql import functions as F

from gleanery.functions.urls import AllowRule
from gleanery.operators import crawl, search
from gleanery.sources import gram_index
from gleanery.sources.gram_index import GramIndex, grams, write_grams
from gleanery.sources.index_store import read_index, write_index

PAGES = [("http://a.org/cable", "tables and cables"), ("http://a.org/x", "able"), ("http://b.org/y", "nothing here, tab"), ("http://c.org/z", "ab"), ("http://d.org/", "")]
RULE = AllowRule(domain="s.org", path_prefix="/")


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("grams") / "index")
    write_index(spark.createDataFrame([*PAGES, *[(f"http://e.org/{n}", f"word{n} able") for n in range(30)]], "url string, content string"), path, shards=2)
    index = read_index(spark, path)
    return index, write_grams(index)


def entries(found):
    return sorted((r.term, r.url, r.tf, r.df, round(r.tfidf, 9)) for r in found.collect())


NEEDLES = ["able", "ables", "org/c", "http://", "tab", "x", "ab", "", "word1", "e.org/7", "missing", "%_", "wor"]


@pytest.mark.parametrize("limit", [None, 0])
def test_grep_by_grams_equals_a_look_at_all_entries(indexed, monkeypatch, limit):
    index, by_gram = indexed
    if limit is not None:
        monkeypatch.setattr(gram_index, "MAX_QUERY_TERMS", limit)
        monkeypatch.setattr(gram_index, "MAX_BROADCAST_ROWS", limit)
    for needle in NEEDLES if limit is None else ("able", "org/c"):
        assert entries(by_gram.grep(needle)) == entries(search.grep_index(index.postings(), needle)), needle


def test_grep_reads_only_the_rarest_gram_and_the_terms_found(indexed):
    index, _ = indexed
    by_gram = GramIndex(read_index(index.spark, index.path.rsplit("/", 1)[0]))
    terms, _ = by_gram._holders("cables")
    plan = terms._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gram,cab)" in plan or "EqualTo(gram,les)" in plan or "EqualTo(gram,bles)" in plan
    found = by_gram.grep("cables")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,cables)" in plan and "PartitionFilters: [isnotnull(shard" in plan.replace("shard#", "shard")


@pytest.mark.parametrize("text, wanted", [("abcab", ["abc", "bca", "cab"]), ("ab", []), ("", []), (None, []), ("aaaa", ["aaa"]), ("é日x", ["é日x"])])
def test_grams(spark, text, wanted):
    row = spark.createDataFrame([(text,)], "t string").select(grams(F.col("t")).alias("g")).first()
    assert sorted(row["g"] or []) == wanted


def web(spark):
    link = lambda *to: "".join(f'<a href="{t}">x</a>' for t in to)
    rows = [
        ("http://s.org/0", link("/1", "/2", "/2", "http://t.org/9", "/1#top")), ("http://s.org/1", link("/3", "/0")), ("http://s.org/2", link("/3", "/4")),
        ("http://s.org/3", link("/5")), ("http://s.org/5", link("/0", "/6")), ("http://s.org/7", link("/8")), ("http://s.org/4", None), (None, link("/1")),
    ]
    return spark.createDataFrame(rows, "url string, html string")


def seeds(spark, *found):
    return spark.createDataFrame([(u,) for u in found], "url string")


def test_a_crawl_takes_every_reachable_url_at_its_least_level(spark):
    found = crawl.crawl(web(spark), seeds(spark, "s.org/0", "http://s.org/0#x", "http://t.org/1", None), RULE)
    levels = {r.url.rsplit("/", 1)[1]: r.level for r in found.collect()}
    assert levels == {"0": 0, "1": 1, "2": 1, "3": 2, "4": 2, "5": 3, "6": 4} and found.count() == 7
    assert [r.url[-1] for r in crawl.first_taken(found, 4).collect()] == ["0", "1", "2", "3"]
    assert crawl.crawl(web(spark), seeds(spark, "http://s.org/0"), RULE, most=2).count() == 3
    assert crawl.crawl(web(spark), seeds(spark), RULE).count() == 0
    assert {r.url for r in crawl.crawl(web(spark).limit(0), seeds(spark, "http://s.org/0"), RULE).collect()} == {"http://s.org/0"}


def test_links_of_a_frontier_without_html_in_an_exchange(spark, monkeypatch):
    rows = lambda found: sorted((r.src[-1], r.dst[-1]) for r in found.collect())
    few = crawl.links_of(seeds(spark, "http://s.org/1", "http://s.org/3", "http://s.org/1"), web(spark))
    monkeypatch.setattr(crawl, "MAX_BROADCAST_ROWS", 0)
    many = crawl.links_of(seeds(spark, "http://s.org/1", "http://s.org/3"), web(spark))
    assert rows(few) == rows(many) == [("1", "0"), ("1", "3"), ("3", "5")]
    exchanges = [line for line in many._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]
    assert exchanges and not any("html" in line for line in exchanges)


def test_a_stored_frontier_advances_and_a_batch_may_run_again(spark, tmp_path):
    path, listed = str(tmp_path / "frontier"), lambda found: sorted(r.url[-1] for r in found.collect())
    assert crawl.read_frontier(spark, path).count() == 0
    first = crawl.advance_frontier(seeds(spark, "http://s.org/1", "http://s.org/1", "http://t.org/1"), path, 0, RULE)
    assert listed(first) == ["1"]
    for _ in range(2):
        assert listed(crawl.advance_frontier(seeds(spark, "http://s.org/1", "http://s.org/2"), path, 1, RULE)) == ["2"]
        assert sorted((r.url[-1], r.batch) for r in crawl.read_frontier(spark, path).collect()) == [("1", 0), ("2", 1)]
