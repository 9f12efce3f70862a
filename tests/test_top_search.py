"""Bounded search against ranking all pages, and how little of the postings it reads."""

import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import search, top_search as bounded
from gleanery.operators.top_search import top_search
from gleanery.sources.banded_index import BandedIndex, write_banded
from gleanery.sources.index_store import write_index

QUERIES = [(1, "common"), (2, "common often"), (3, "common rare7"), (4, "everywhere"), (5, "everywhere common often"), (6, "unknown often"),
           (7, ""), (8, "rare3 rare4"), (9, "tied"), (10, "unknown")]


def corpus(seed=1, n=240):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = 2 ** rng.randrange(1, 8)
        tokens = ["everywhere"] + rng.choices(["common", "often", "filler", f"rare{i % 40}"], [3, 2, 4, 1], k=size)
        rows.append((f"u{i:03d}", " ".join(tokens)))
    rows += [(f"t{i:02d}", "tied everywhere") for i in range(30)] + [("e1", ""), ("e2", None)]
    return rows


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("banded")
    pages = spark.createDataFrame(corpus(), "url string, content string")
    return write_index(pages, str(where / "plain")), write_banded(pages, str(where / "banded"), long=16)


def listed(found):
    return sorted((r.query_id, r.match_kind, r.rank, r.url, round(r.score, 9), tuple(r.tokens)) for r in found.collect())


@pytest.mark.parametrize("k", [1, 10])
def test_rows_equal_those_of_ranking_everything(spark, both, k):
    plain, banded = both
    asked = spark.createDataFrame(QUERIES, "query_id int, query string")
    assert listed(top_search(banded, asked, k, first=50)) == listed(search.top_results(search.ranked_search(plain, asked), k))


def test_too_many_tokens_for_a_plan(spark, both, monkeypatch):
    plain, banded = both
    asked = spark.createDataFrame(QUERIES, "query_id int, query string")
    monkeypatch.setattr(bounded, "MAX_QUERY_TERMS", 3)
    assert listed(top_search(banded, asked)) == listed(search.top_results(search.ranked_search(plain, asked)))


def test_bands_that_cannot_reach_the_bar_are_not_read(spark, both, monkeypatch):
    _, banded = both
    read, whole = [], banded.postings().filter("term in ('common', 'often')").count()
    plain_lookup = BandedIndex.lookup

    def counted(self, wanted):
        found = plain_lookup(self, wanted)
        read.append(found.count())
        return found

    monkeypatch.setattr(BandedIndex, "lookup", counted)
    for query, results, most in (("common", 2, 0.25), ("common often", 4, 1.0)):
        read.clear()
        asked = spark.createDataFrame([(1, query)], "query_id int, query string")
        assert top_search(banded, asked, 2, first=40).count() == results
        assert 0 < sum(read) <= most * whole, query


def test_an_index_of_nothing(spark, tmp_path):
    pages = spark.createDataFrame([("e1", ""), ("e2", None)], "url string, content string")
    banded = write_banded(pages, str(tmp_path / "empty"))
    assert top_search(banded, spark.createDataFrame([(1, "a b")], "query_id int, query string")).count() == 0
    assert banded.postings().count() == 0


def test_all_postings_of_a_page_lie_in_its_band(both):
    _, banded = both
    assert banded.postings().groupBy("url").agg(F.count_distinct("band").alias("n")).filter("n > 1").count() == 0
    most = {(r.term, r.band): r.most for r in banded.maxima(["common", "everywhere", "rare1"]).collect()}
    assert {t for t, _ in most} == {"common", "everywhere"}
    found = banded.postings().filter("term = 'common'").groupBy("band").agg(F.max("tfidf").alias("m")).collect()
    assert {("common", r.band): r.m for r in found} == {key: v for key, v in most.items() if key[0] == "common"}
