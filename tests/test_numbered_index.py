"""The compact index against the plain one: the same postings in fewer bytes."""

from pathlib import Path

import pytest

from gleanery.operators import search
from gleanery.sources.index_store import write_index
from gleanery.sources.numbered_index import write_numbered
from gleanery.sources.tables import read_documents

SF = "/root/testdata/sf0.001"


def listed(postings):
    return sorted((r.term, r.url, r.tf, r.df, round(r.tfidf, 9)) for r in postings.collect())


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    where, docs = tmp_path_factory.mktemp("numbered"), read_documents(spark, f"{SF}/documents.parquet")
    return write_index(docs, str(where / "plain")), write_numbered(docs, str(where / "numbered"), span=64)


def size(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))


def test_bytes_are_at_most_half(spark, tmp_path):
    docs = read_documents(spark, "/root/testdata/sf0.01/documents.parquet")
    plain, numbered = write_index(docs, str(tmp_path / "plain")), write_numbered(docs, str(tmp_path / "numbered"))
    assert 2 * (size(f"{numbered.path}/blocks") + size(f"{numbered.path}/documents")) <= size(f"{plain.path}/postings")


def test_postings_are_the_same(both):
    plain, numbered = both
    assert listed(numbered.postings()) == listed(plain.postings())
    assert numbered.stats["docs_count"] == plain.stats["docs_count"] and numbered.stats["terms_count"] == plain.stats["terms_count"]


def test_numbers_are_dense_and_in_order_and_blocks_bounded(both):
    _, numbered = both
    rows = sorted((r.number, r.url, r.block) for r in numbered.documents().collect())
    assert [n for n, _, _ in rows] == list(range(len(rows))) and [u for _, u, _ in rows] == sorted(u for _, u, _ in rows)
    assert all(b == n // 64 for n, _, b in rows)
    for r in numbered.blocks().collect():
        assert len(r.places) == len(r.counts) <= 64 and list(r.places) == sorted(set(r.places)) and r.places[-1] < 64


def test_searches_read_few_shards_and_equal_those_of_the_plain_index(spark, both):
    plain, numbered = both
    asked = spark.createDataFrame([(1, "the la"), (2, "nothing-of-the-kind"), (3, "")], "query_id int, query string")
    rows = lambda found: sorted((r.query_id, r.match_kind, r.url, round(r.score, 9), r.tokens) for r in found.collect())
    assert rows(search.ranked_search(numbered, asked)) == rows(search.ranked_search(plain, asked))
    hits = numbered.lookup(numbered.placed(spark.createDataFrame([("the",)], "term string")).collect())
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,the)" in plan and "PartitionFilters: [isnotnull(shard" in plan


def test_odd_pages(spark, tmp_path):
    rows = [("b", "x x y"), ("a", None), ("c", ""), ("d", "x")]
    numbered = write_numbered(spark.createDataFrame(rows, "url string, content string"), str(tmp_path / "odd"), span=1)
    assert [(t, u, n, d) for t, u, n, d, _ in listed(numbered.postings())] == [("x", "b", 2, 2), ("x", "d", 1, 2), ("y", "b", 1, 1)]
    empty = write_numbered(spark.createDataFrame([], "url string, content string"), str(tmp_path / "none"))
    assert empty.postings().count() == 0 and empty.stats["docs_count"] == 0
