"""The growing index against a full rebuild, and what a refresh reads and writes."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gleanery.operators import search
from gleanery.sources import incremental
from gleanery.sources.incremental import read_incremental, refresh
from gleanery.sources.index_store import write_index


def pages(spark, *rows):
    shown = [(u, c, f"2024-01-01 00:{at:02d}:00") for u, c, at in rows]
    found = spark.createDataFrame(shown, "url string, content string, at string")
    return found.select("url", "content", F.col("at").cast("timestamp").alias("last_scraped"))


def urls(spark, *found):
    return spark.createDataFrame([(u,) for u in found], "url string")


def listed(postings):
    return sorted((r.term, r.url, r.tf, r.df, round(r.tfidf, 9)) for r in postings.collect())


def rebuilt(spark, tmp_path, store):
    found = spark.createDataFrame(list(store.items()), "url string, content string")
    return listed(write_index(found, str(tmp_path / f"full-{random.random()}")).postings().select("term", "url", "tf", "df", "tfidf"))


def test_many_refreshes_equal_a_rebuild(spark, tmp_path):
    rng, store, at = random.Random(3), {}, 0
    path = str(tmp_path / "segments")
    for number in range(4):
        at += 1
        batch = {f"u{rng.randrange(12)}": " ".join(rng.choices("abcdefg", k=rng.randrange(1, 9))) for _ in range(5)}
        gone = [u for u in rng.sample(sorted(store), min(2, len(store))) if u not in batch]
        index = refresh(pages(spark, *[(u, c, at) for u, c in batch.items()]), path, urls(spark, *gone, "never-seen", *batch), fan=2 + number % 2)
        store = {u: c for u, c in store.items() if u not in gone} | batch
        assert listed(index.postings()) == rebuilt(spark, tmp_path, store)
        assert index.stats["docs_count"] == len(store)
    assert listed(read_incremental(spark, path).postings()) == rebuilt(spark, tmp_path, store)
    question = spark.createDataFrame([(1, "a c"), (2, "g zz"), (3, "")], "query_id int, query string")
    full = write_index(spark.createDataFrame(list(store.items()), "url string, content string"), str(tmp_path / "all"))
    rows = lambda found: sorted((r.query_id, r.match_kind, r.url, round(r.score, 9), r.tokens) for r in found.collect())
    assert rows(search.ranked_search(index, question)) == rows(search.ranked_search(full, question))


def test_large_batches_of_queries_join_all_postings(spark, tmp_path, monkeypatch):
    index = refresh(pages(spark, ("u1", "a b", 1), ("u2", "a", 1)), str(tmp_path / "s"))
    index = refresh(pages(spark, ("u1", "b c", 2)), str(tmp_path / "s"))
    monkeypatch.setattr(search, "MAX_QUERY_TERMS", 0)
    found = search.ranked_search(index, spark.createDataFrame([(1, "a b")], "query_id int, query string"))
    assert sorted((r.url, r.match_kind) for r in found.collect()) == [("u1", "partial"), ("u2", "partial")]


def test_odd_refreshes(spark, tmp_path):
    path = str(tmp_path / "segments")
    assert read_incremental(spark, path).docs == 0 and read_incremental(spark, path).postings().count() == 0
    assert refresh(pages(spark), path).docs == 0
    index = refresh(pages(spark, ("u1", "a", 5), ("u1", "b", 6), ("u2", None, 6), ("u3", "", 6), ("u4", "--", 6)), path)
    assert [(r.term, r.url) for r in index.postings().collect()] == [("b", "u1")] and index.docs == 2
    # An older version loses, one scraped at the same time wins.
    assert listed(refresh(pages(spark, ("u1", "old", 5)), path).postings()) == listed(index.postings())
    index = refresh(pages(spark, ("u1", "same", 6)), path)
    assert [r.term for r in index.postings().collect()] == ["same"] and index.docs == 2
    # Removed and scraped in one refresh: written, however old.
    index = refresh(pages(spark, ("u1", "again", 1)), path, urls(spark, "u1", "u4", None))
    assert [r.term for r in index.postings().collect()] == ["again"] and index.docs == 1
    index = refresh(pages(spark), path, urls(spark, "u1"))
    assert index.docs == 0 and index.postings().count() == 0 and index.document_frequency().count() == 0


def test_a_refresh_that_did_not_finish_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "segments")
    before = listed(refresh(pages(spark, ("u1", "a", 1)), path).postings())

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "_commit", broken)
        with pytest.raises(RuntimeError):
            refresh(pages(spark, ("u1", "b", 2)), path)
    assert listed(read_incremental(spark, path).postings()) == before
    assert [t for t, *_ in listed(refresh(pages(spark, ("u1", "c", 2)), path).postings())] == ["c"]


def test_segments_of_like_size_are_merged_and_old_ones_removed(spark, tmp_path):
    path = str(tmp_path / "segments")
    for at in range(1, 6):
        before = read_incremental(spark, path)
        index = refresh(pages(spark, (f"u{at}", "a b", at), ("u0", f"w{at}", at)), path, fan=2)
        # Who still reads the segments of before may do so until the next refresh.
        assert before.counts().count() == (2 * (at - 1) + 1 if at > 1 else 0)
    assert len(index.segments) <= 4 and index.docs == 6
    # Merging drops ended versions.
    assert sum(s.postings for s in index.segments) < 5 * 3
    assert sorted(t for t, u, *_ in listed(index.postings()) if u == "u0") == ["w5"]


def test_a_refresh_reads_no_older_text_and_lookups_read_few_shards(spark, tmp_path):
    path = str(tmp_path / "segments")
    refresh(pages(spark, *[(f"u{n}", f"some words w{n}", 1) for n in range(50)]), path)
    index = refresh(pages(spark, ("u1", "other words", 2)), path)
    stored = index.pages()
    assert "content" not in stored.columns
    plan = stored.select("url", "version", "last_scraped")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<url:string,version:bigint,last_scraped:timestamp>", plan)
    wanted = index.placed(spark.createDataFrame([("w7",)], "term string")).collect()
    hits = index.lookup(wanted)
    assert [r.url for r in hits.collect()] == ["u7"]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(term), EqualTo(term,w7)]") >= 2 and "PartitionFilters: [" in plan
