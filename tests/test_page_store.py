"""The page store in segments against the latest version of each page, and what its plans exchange."""

import random

import pytest
from pyspark.sql import functions as F

from gleanery.sources import page_store
from gleanery.sources.page_store import read_store, upsert


def pages(spark, rows):
    found = spark.createDataFrame([(u, c, f"2024-01-01 00:00:{at:02d}") for u, c, at in rows], "url string, content string, at string")
    return found.select("url", "content", F.col("at").cast("timestamp").alias("last_scraped"))


def listed(store):
    return sorted((r.url, r.content, r.last_scraped.second) for r in store.pages().collect())


def test_upserts_leave_the_latest_versions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(page_store, "LIST_BYTES", 64)  # the list of replaced versions goes in parts
    rng, latest, path = random.Random(2), {}, str(tmp_path / "store")
    for number in range(4):
        batch = [(f"u{rng.randrange(20)}", f"text {number} {n}", rng.randrange(60)) for n in range(12)] + [("u1", "", 59), ("u2", None, 59)]
        store = upsert(pages(spark, batch), path, shards=4, fan=2)
        best = {}
        for url, content, at in batch:
            if content and (url not in best or (at, content) > best[url]):
                best[url] = (at, content)
        latest |= {u: v for u, v in best.items() if u not in latest or latest[u][0] <= v[0]}
        assert listed(store) == sorted((u, c, at) for u, (at, c) in latest.items()) and store.rows == len(latest)
    assert listed(read_store(spark, path)) == listed(store) and len(store.segments) <= 3


def test_odd_batches(spark, tmp_path):
    path = str(tmp_path / "store")
    assert read_store(spark, path).pages().count() == 0 and upsert(pages(spark, []), path).rows == 0
    for _ in range(2):  # a batch that is run again
        assert listed(upsert(pages(spark, [("a", "x", 1), ("a", "x", 1), ("b", "y", 2)]), path)) == [("a", "x", 1), ("b", "y", 2)]


def test_an_upsert_that_did_not_finish_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    upsert(pages(spark, [("a", "x", 1)]), path)
    with monkeypatch.context() as patched:
        patched.setattr(page_store, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert(pages(spark, [("a", "y", 2)]), path)
    assert listed(read_store(spark, path)) == [("a", "x", 1)]


def test_stored_content_is_in_no_exchange(spark, tmp_path):
    path = str(tmp_path / "store")
    upsert(pages(spark, [(f"u{n}", "x", 1) for n in range(50)]), path)
    store = upsert(pages(spark, [("u1", "y", 2)]), path)
    plan = store.pages()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "hashpartitioning" not in plan and "SinglePartition" not in plan
    keys = store.stored().select("url", "version", "last_scraped")._jdf.queryExecution().executedPlan().toString()
    assert "content:string" not in keys


def test_jobs_leave_no_staged_tables(spark, tmp_path):
    from pathlib import Path

    from gleanery.session import shared_dir
    from gleanery.sources.incremental import refresh
    from gleanery.sources.index_store import write_index

    def staged():
        return {p.name for p in Path(shared_dir(spark)).iterdir()} if Path(shared_dir(spark)).exists() else set()

    before, found = staged(), pages(spark, [("a", "x y", 1), ("b", "y", 2)])
    for number in range(3):
        refresh(pages(spark, [("a", f"x {number}", number)]), str(tmp_path / "segments"), fan=2)
    upsert(found, str(tmp_path / "store"))
    write_index(found, str(tmp_path / "index"))
    assert staged() == before


def test_changes_are_followed_over_merges_and_restarts(spark, tmp_path):
    from gleanery.streaming import jobs

    store, out = str(tmp_path / "store"), str(tmp_path / "changes")
    seen = []
    for at, batch in enumerate([[("a", "1", 1), ("b", "1", 1)], [("a", "2", 2)], [("c", "1", 3), ("b", "0", 0)], [("a", "4", 4)]]):
        upsert(pages(spark, batch), store, shards=2, fan=2)
        if at != 1:  # two upserts may come between
            jobs.page_changes(spark, store, out, once=True).awaitTermination()
        seen = sorted((r.version, r.url, r.kind, r.content) for r in spark.read.parquet(out).collect())
    kinds = [(url, kind, content) for _, url, kind, content in seen]
    assert kinds == [("a", "new", "1"), ("b", "new", "1"), ("a", "changed", "2"), ("c", "new", "1"), ("a", "changed", "4")]


def test_posting_files_hold_bloom_filters_of_their_terms(spark, tmp_path):
    from pathlib import Path

    from gleanery.sources.index_store import write_index

    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    # A column that fits into its dictionary needs no filter: the dictionary is one.
    conf.set("parquet.dictionary.page.size", "64")
    try:
        index = write_index(pages(spark, [(f"u{n}", f"word{n} other", 1) for n in range(200)]), str(tmp_path / "index"), shards=2)
    finally:
        conf.unset("parquet.dictionary.page.size")
    for file in Path(index.path).glob("postings/shard=*/*.parquet"):
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(str(file)), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        for block in reader.getFooter().getBlocks():
            offsets = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in block.getColumns()}
            assert offsets["term"] > 0 and offsets["url"] < 0
        reader.close()
    wanted = index.placed(spark.createDataFrame([("word100x",)], "term string")).collect()
    assert index.lookup(wanted).count() == 0
