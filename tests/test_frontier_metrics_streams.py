from datetime import datetime, timedelta

import check_queries
import pytest
from pyspark.sql import functions as F

from gleanery.functions.urls import AllowRule
from gleanery.operators import crawl, frontier, metrics
from gleanery.session import build_session, fresh_path, shared_dir
from gleanery.sources import tables
from gleanery.sources.index_store import read_index
from gleanery.streaming import jobs

RULE = AllowRule()
WIKI = "https://en.wikipedia.org/wiki/"
NOON = datetime(2024, 1, 1, 12)


def urls(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "url string")


def log(spark, *events):
    rows = [(NOON + timedelta(seconds=s), i, url, kind) for i, (s, url, kind) in enumerate(events)]
    return spark.createDataFrame(rows, "ts timestamp, seq bigint, url string, kind string")


def versions(spark, *rows):
    return spark.createDataFrame(
        [(u, c, NOON + timedelta(seconds=s)) for u, c, s in rows], "url string, content string, last_scraped timestamp"
    )


def test_offers(spark):
    offers = urls(spark, WIKI + "A", WIKI + "A", WIKI + "B", "http://elsewhere.org/")
    got = {r["url"]: (r["status"], r["offers"]) for r in frontier.offer_urls(offers, urls(spark, WIKI + "B"), RULE).collect()}
    assert got == {
        WIKI + "A": (frontier.ADDED, 2), WIKI + "B": (frontier.SEEN, 1), "http://elsewhere.org/": (frontier.REJECTED, 1)
    }
    assert [r["url"] for r in frontier.new_urls(frontier.offer_urls(offers, urls(spark), RULE)).orderBy("url").collect()] == [
        WIKI + "A", WIKI + "B"
    ]


def test_crawl_step(spark):
    pages = spark.createDataFrame(
        [(WIKI + "A/", '<a href="B">b</a><a href="/wiki/C">c</a><a href="/w/x">x</a>'), (WIKI + "Z", '<a href="Q">q</a>')],
        "url string, html string",
    )
    step = crawl.frontier_step(urls(spark, WIKI + "A"), pages, urls(spark, WIKI + "A", WIKI + "C"), RULE)
    got = {r["url"].rsplit("/", 1)[1]: r["status"] for r in step.collect()}
    assert got == {"B": frontier.ADDED, "C": frontier.SEEN, "x": frontier.REJECTED}


def test_dispatch_order_and_export(spark, tmp_path):
    queued = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "url string, enqueued_at int")
    assert [r["url"] for r in frontier.next_batch(queued, 2).collect()] == ["z", "y"]
    tables.write_lines(frontier.export_urls(queued, 2), str(tmp_path / "urls"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "urls")).collect()] == ["x", "y"]


def test_recency(spark):
    known = versions(spark, ("new", "c", -3599), ("old", "c", -3600))
    due = frontier.recency_gate(urls(spark, "new", "old", "never"), known, NOON)
    assert {r["url"] for r in due.collect()} == {"old", "never"}


EVENTS = [
    (0, "done", "dispatch"), (5, "done", "complete"), (10, "lost", "dispatch"),
    (20, "again", "dispatch"), (25, "again", "complete"), (30, "again", "dispatch"), (90, "late", "dispatch"),
]


def test_requeue(spark):
    back = frontier.requeue_inflight(log(spark, *EVENTS), NOON + timedelta(seconds=100), 30)
    assert {r["url"] for r in back.collect()} == {"lost", "again"}
    state = {r["url"]: r["state"] for r in frontier.queue_state(log(spark, *EVENTS)).collect()}
    assert state == {"done": "complete", "lost": "dispatch", "again": "dispatch", "late": "dispatch"}


def test_upsert(spark):
    store = versions(spark, ("a", "old", 0), ("b", "kept", 0), ("c", "newer", 50))
    batch = versions(spark, ("a", "new", 1), ("a", "newest", 2), ("a", "", 3), ("c", "older", 10), ("d", "first", 1), ("e", None, 1))
    got = {r["url"]: r["content"] for r in frontier.upsert_pages(store, batch).collect()}
    assert got == {"a": "newest", "b": "kept", "c": "newer", "d": "first"}
    assert frontier.latest_pages(store.unionByName(batch)).exceptAll(frontier.upsert_pages(store, batch)).isEmpty()


def test_windows_without_gaps(spark, monkeypatch):
    found = log(spark, (0, "x", "enqueue"), (1, "y", "enqueue"), (7, "x", "dispatch"), (8, "x", "complete"), (21, "y", "complete"))
    monkeypatch.setattr(metrics, "WINDOWS_PER_CHUNK", 2)
    rows = metrics.throughput(found).orderBy("window_start").collect()
    assert [r["completed"] for r in rows] == [0, 1, 0, 0, 1]
    assert [r["queue_length"] for r in rows] == [2, 1, 1, 1, 1]
    assert rows[0]["window_start"] == NOON
    assert metrics.completion_rate(found.limit(0)).count() == 0


def test_csv_is_appended_with_headers(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = metrics.search_timings(spark.createDataFrame([(1, "q")], "query_id int, query string"), 1.5)
    tables.append_csv(rows, path)
    tables.append_csv(rows, path)
    assert [tuple(r) for r in tables.read_csv(spark, path, rows.schema).collect()] == [("q", 1.5)] * 2


def test_terms_file(spark, tmp_path):
    (tmp_path / "terms.txt").write_text(" one \ntwo words\n\none\nfive\n")
    got = tables.read_terms(spark, str(tmp_path / "terms.txt"), 4).orderBy("query_id").collect()
    assert [tuple(r) for r in got] == [(1, "one"), (2, "two words"), (3, ""), (4, "one")]
    assert tables.read_terms(spark, str(tmp_path / "terms.txt")).count() == 5


def test_text_corpus(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x y\nz\n")
    assert {tuple(r) for r in tables.read_corpus(spark, str(tmp_path)).collect()} == {("a.txt", "x y"), ("a.txt", "z")}


def folder(spark, df, path, rows_per_file):
    """Write ``df`` in time order as files that a stream reads one per batch, oldest first."""
    time = "ts" if "ts" in df.columns else "last_scraped"
    df.coalesce(1).sortWithinPartitions(time).write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return jobs.stream_folder(spark, path, df.schema, files_per_batch=1)


def test_streams_end_like_their_batch_twins(spark, tmp_path):
    found = log(spark, *[(i * 3, f"u{i * i % 11}", ("enqueue", "dispatch", "complete")[i % 3]) for i in range(120)])
    stream = folder(spark, found, str(tmp_path / "log"), 40)

    jobs.seen_urls(stream.select("url"), str(tmp_path / "seen"), once=True).awaitTermination()
    seen = [r["url"] for r in spark.read.parquet(str(tmp_path / "seen")).collect()]
    assert sorted(seen) == sorted({r["url"] for r in found.collect()})

    jobs.seen_urls(stream.select("url", "ts"), str(tmp_path / "bounded"), within="1 day", once=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "bounded")).count() == len(seen)

    expected = {tuple(r) for r in metrics.completion_rate(found, 20).filter("completed > 0").collect()}
    for name, late in (("rate", None), ("late", "1 day")):
        jobs.completion_counts(stream, str(tmp_path / name), 20, late=late, once=True).awaitTermination()
        assert {tuple(r) for r in jobs.read_counts(spark, str(tmp_path / name)).collect()} == expected


def test_stream_requeue_over_several_batches(spark, tmp_path):
    events = [(0, "done", "dispatch"), (5, "done", "complete"), (10, "lost", "dispatch"), (70, "late", "dispatch"),
              (75, "late", "complete"), (100, "tail", "dispatch")]
    stream = folder(spark, log(spark, *events), str(tmp_path / "log"), 2)
    jobs.requeue(stream, str(tmp_path / "back"), 30, late="0 seconds", once=True).awaitTermination()
    back = spark.read.parquet(str(tmp_path / "back")).collect()
    assert [tuple(r) for r in back] == [("lost", NOON + timedelta(seconds=10))]


def test_stream_requeue_with_a_completion_before_its_dispatch(spark, tmp_path):
    rows = log(spark, (10, "done", "dispatch"), (12, "done", "complete"), (200, "tail", "dispatch"))
    for seq in (1, 0, 2):
        rows.where(F.col("seq") == seq).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream = jobs.stream_folder(spark, str(tmp_path / "log"), rows.schema, files_per_batch=1)
    jobs.requeue(stream, str(tmp_path / "back"), 30, late="1 minute", once=True).awaitTermination()
    assert spark.read.schema("url string, dispatched_at timestamp").parquet(str(tmp_path / "back")).collect() == []


def test_streamed_page_store_and_index(spark, tmp_path):
    rows = versions(spark, ("a", "one", 0), ("b", "two", 1), ("a", "three", 60), ("c", "", 61), ("d", "two four", 62))
    stream = folder(spark, rows, str(tmp_path / "pages"), 3)
    jobs.copy_pages(stream, str(tmp_path / "copy"), once=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 5

    jobs.store_pages(stream, str(tmp_path / "store"), once=True).awaitTermination()
    store = {r["url"]: r["content"] for r in jobs.read_pages(spark, str(tmp_path / "store")).collect()}
    assert store == {"a": "three", "b": "two", "d": "two four"}

    jobs.refresh_index(stream, str(tmp_path / "log"), str(tmp_path / "index"), once=True).awaitTermination()
    saved = read_index(spark, str(tmp_path / "index"))
    assert {r["term"] for r in saved.postings().collect()} == {"two", "three", "four"}
    assert metrics.index_metrics(saved, 2.0).first()["docs_count"] == 3


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark).startswith(configured)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert build_session() is not None


@pytest.mark.parametrize("name", sorted(check_queries.contract.oracle_sql()))
def test_registered_query_equals_its_sql_twin(spark, name):
    sf = "/root/testdata/sf0.001"
    good, note = check_queries.compare(spark, check_queries.connect(sf), sf, name)
    assert good, note


def test_new_url_statuses_all_occur(spark):
    rows = check_queries.contract.queries()["frontier_new"](spark, "/root/testdata/sf0.001").collect()
    assert {r["status"] for r in rows} == {-1, 0, 1}


def test_streams_of_tables_that_are_folders(spark, tmp_path):
    docs = [(i, f"word{i} common", "en", "web", 12) for i in range(6)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(
        3).write.parquet(str(tmp_path / "documents.parquet"))
    pages = [(i, f"http://a.example.com/{i}", '<a href="/next">next</a>') for i in range(4)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(2).write.parquet(str(tmp_path / "pages.parquet"))
    run = check_queries.contract.queries()
    assert sorted(r["url"] for r in run["stream_pages"](spark, str(tmp_path)).collect()) == [str(i) for i in range(6)]
    assert [r["url"] for r in run["stream_seen_urls"](spark, str(tmp_path)).collect()] == ["http://a.example.com/next"]
    for name in ("stream_index_refresh", "stream_segments"):
        assert run[name](spark, str(tmp_path)).filter("term = 'common'").count() == 6
