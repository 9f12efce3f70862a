"""One registered query per operator, on the tables of a data folder.

``documents`` stands for the page store (the document id is the URL), ``pages`` for raw pages and
``events`` for the queue log and for page versions. Arrays are joined to text and doubles rounded, so
that results can be compared with other engines value by value.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.text import words
from gleanery.functions.urls import AllowRule, canonical, with_scheme
from gleanery.operators import crawl, frontier, index, metrics, pages, search
from gleanery.operators import words as word_jobs
from gleanery.operators.joins import union_all
from gleanery.operators.top_search import top_search
from gleanery.session import fan_out, fresh_path, stage
from gleanery.sources import tables
from gleanery.sources.banded_index import BandedIndex, write_banded
from gleanery.sources.gram_index import GramIndex, write_grams
from gleanery.sources.incremental import IncrementalIndex, read_incremental, refresh
from gleanery.sources.index_store import SavedIndex, read_index, write_index
from gleanery.sources.numbered_index import write_numbered
from gleanery.sources.page_store import read_store, upsert
from gleanery.streaming import jobs
from gleanery.streaming.series import queue_series, read_series

QUERIES = [
    (1, "the"),
    (2, "la que"),
    (3, "is of and"),
    (4, "  "),
    (5, "zzzunmatched the"),
    (6, "qqqunmatched"),
    (7, '"The" THE the'),
    (8, "nicht für aulich"),
    (9, "para con el los"),
]
NEEDLE = "able"
NEEDLES = ("able", "raul", "100", "zz", "no such string")
BLOCK = 256
MORE = 100
HOUR = 3600
BUCKETS = 7
NEXT = 20
AS_OF = "2024-01-31 00:00:00"
SPLIT = "2024-01-16 00:00:00"
PAGE_RULE = AllowRule(domain="example.com", path_prefix="/en/", blocked_params=("ref",))
LINK_RULE = AllowRule(domain="example.com", path_prefix="/")
SITE = "https://shop.example.com"
SITE_RULE = AllowRule(domain="example.com", path_prefix="/")
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"

_indexes: dict[tuple[str, str], SavedIndex] = {}
_banded: dict[tuple[str, str], BandedIndex] = {}
_grams: dict[tuple[str, str], GramIndex] = {}
_crawls: dict[tuple[str, str], DataFrame] = {}
_segments: dict[tuple[str, str], IncrementalIndex] = {}
_series_of: dict[tuple[str, str], str] = {}
_terms: dict[tuple[str, str], str] = {}


# Inputs


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_documents(spark, f"{sf}/documents.parquet")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    found = documents(spark, sf).select(F.col("url").alias("doc_id"), F.col("content").alias("text"))
    return fan_out(found)


def raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    return fan_out(spark.read.parquet(f"{sf}/pages.parquet"))


def page_urls(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/pages.parquet").select(canonical(with_scheme(F.col("url"))).alias("url"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def as_log(found: DataFrame) -> DataFrame:
    """Events as a queue log: signups enqueue, views dispatch and clicks complete a user's page."""
    kind = (
        F.when(F.col("event_type") == "signup", "enqueue")
        .when(F.col("event_type") == "view", "dispatch")
        .when(F.col("event_type") == "click", "complete")
    )
    return found.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("url"),
        kind.alias("kind"),
    ).filter(F.col("kind").isNotNull())


def as_versions(found: DataFrame) -> DataFrame:
    """Events as versions of a user's page."""
    return found.select(
        F.col("user_id").cast("string").alias("url"),
        F.col("props").alias("content"),
        F.col("ts").cast("timestamp").alias("last_scraped"),
    )


def log(spark: SparkSession, sf: str) -> DataFrame:
    return as_log(events(spark, sf))


def saved_index(spark: SparkSession, sf: str) -> SavedIndex:
    """The index of the documents, built once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _indexes:
        _indexes[key] = write_index(documents(spark, sf), fresh_path(spark, "index"))
    return _indexes[key]


def asked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(QUERIES, "query_id bigint, query string")


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def stamp(column: str) -> Column:
    return F.date_format(column, STAMP).alias(column)


def rounded(column: str) -> Column:
    return F.round(column, 6).alias(column)


def comma(column: Column) -> Column:
    return F.array_join(column, ",")


# Index


def scan_pages(spark, sf):
    return documents(spark, sf)


def tokenize_documents(spark, sf):
    return index.tokenize(documents(spark, sf)).select(
        "url", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


def term_frequency(spark, sf):
    return index.term_frequency(documents(spark, sf))


def document_frequency(spark, sf):
    return index.document_frequency(index.term_frequency(documents(spark, sf)))


def _postings(found: DataFrame) -> DataFrame:
    return found.select("term", "url", "tf", "df", rounded("tfidf"))


def tfidf_postings(spark, sf):
    return _postings(index.build_postings(documents(spark, sf)))


def inverted_index(spark, sf):
    blocks = index.inverted_index(index.build_postings(documents(spark, sf)), BLOCK)
    micros = F.transform("postings", lambda p: F.round(p["tfidf"] * 1_000_000).cast("bigint").cast("string"))
    return blocks.select(
        "term", "block", F.size("postings").cast("bigint").alias("n"),
        comma(F.col("postings.url")).alias("urls"), comma(micros).alias("micros"),
    )


def index_stats(spark, sf):
    found = documents(spark, sf)
    return index.index_stats(found, index.document_frequency(index.term_frequency(found)))


def write_and_read_index(spark, sf):
    path = fresh_path(spark, "index")
    write_index(documents(spark, sf), path)
    return _postings(read_index(spark, path).postings())


def refreshed_index(spark: SparkSession, sf: str) -> IncrementalIndex:
    """An index of all documents after three refreshes, kept for the application.

    The first knows every document by an earlier text, and a page beside each that is later removed. The others bring the
    texts of today, first the English ones, then all others together with outdated versions of the English ones.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _segments:
        docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").cast("string").alias("url"), "text", "lang", "source")
        english = F.coalesce(F.col("lang") == "en", F.lit(False))
        at = lambda hour: instant(AS_OF) + F.expr(f"interval {hour} hours")
        earlier = docs.select("url", F.concat_ws(" ", F.lit("earlier version"), "lang", "source", "url").alias("content"), at(1).alias("last_scraped"))
        beside = docs.select(F.concat(F.lit("beside-"), "url").alias("url"), F.lit("a page that goes").alias("content"), at(1).alias("last_scraped"))
        today = docs.select("url", F.col("text").alias("content"), at(3).alias("last_scraped"), english.alias("english"))
        path = fresh_path(spark, "segments")
        refresh(earlier.unionByName(beside), path, fan=2)
        refresh(today.filter("english").drop("english"), path, fan=2)
        outdated = earlier.withColumn("last_scraped", at(2))
        _segments[key] = refresh(today.filter("not english").drop("english").unionByName(outdated), path, removed=beside, fan=2)
    return _segments[key]


def incremental_index(spark, sf):
    return _postings(refreshed_index(spark, sf).postings())


def incremental_search(spark, sf):
    return _results(search.in_order(search.ranked_search(refreshed_index(spark, sf), asked(spark))))


def numbered_index(spark, sf):
    return _postings(write_numbered(documents(spark, sf), fresh_path(spark, "numbered")).postings())


def grep_index(spark, sf):
    return _postings(search.grep_index(saved_index(spark, sf).postings(), NEEDLE))


def grep_grams(spark, sf):
    """Entries that hold each of several strings: inside words, inside document ids, and too short for a trigram."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _grams:
        _grams[key] = write_grams(saved_index(spark, sf))
    return union_all([_postings(_grams[key].grep(needle)).withColumn("needle", F.lit(needle)) for needle in NEEDLES])


# Search


def _results(found: DataFrame) -> DataFrame:
    return found.withColumn("tokens", comma(F.col("tokens"))).withColumn("score", F.round("score", 6))


def _search(spark, sf):
    return search.ranked_search(saved_index(spark, sf), asked(spark))


def ranked_search(spark, sf):
    return _results(search.in_order(_search(spark, sf)))


def search_exact(spark, sf):
    return _results(search.of_kind(_search(spark, sf), "exact"))


def search_partial(spark, sf):
    return _results(search.of_kind(_search(spark, sf), "partial"))


def search_top10(spark, sf):
    top = _results(search.top_results(_search(spark, sf)))
    return top.withColumn("rank", F.col("rank").cast("bigint"))


def banded_index(spark: SparkSession, sf: str) -> BandedIndex:
    """The index of the documents in bands of like length, built once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _banded:
        _banded[key] = write_banded(documents(spark, sf), fresh_path(spark, "banded"))
    return _banded[key]


def search_top10_bounded(spark, sf):
    top = _results(top_search(banded_index(spark, sf), asked(spark)))
    return top.withColumn("rank", F.col("rank").cast("bigint"))


def search_prompt_view(spark, sf):
    shown = search.prompt_view(_search(spark, sf))
    return shown.select("query_id", "match_kind", F.col("rank").cast("bigint").alias("rank"), "url", "shown")


def search_response(spark, sf):
    responses = search.search_response(asked(spark), _search(spark, sf), more=MORE)
    return responses.select(
        "query_id", "section", "page",
        F.coalesce(F.size("entries"), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(comma(F.col("entries.url")), F.lit("")).alias("urls"),
        F.coalesce("note", F.lit("")).alias("note"),
    )


def search_response_json(spark, sf):
    """Responses as JSON texts, with scores and matched tokens of each entry."""
    responses = search.search_response(asked(spark), _search(spark, sf), more=MORE)
    return search.response_json(responses)


def terms_file(spark, sf):
    """A file of search terms: the words of all questions asked in conversations, most used first."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _terms:
        turns = spark.read.parquet(f"{sf}/conversations.parquet").filter("role = 'user'")
        counts = word_jobs.word_count(turns.select(F.col("conv_id").alias("doc_id"), "text"))
        path = fresh_path(spark, "terms")
        tables.write_lines(counts.orderBy(F.desc("count"), "word").select("word"), path)
        _terms[key] = path
    return _terms[key]


def batch_terms(spark, sf):
    read = tables.read_terms(spark, terms_file(spark, sf))
    return read.select(F.col("query_id").cast("bigint").alias("query_id"), "query")


def batch_search(spark, sf):
    queries = stage(batch_terms(spark, sf), "batch")
    return _results(search.in_order(search.ranked_search(saved_index(spark, sf), queries)))


# Word jobs


def word_count(spark, sf):
    return word_jobs.word_count(corpus(spark, sf))


def invert_words(spark, sf):
    return word_jobs.invert_words(corpus(spark, sf), BLOCK)


def shard_words(spark, sf):
    sharded = word_jobs.shard_words(corpus(spark, sf), BUCKETS)
    return sharded.withColumn("bucket", F.col("bucket").cast("bigint"))


def _initials() -> Column:
    """First letter and length of every word."""
    return F.transform(words(F.col("text")), lambda w: F.struct(
        F.substring(w, 1, 1).alias("key"), F.length(w).cast("bigint").alias("value")
    ))


def map_reduce(spark, sf):
    """Per first letter of a word: occurrences, greatest length and number of documents."""
    return word_jobs.map_reduce(
        corpus(spark, sf), _initials(),
        words=F.count("*"), longest=F.max("value"), documents=F.count_distinct("doc_id"),
    )


def map_reduce_python(spark, sf):
    """Per first letter of a word: sum of lengths, with the reduce step in Python."""
    return word_jobs.map_reduce_python(corpus(spark, sf), _initials(), lambda values: values.sum(), "bigint")


def map_python(spark, sf):
    """Per first letter of a word: number and total length of the words, with the map step in Python."""
    def letters(_, text):
        return ((word[0], len(word)) for word in (text or "").split())

    pairs = word_jobs.map_python(corpus(spark, sf), letters, "bigint")
    return pairs.groupBy("key").agg(F.count("*").alias("words"), F.sum("value").alias("letters"))


def text_corpus(spark, sf):
    """Words of the documents written as text files and read again line by line, with the number of lines they are on."""
    path = fresh_path(spark, "texts")
    tables.write_lines(corpus(spark, sf).select("text"), path)
    lines = tables.read_corpus(spark, path)
    return word_jobs.map_reduce(lines, words(F.col("text")), count=F.count("*")).withColumnRenamed("key", "word")


def word_shards(spark, sf):
    """Totals of the buckets of words, from their folders."""
    path = fresh_path(spark, "word-shards")
    word_jobs.write_sharded(word_jobs.shard_words(corpus(spark, sf), BUCKETS), path)
    totals = word_jobs.bucket_totals(spark.read.parquet(path))
    return totals.select(F.col("bucket").cast("bigint").alias("bucket"), "words", "occurrences")


def word_preview(spark, sf):
    """What a word job shows of its output: the number of rows, and the first five in order."""
    counts = word_jobs.word_count(corpus(spark, sf))
    total, first = word_jobs.preview(counts.orderBy(F.desc("count"), "word"))
    return spark.createDataFrame([(total, n + 1, *row) for n, row in enumerate(first)], "total bigint, place bigint, word string, count bigint")


# Pages and URLs


def normalise_urls(spark, sf):
    return pages.normalise_urls(raw_pages(spark, sf))


def extract_links(spark, sf):
    return pages.extract_links(raw_pages(spark, sf))


def dropped_links(spark, sf):
    return pages.dropped_links(raw_pages(spark, sf))


def extract_content(spark, sf):
    return pages.extract_content(raw_pages(spark, sf))


def admit_urls(spark, sf):
    return frontier.admit_urls(raw_pages(spark, sf), PAGE_RULE)


# Frontier


def _statuses(offered: DataFrame) -> DataFrame:
    return offered.select("url", F.col("status").cast("bigint").alias("status"), "offers")


def frontier_new(spark, sf):
    links = pages.extract_links(raw_pages(spark, sf)).select(F.col("dst").alias("url"))
    known = page_urls(spark, sf)
    return _statuses(frontier.offer_urls(links.unionByName(known), known, LINK_RULE))


def frontier_expand(spark, sf):
    """A step from the English pages; seen are the links of the German ones."""
    found = raw_pages(spark, sf)
    start = found.filter(F.col("url").contains("/en/")).select(canonical(with_scheme(F.col("url"))).alias("url"))
    seen = pages.extract_links(found.filter(F.col("url").contains("/de/"))).select(F.col("dst").alias("url")).distinct()
    return _statuses(crawl.frontier_step(start, found, seen, LINK_RULE))


def site(spark: SparkSession, sf: str) -> DataFrame:
    """Raw pages of a shop: each order links to the parts in it, each part to the orders that it is in."""
    items = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_partkey").distinct()
    order, part = (F.concat(F.lit(f"/{kind}/"), F.col(key)) for kind, key in (("order", "l_orderkey"), ("part", "l_partkey")))
    links = items.select(order.alias("path"), part.alias("to")).unionByName(items.select(part.alias("path"), order.alias("to")))
    anchor = F.concat(F.lit('<a href="'), "to", F.lit('#top">see</a>'))
    body = F.concat(F.lit("<html><body>"), F.concat_ws(" ", F.sort_array(F.collect_list(anchor))), F.lit("</body></html>"))
    return links.groupBy("path").agg(body.alias("html")).select(F.concat(F.lit(SITE), "path").alias("url"), "html")


def crawled(spark: SparkSession, sf: str) -> DataFrame:
    """The crawl of that shop from its first order, kept for the application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _crawls:
        first = spark.read.parquet(f"{sf}/lineitem.parquet").agg(F.min("l_orderkey").alias("k"))
        seeds = first.select(F.concat(F.lit(f"{SITE}/order/"), "k").alias("url"))
        _crawls[key] = stage(crawl.crawl(stage(site(spark, sf), "site"), seeds, SITE_RULE), "crawl")
    return _crawls[key]


def crawl_levels(spark, sf):
    return crawled(spark, sf).select("url", F.col("level").cast("bigint").alias("level"))


def crawl_export(spark, sf):
    path = fresh_path(spark, "crawl")
    tables.write_lines(crawl.first_taken(crawled(spark, sf), frontier.EXPORT_ROWS), path)
    return spark.read.text(path).withColumnRenamed("value", "url")


def frontier_advance(spark, sf):
    """The stored frontier after three batches: links of the English pages, of the German ones, and of all."""
    found, path = raw_pages(spark, sf), fresh_path(spark, "frontier")
    parts = [F.col("url").contains("/en/"), F.col("url").contains("/de/"), F.lit(True)]
    for batch, part in enumerate(parts):
        offers = pages.extract_links(found.filter(part)).select(F.col("dst").alias("url"))
        crawl.advance_frontier(offers, path, batch, LINK_RULE)
    return crawl.read_frontier(spark, path).select("url", F.col("batch").cast("bigint").alias("batch"))


def frontier_next_batch(spark, sf):
    state = frontier.queue_state(log(spark, sf)).filter(F.col("state") == "enqueue")
    batch = frontier.next_batch(state.select("url", F.col("since").alias("enqueued_at")), NEXT)
    return batch.select("url", stamp("enqueued_at"))


def recency_gate(spark, sf):
    seen = log(spark, sf)
    done = seen.filter(F.col("kind") == "complete").groupBy("url").agg(F.max("ts").alias("last_scraped"))
    due = frontier.recency_gate(seen.select("url").distinct(), done, instant(AS_OF))
    return due.select("url", stamp("last_scraped"))


def requeue_inflight(spark, sf):
    return frontier.requeue_inflight(log(spark, sf), instant(AS_OF), HOUR).select("url", stamp("dispatched_at"))


def upsert_pages(spark, sf):
    versions = as_versions(events(spark, sf))
    store = frontier.latest_pages(versions.filter(F.col("last_scraped") < instant(SPLIT)))
    batch = versions.filter(F.col("last_scraped") >= instant(SPLIT))
    return frontier.upsert_pages(store, batch).select("url", "content", stamp("last_scraped"))


def page_store_upserts(spark, sf):
    """The store after all versions: those of the second half first, then all of them, of which the older ones lose."""
    versions, path = as_versions(events(spark, sf)), fresh_path(spark, "page-store")
    upsert(versions.filter(F.col("last_scraped") >= instant(SPLIT)), path, fan=2)
    return upsert(versions, path, fan=2).pages().select("url", "content", stamp("last_scraped"))


def export_urls(spark, sf):
    found = pages.extract_links(raw_pages(spark, sf), "page_id")
    queued = found.groupBy(F.col("dst").alias("url")).agg(F.min("page_id").alias("enqueued_at"))
    path = fresh_path(spark, "urls")
    tables.write_lines(frontier.export_urls(queued), path)
    return spark.read.text(path).withColumnRenamed("value", "url")


# Metrics


def completion_rate(spark, sf):
    rate = metrics.completion_rate(log(spark, sf), HOUR)
    return rate.select(stamp("window_start"), F.col("completed").cast("bigint").alias("completed"))


def queue_length(spark, sf):
    length = metrics.queue_length(log(spark, sf), HOUR)
    return length.select(stamp("window_start"), F.col("queue_length").cast("bigint").alias("queue_length"))


def append_metrics(spark, sf):
    rows = metrics.throughput(log(spark, sf), HOUR)
    path = fresh_path(spark, "throughput")
    tables.append_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema).select(stamp("window_start"), "completed", "queue_length")


def index_metrics(spark, sf):
    """The metrics row of an index build, written as CSV and read again; its time is only known to be one."""
    started = time.monotonic()
    built = write_index(documents(spark, sf), fresh_path(spark, "index"))
    row, path = metrics.index_metrics(built, time.monotonic() - started), fresh_path(spark, "index-metrics")
    tables.append_csv(row, path)
    read = tables.read_csv(spark, path, row.schema)
    return read.select("docs_count", "terms_count", ((F.col("time_taken") > 0) & F.col("timestamp").isNotNull()).alias("timed"))


def search_metrics(spark, sf):
    """The metrics rows of a batch of searches, written as CSV and read again."""
    queries = stage(batch_terms(spark, sf), "batch")
    started = time.monotonic()
    search.top_results(search.ranked_search(saved_index(spark, sf), queries)).count()
    rows, path = metrics.search_timings(queries, time.monotonic() - started), fresh_path(spark, "search-metrics")
    tables.append_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema).select("term", (F.col("time_taken_s") > 0).alias("timed"))


# Streams


def _stream(spark, sf, table):
    return jobs.stream_table(spark, f"{sf}/{table}.parquet")


def stream_pages(spark, sf):
    arriving = _stream(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("url"), F.col("text").alias("content")
    )
    out = fresh_path(spark, "stream-pages")
    jobs.copy_pages(arriving, out, once=True).awaitTermination()
    return spark.read.parquet(out)


def stream_seen_urls(spark, sf):
    found = pages.extract_links(_stream(spark, sf, "pages")).select(F.col("dst").alias("url"))
    out = fresh_path(spark, "stream-seen")
    jobs.seen_urls(found, out, once=True).awaitTermination()
    return spark.read.parquet(out)


def stream_completion_rate(spark, sf):
    out = fresh_path(spark, "stream-rate")
    jobs.completion_counts(as_log(_stream(spark, sf, "events")), out, HOUR, once=True).awaitTermination()
    return jobs.read_counts(spark, out).select(stamp("window_start"), "completed")


def _series(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _series_of:
        out = fresh_path(spark, "stream-series")
        queue_series(as_log(_stream(spark, sf, "events")), out, HOUR, once=True).awaitTermination()
        _series_of[key] = out
    return read_series(spark, _series_of[key])


def stream_completion_windows(spark, sf):
    return _series(spark, sf).select(stamp("window_start"), "completed")


def stream_queue_length(spark, sf):
    return _series(spark, sf).select(stamp("window_start"), "queue_length")


def stream_upsert_pages(spark, sf):
    out = fresh_path(spark, "stream-store")
    jobs.store_pages(as_versions(_stream(spark, sf, "events")), out, once=True).awaitTermination()
    return jobs.read_pages(spark, out).select("url", "content", stamp("last_scraped"))


def stream_page_store(spark, sf):
    path = fresh_path(spark, "stream-pages")
    jobs.upsert_store(as_versions(_stream(spark, sf, "events")), path, once=True).awaitTermination()
    return read_store(spark, path).pages().select("url", "content", stamp("last_scraped"))


def stream_page_changes(spark, sf):
    """The changes of a store by two upserts, followed by a stream that is started again after each."""
    versions, store, out = as_versions(events(spark, sf)), fresh_path(spark, "changing"), fresh_path(spark, "changes")
    for part in (F.col("last_scraped") < instant(SPLIT), F.col("last_scraped") >= instant(SPLIT)):
        upsert(versions.filter(part), store)
        jobs.page_changes(spark, store, out, once=True).awaitTermination()
    return spark.read.parquet(out).select("version", "url", "kind", "content", stamp("last_scraped"))


def stream_index_refresh(spark, sf):
    arriving = _stream(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("url"),
        F.col("text").alias("content"),
        instant(AS_OF).alias("last_scraped"),
    )
    store, path = fresh_path(spark, "refresh-store"), fresh_path(spark, "refresh-index")
    jobs.refresh_index(arriving, store, path, once=True).awaitTermination()
    return _postings(read_index(spark, path).postings())


def stream_segments(spark, sf):
    arriving = _stream(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("url"),
        F.col("text").alias("content"),
        instant(AS_OF).alias("last_scraped"),
    )
    path = fresh_path(spark, "stream-segments")
    jobs.refresh_segments(arriving, path, once=True).awaitTermination()
    return _postings(read_incremental(spark, path).postings())


def stream_requeue(spark, sf):
    out = fresh_path(spark, "stream-requeue")
    jobs.requeue(as_log(_stream(spark, sf, "events")), out, HOUR, late="0 seconds", once=True).awaitTermination()
    return spark.read.parquet(out).select("url", stamp("dispatched_at"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_pages": scan_pages,
        "tokenize_documents": tokenize_documents,
        "term_frequency": term_frequency,
        "document_frequency": document_frequency,
        "tfidf_postings": tfidf_postings,
        "inverted_index": inverted_index,
        "index_stats": index_stats,
        "write_index": write_and_read_index,
        "incremental_index": incremental_index,
        "incremental_search": incremental_search,
        "numbered_index": numbered_index,
        "grep_index": grep_index,
        "grep_grams": grep_grams,
        "ranked_search": ranked_search,
        "search_exact": search_exact,
        "search_partial": search_partial,
        "search_top10": search_top10,
        "search_top10_bounded": search_top10_bounded,
        "search_prompt_view": search_prompt_view,
        "search_response": search_response,
        "search_response_json": search_response_json,
        "batch_terms": batch_terms,
        "batch_search": batch_search,
        "word_count": word_count,
        "invert_words": invert_words,
        "shard_words": shard_words,
        "map_reduce": map_reduce,
        "map_reduce_python": map_reduce_python,
        "map_python": map_python,
        "text_corpus": text_corpus,
        "word_shards": word_shards,
        "word_preview": word_preview,
        "normalise_urls": normalise_urls,
        "extract_links": extract_links,
        "dropped_links": dropped_links,
        "extract_content": extract_content,
        "admit_urls": admit_urls,
        "frontier_new": frontier_new,
        "frontier_expand": frontier_expand,
        "frontier_advance": frontier_advance,
        "crawl_levels": crawl_levels,
        "crawl_export": crawl_export,
        "frontier_next_batch": frontier_next_batch,
        "recency_gate": recency_gate,
        "requeue_inflight": requeue_inflight,
        "upsert_pages": upsert_pages,
        "page_store_upserts": page_store_upserts,
        "export_urls": export_urls,
        "completion_rate": completion_rate,
        "queue_length": queue_length,
        "append_metrics": append_metrics,
        "index_metrics": index_metrics,
        "search_metrics": search_metrics,
        "stream_pages": stream_pages,
        "stream_seen_urls": stream_seen_urls,
        "stream_completion_rate": stream_completion_rate,
        "stream_completion_windows": stream_completion_windows,
        "stream_queue_length": stream_queue_length,
        "stream_upsert_pages": stream_upsert_pages,
        "stream_page_store": stream_page_store,
        "stream_page_changes": stream_page_changes,
        "stream_index_refresh": stream_index_refresh,
        "stream_segments": stream_segments,
        "stream_requeue": stream_requeue,
    }
