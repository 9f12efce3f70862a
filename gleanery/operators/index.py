"""Index build: term frequency, document frequency, TF-IDF postings and grouped posting lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import tokens
from gleanery.functions.urls import let
from gleanery.operators.joins import lookup_join, union_all
from gleanery.operators.ranking import rank_all
from gleanery.session import fan_out, short_batches, stage

BLOCK_SIZE = 10_000
LIST_TOKENS = 3_000_000  # tokens whose postings are combined at once
LIST_BYTES = 64 * 1024 * 1024
LIST_ROWS = 1 << 15  # lists that go back to Spark at once
PAGES_PER_BATCH = 256


def tokenize(pages: DataFrame) -> DataFrame:
    """``(url, tokens)`` for every page."""
    return pages.select("url", tokens(F.col("content")).alias("tokens"))


def term_counts(content: Column) -> Column:
    """Distinct tokens of a text with their numbers, ``array<struct<term, tf>>`` in order of the term.

    The tokens are sorted and equal neighbours counted: the last place of each run, less that of the run before.
    """
    def runs(ordered: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(ordered))
        last = F.filter(places, lambda i: F.get(ordered, i - 1) != F.coalesce(F.get(ordered, i), F.lit("")))
        return F.when(F.size(ordered) > 0, let(last, lambda ends: F.transform(ends, lambda end, n: F.struct(
            F.get(ordered, end - 1).alias("term"),
            (end - F.coalesce(F.get(ends, n - 1), F.lit(0))).cast("bigint").alias("tf"),
        )))).otherwise(F.array().cast("array<struct<term: string, tf: bigint>>"))

    return let(F.sort_array(tokens(content)), runs)


def term_frequency(pages: DataFrame) -> DataFrame:
    """``(term, url, tf)`` of a page table with one row per URL.

    A page is counted inside its row, so nothing is exchanged; a small input is spread over the cores.
    """
    counted = fan_out(pages.select("url", "content")).select("url", F.explode(term_counts(F.col("content"))).alias("count"))
    return counted.select("count.term", "url", "count.tf")


def posting_lists(pages: DataFrame, member: str, block: Column) -> DataFrame:
    """``(term, block, members, counts, n)``: postings of ``pages (member, content)``, combined where the pages lie.

    A list has the pages of one block that have the term, of some thousand pages of a task, and how often each has
    it; ``n`` is its length. Later steps join, exchange and sort a few lists a term in place of all its postings. Rows with the same
    ``member`` stay apart. The lists are a staged table.
    """
    rows = fan_out(pages.select(F.col(member).alias("member"), block.cast("int").alias("block"), "content"))
    rows = rows.select("member", "block", tokens(F.col("content")).alias("tokens"))
    kind = rows.schema["member"].dataType.simpleString()
    ddl = f"term string, block int, members array<{kind}>, counts array<int>, n int"
    with short_batches(pages.sparkSession, PAGES_PER_BATCH):
        return stage(rows.mapInArrow(_combined, ddl), "lists")


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for pages in _gathered(batches):
        block = pages.column("block").to_numpy()
        if (block[1:] < block[:-1]).any():
            pages = pages.take(pa.array(np.argsort(block, kind="stable")))
            block = pages.column("block").to_numpy()
        words = pages.column("tokens").combine_chunks()
        found = words.flatten().dictionary_encode()
        if not len(found):
            continue
        by_term = pc.array_sort_indices(found.dictionary)
        place = np.empty(len(by_term), np.int64)
        place[by_term.to_numpy()] = np.arange(len(by_term))
        page = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy())
        pairs, counts = np.unique(place[found.indices.to_numpy()] * len(words) + page, return_counts=True)
        term, page = np.divmod(pairs, len(words))
        new = np.ones(len(pairs), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[page[1:]] != block[page[:-1]])
        starts = np.flatnonzero(new)
        ends = pa.array(np.append(starts, len(pairs)).astype(np.int32))
        members = pages.column("member").combine_chunks().take(pa.array(page))
        made = {
            "term": found.dictionary.take(by_term.take(pa.array(term[starts]))),
            "block": pa.array(block[page[starts]], pa.int32()),
            "members": pa.ListArray.from_arrays(ends, members),
            "counts": pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())),
            "n": pa.array(np.diff(np.append(starts, len(pairs))), pa.int32()),
        }
        lists = pa.RecordBatch.from_pydict(made)
        for begin in range(0, len(starts), LIST_ROWS):
            yield lists.slice(begin, LIST_ROWS)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of pages put together until they have enough tokens."""
    held, n, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        n += len(batch.column("tokens").flatten())
        size += batch.nbytes
        if n >= LIST_TOKENS or size >= LIST_BYTES:
            yield pa.Table.from_batches(held)
            held, n, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def list_frequency(lists: DataFrame) -> DataFrame:
    """``(term, df, lists, longest)``, staged, of :func:`posting_lists`: pages and lists of each term, length of its longest list."""
    counts = [F.sum("n").alias("df"), F.count("*").alias("lists"), F.max("n").alias("longest")]
    return stage(lists.groupBy("term").agg(*counts), "df")


def cut_lists(lists: DataFrame, most: int) -> DataFrame:
    """The same postings in lists of at most ``most``."""
    begin = F.explode(F.sequence(F.lit(1), F.size("members"), F.lit(most))).alias("begin")
    part = [F.slice(c, F.col("begin"), F.lit(most)).alias(c) if c in ("members", "counts") else c for c in lists.columns]
    return lists.select("*", begin).select(*part)


def weighted(lists: DataFrame, docs: int) -> DataFrame:
    """``(term, url, tf, df, tfidf)`` from lists with their ``df``, in the same order."""
    each = lists.select("term", "counts", "df", F.posexplode("members").alias("at", "url"))
    tf = F.get("counts", F.col("at")).cast("bigint").alias("tf")
    return each.select("term", "url", tf, "df").withColumn("tfidf", F.col("tf") * idf(F.col("df"), docs))


def document_frequency(tf: DataFrame) -> DataFrame:
    """``(term, df)`` from ``(term, url, tf)``; counts combine before the exchange."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def idf(df: Column, docs: int) -> Column:
    """ln(N / (1 + df)): zero for a term in all pages but one, negative for a term in all pages."""
    return F.log(F.lit(float(docs)) / (1 + df))


def tfidf_postings(tf: DataFrame, df: DataFrame, docs: int, **limits) -> DataFrame:
    """``(term, url, tf, df, tfidf)``. ``tf`` and ``df`` should be staged tables."""
    joined = lookup_join(tf, df, key="term", weight="df", **limits)
    return joined.select(
        "term", "url", "tf", "df", (F.col("tf") * idf(F.col("df"), docs)).alias("tfidf")
    )


def build_postings(pages: DataFrame, **limits) -> DataFrame:
    """Postings of a page table with one row per URL."""
    lists = posting_lists(pages, "url", F.lit(0))
    return weighted(lookup_join(lists, list_frequency(lists), key="term", weight="lists", **limits), pages.count())


def in_blocks(members: DataFrame, key: str, member: str, size: str, block_size: int) -> DataFrame:
    """Add the ``block`` of each row: consecutive ranges of ``block_size`` members in order of ``member``.

    ``size`` is the column with the number of members of the row's ``key``. Only groups longer than a block
    are ranked. ``members`` is read twice and should be a table. ``size`` is left out of the result, so that it is in no exchange.
    """
    is_long = F.col(size) > block_size
    whole = members.filter(~is_long).drop(size).withColumn("block", F.lit(0).cast("bigint"))
    ranked = rank_all(members.filter(is_long).drop(size), [key], [F.col(member).asc()])
    return union_all([whole, ranked.withColumn("block", F.floor((F.col("rank") - 1) / F.lit(block_size))).drop("rank")])


def inverted_index(postings: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """``(term, block, postings)`` with postings ordered by URL, inside a block and from block to block.

    A term found in up to ``block_size`` pages has a single block 0. Longer lists continue in
    further blocks, so that no row and no task holds the list of a term found everywhere.
    """
    return (
        in_blocks(postings.select("term", "url", "tfidf", "df"), "term", "url", "df", block_size)
        .select("term", "block", F.struct("url", "tfidf").alias("posting"))
        .groupBy("term", "block")
        .agg(F.sort_array(F.collect_list("posting")).alias("postings"))
    )


def index_stats(pages: DataFrame, df: DataFrame) -> DataFrame:
    """One row ``(docs_count, terms_count)``; pages without tokens count as documents."""
    counts = [
        pages.agg(F.count("*").alias("n")).withColumn("what", F.lit("docs")),
        df.agg(F.count("*").alias("n")).withColumn("what", F.lit("terms")),
    ]
    return union_all(counts).agg(
        F.max(F.when(F.col("what") == "docs", F.col("n"))).alias("docs_count"),
        F.max(F.when(F.col("what") == "terms", F.col("n"))).alias("terms_count"),
    )
