"""Ranked search: many queries in one job over a saved index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import tokens
from gleanery.operators.joins import lookup_join
from gleanery.operators.ranking import rank_all, top_k
from gleanery.session import stage
from gleanery.sources.index_store import SavedIndex

MAX_QUERY_TERMS = 10_000
MAX_QUERY_BYTES = 8 * 1024 * 1024
BITS = 62
SALT_ROWS = 100_000
FIRST_PAGE = 10
PROMPT_ROWS = 11
MORE_PAGE = 1_000


def query_tokens(queries: DataFrame) -> DataFrame:
    """``(query_id, tokens)``: the distinct tokens of each query in alphabetical order."""
    return queries.select(
        "query_id", F.sort_array(F.array_distinct(tokens(F.col("query")))).alias("tokens")
    )


def ranked_search(index: SavedIndex, queries: DataFrame) -> DataFrame:
    """``(query_id, match_kind, url, score, tokens)`` for every page with a query token.

    ``match_kind`` is ``exact`` when all tokens of the query are on the page and ``partial``
    otherwise; ``tokens`` are the matched ones in alphabetical order.
    """
    asked = query_tokens(queries)
    terms = asked.select("query_id", F.posexplode("tokens").alias("position", "term"))
    each = index.placed(terms).groupBy("term", "shard").agg(
        F.count("*").alias("asked"),
        F.sum(F.octet_length("term") + F.octet_length(F.col("query_id").cast("string"))).alias("bytes"),
        F.max("position").alias("last"),
    )
    wanted = each.limit(MAX_QUERY_TERMS + 1).collect()

    few = sum(r["asked"] for r in wanted) <= MAX_QUERY_TERMS and sum(r["bytes"] for r in wanted) <= MAX_QUERY_BYTES
    if few:
        last = max((r["last"] for r in wanted), default=0)
        hits = index.lookup(wanted).join(F.broadcast(terms), "term")
    else:
        last = each.agg(F.max("last")).first()[0]
        hits = _salted_hits(index.postings(), terms)

    # One bit per matched token: sums and bit masks keep the aggregation free of token arrays.
    bit = F.expr(f"shiftleft(1L, position % {BITS})")
    sums = [F.sum("tfidf").alias("score"), F.count("*").alias("matched"), F.bit_or(bit).alias("mask")]
    if last < BITS:
        masks = F.array(F.struct(F.lit(0).alias("word"), "mask"))
        matched = hits.groupBy("query_id", "url").agg(*sums).withColumn("masks", masks)
    else:
        words = hits.groupBy("query_id", "url", F.expr(f"position div {BITS}").cast("int").alias("word")).agg(*sums)
        masks = F.sort_array(F.collect_list(F.struct("word", "mask")))
        matched = words.groupBy("query_id", "url").agg(
            F.sum("score").alias("score"), F.sum("matched").alias("matched"), masks.alias("masks")
        )
    return matched.join(F.broadcast(asked) if few else asked, "query_id").select(
        "query_id",
        F.when(F.col("matched") == F.size("tokens"), "exact").otherwise("partial").alias("match_kind"),
        "url",
        "score",
        _matched_tokens().alias("tokens"),
    )


def _matched_tokens() -> Column:
    def of_word(entry: Column) -> Column:
        part = F.slice("tokens", entry["word"] * BITS + 1, F.lit(BITS))
        return F.filter(part, lambda _, place: F.getbit(entry["mask"], place) == 1)

    return F.flatten(F.transform("masks", of_word))


def _salted_hits(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Join for a batch too large to broadcast.

    The postings of a term are cut by URL into parts of about ``SALT_ROWS``, known from the document
    frequency stored with each posting, and the query tokens are repeated once per part.
    """
    parts = F.ceil(F.col("df") / F.lit(SALT_ROWS))
    asked = stage(terms, "query-terms")
    counts = asked.groupBy("term").agg(F.count("*").alias("asked"))
    known = postings.groupBy("term").agg(F.max("df").alias("df"))
    lookup = stage(counts.join(known, "term"), "query-df")
    repeated = lookup_join(asked, lookup, key="term", weight="asked").select(
        "query_id", "position", "term",
        F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("part"),
    )
    cut = postings.withColumn("part", F.pmod(F.xxhash64("url"), parts))
    return cut.join(repeated, ["term", "part"])


def best_first() -> list[Column]:
    """Order of results: score, then URL.

    Scores are compared at nine decimals, so that the order in which a cluster happens to add up
    floating point numbers cannot decide a rank.
    """
    return [F.round("score", 9).desc(), F.col("url").asc()]


def in_order(results: DataFrame) -> DataFrame:
    """Results of all queries, best first inside each query and match kind."""
    return results.orderBy("query_id", "match_kind", *best_first())


def of_kind(results: DataFrame, kind: str) -> DataFrame:
    return results.filter(F.col("match_kind") == kind)


def top_results(results: DataFrame, k: int = FIRST_PAGE) -> DataFrame:
    """The best ``k`` per query and match kind, with ``rank``."""
    return top_k(results, ["query_id", "match_kind"], best_first(), k)


def prompt_view(results: DataFrame) -> DataFrame:
    """What the command line shows: one row more than a first page, score with four decimals."""
    return top_results(results, PROMPT_ROWS).withColumn("shown", F.format_string("%.4f", "score"))


def search_response(
    queries: DataFrame, results: DataFrame, first: int = FIRST_PAGE, more: int = MORE_PAGE
) -> DataFrame:
    """Responses as rows ``(query_id, section, page, entries, note)``.

    Sections ``exact`` and ``partial`` hold the first ``first`` results; ``more_exact`` and
    ``more_partial`` hold all others in order, in pages of ``more``. A query without results has one
    row in section ``message``, an empty query one in section ``error``.
    """
    entry = F.struct(
        "rank", "url", F.format_string("%.4f", "score").alias("score"), "tokens"
    )
    beyond = F.col("rank") > first
    found = stage(results, "results")
    sections = (
        rank_all(found, ["query_id", "match_kind"], best_first())
        .select(
            "query_id",
            F.when(beyond, F.concat(F.lit("more_"), "match_kind"))
            .otherwise(F.col("match_kind")).alias("section"),
            F.when(beyond, F.floor((F.col("rank") - first - 1) / F.lit(more)))
            .otherwise(F.lit(0).cast("bigint")).alias("page"),
            entry.alias("entry"),
        )
        .groupBy("query_id", "section", "page")
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
        .withColumn("note", F.lit(None).cast("string"))
    )
    is_empty = F.trim(F.coalesce("query", F.lit(""))) == ""
    answered = found.select("query_id").distinct()
    notes = queries.join(answered, "query_id", "left_anti").select(
        "query_id",
        F.when(is_empty, "error").otherwise("message").alias("section"),
        F.lit(0).cast("bigint").alias("page"),
        F.lit(None).cast(sections.schema["entries"].dataType).alias("entries"),
        F.when(is_empty, "Empty query").otherwise("No results found").alias("note"),
    )
    return sections.unionByName(notes)


def response_json(responses: DataFrame) -> DataFrame:
    """Each response row as one JSON text."""
    body = F.to_json(F.struct("section", "page", "entries", "note"))
    return responses.select("query_id", "section", "page", body.alias("body"))


def grep_index(postings: DataFrame, needle: str) -> DataFrame:
    """Whole entries (all postings of a term) whose term or any URL contains ``needle``."""
    is_hit = F.col("term").contains(needle) | F.col("url").contains(needle)
    hits = (
        postings.groupBy("term")
        .agg(F.max(is_hit).alias("hit"), F.count("*").alias("entries"))
        .filter("hit")
        .select("term", "entries")
    )
    return lookup_join(postings, stage(hits, "grep"), key="term", weight="entries").drop("entries")
