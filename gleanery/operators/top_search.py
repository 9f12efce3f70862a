"""The best results of each query without reading what can't be among them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.operators.joins import union_all
from gleanery.operators.search import FIRST_PAGE, MAX_QUERY_BYTES, MAX_QUERY_TERMS, best_first, query_tokens
from gleanery.operators.ranking import top_k
from gleanery.session import stage
from gleanery.sources.banded_index import BandedIndex

FIRST = 200_000  # postings that a query reads before it has a bar; a round of fewer costs more than it may spare
SLACK = 1e-6  # scores are compared at nine decimals


def top_search(index: BandedIndex, queries: DataFrame, k: int = FIRST_PAGE, first: int = FIRST) -> DataFrame:
    """``(query_id, match_kind, url, score, tokens, rank)``: the best ``k`` pages per query and match kind.

    The result is that of ranking all pages. Every query first reads the bands in which it can score highest, about ``first`` postings. The k-th best
    score there is a bar, and of the other bands only those are read whose bound reaches it: the sum of the greatest scores
    of the query's terms in the band. They are read in order of bound, in rounds of four times as many bands, as the bar rises.
    A kind of match that has fewer than ``k`` results keeps the bar open, unless the query can have none of it in a band.
    Rare terms have no stored maxima; they are read first.

    A batch whose tokens are too many for a plan is answered from all postings.
    """
    asked = stage(query_tokens(queries), "asked")
    terms = index.hashed(asked.select("query_id", F.size("tokens").alias("n"), F.explode("tokens").alias("term")))
    size = terms.agg(F.count("*"), F.sum(F.octet_length("term") + F.octet_length(F.col("query_id").cast("string")))).first()
    if size[0] > MAX_QUERY_TERMS or (size[1] or 0) > MAX_QUERY_BYTES:
        return _best(_scored(index.postings(), terms.select("query_id", "n", "term")), k)
    terms = F.broadcast(stage(terms, "terms"))

    known = stage(index.maxima([r["term"] for r in terms.select("term").distinct().collect()]), "maxima")
    rare = terms.join(known.select("term").distinct(), "term", "left_anti").select("term", "hash").distinct()
    rare_rows = rare.withColumn("band", F.lit(None).cast("int")).collect()
    rare_hits = stage(index.lookup(rare_rows).select("term", "url", "tfidf", "band"), "rare")
    maxima = known.unionByName(rare_hits.groupBy("term", "band").agg(F.max("tfidf").alias("most"), F.count("*").alias("postings")))

    # What a query can reach in a band, and whether a page there can have all its tokens.
    bounds = terms.join(maxima, "term").groupBy("query_id", "band").agg(
        F.sum(F.greatest("most", F.lit(0.0))).alias("bound"), F.sum("postings").alias("postings"), (F.count("*") == F.max("n")).alias("whole"),
        F.min(F.greatest("most", F.lit(0.0))).alias("least"),
    )
    # A partial match lacks a token.
    bounds = bounds.withColumn("in_part", F.col("bound") - F.when(F.col("whole"), F.col("least")).otherwise(0.0)).drop("least")
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), F.asc("band"))
    before = F.coalesce(F.sum("postings").over(by_bound.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bounds = bounds.withColumn("first", before < F.lit(first)).withColumn("place", F.row_number().over(by_bound))
    bounds = stage(bounds, "bounds")

    def read(chosen: DataFrame) -> DataFrame:
        """Scores of all pages of the chosen (query_id, band)."""
        wanted = stage(terms.join(F.broadcast(chosen.select("query_id", "band")), "query_id"), "wanted")
        often = wanted.join(F.broadcast(rare), "term", "left_anti").select("term", "hash", "band").distinct().collect()
        hits = union_all([index.lookup(often).select("term", "url", "tfidf", "band"), rare_hits])
        return _scored(hits, F.broadcast(wanted.drop("hash")), "band")

    # A single token leaves no partial matches; a page can only have all tokens in a band that has all of them.
    never = F.lit(float("inf"))
    n_tokens = asked.select("query_id", F.size("tokens").alias("n"))
    found = stage(read(bounds.filter("first")), "results")
    left, step = bounds.filter("not first"), 1
    while True:
        best = _best(found, k)
        if left.isEmpty():
            return best
        bars = best.filter(F.col("rank") == k).groupBy("query_id").pivot("match_kind", ["exact", "partial"]).agg(F.min("score"))
        reach = left.join(n_tokens, "query_id").join(bars, "query_id", "left")
        exact = F.col("whole") & (F.col("bound") >= F.coalesce("exact", -never) - F.lit(SLACK))
        partial = (F.col("n") > 1) & (F.col("in_part") >= F.coalesce("partial", -never) - F.lit(SLACK))
        needed = reach.filter(exact | partial).select(*bounds.columns)
        left = stage(needed, "other-bands")
        # The next bands of each query, four times as many as in the round before; the bar may spare it the rest.
        start = left.groupBy("query_id").agg(F.min("place").alias("start"))
        left = stage(left.join(start, "query_id").withColumn("now", F.col("place") < F.col("start") + F.lit(step)).drop("start"), "next-bands")
        now, left, step = left.filter("now"), left.filter("not now").drop("now"), 4 * step
        if now.isEmpty():
            return best
        found = union_all([stage(best.drop("rank"), "best"), stage(read(now), "results")])


def _scored(hits: DataFrame, terms: DataFrame, *also: str) -> DataFrame:
    found = hits.join(terms, ["term", *also]).groupBy("query_id", "url").agg(
        F.sum("tfidf").alias("score"), F.max("n").alias("n"), F.sort_array(F.collect_list("term")).alias("tokens")
    )
    kind = F.when(F.size("tokens") == F.col("n"), "exact").otherwise("partial")
    return found.select("query_id", kind.alias("match_kind"), "url", "score", "tokens")


def _best(found: DataFrame, k: int) -> DataFrame:
    return top_k(found, ["query_id", "match_kind"], best_first(), k)
