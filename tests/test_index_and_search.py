import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gleanery.operators import index, search
from gleanery.operators.joins import split_lookup_join, union_all
from gleanery.operators.ranking import rank_all, top_k
from gleanery.sources import index_store
from gleanery.sources.index_store import read_index, write_index
from gleanery.sources.tables import read_documents

PAGES = [("u1", "a a b"), ("u2", "a c"), ("u3", ""), ("u4", "a b"), ("u5", None)][:4]
SF = "/root/testdata/sf0.001"


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "url string, content string")


def asked(spark, *queries):
    return spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")


def brute_postings(rows):
    tf = {u: Counter(re.findall(r"[^\W_]+", (t or "").lower().replace('"', ""))) for u, t in rows}
    df = Counter(term for counts in tf.values() for term in counts)
    return {
        (term, u): n * math.log(len(rows) / (1 + df[term])) for u, counts in tf.items() for term, n in counts.items()
    }


def brute_search(postings, query):
    wanted = set(re.findall(r"[^\W_]+", query.lower().replace('"', "")))
    scores, found = defaultdict(float), defaultdict(set)
    for (term, url), score in postings.items():
        if term in wanted:
            scores[url] += score
            found[url].add(term)
    return {
        url: ("exact" if found[url] == wanted else "partial", round(scores[url], 6), sorted(found[url]))
        for url in scores
    }


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    return write_index(pages(spark), str(tmp_path_factory.mktemp("index") / "small"), shards=3)


def test_scores(spark):
    got = {(r["term"], r["url"]): r["tfidf"] for r in index.build_postings(pages(spark)).collect()}
    assert got == pytest.approx(brute_postings(PAGES))
    assert got[("b", "u1")] == pytest.approx(math.log(4 / 3)) and got[("a", "u1")] == 0


def test_term_in_all_pages_scores_below_zero(spark):
    got = index.build_postings(pages(spark, [("x", "w"), ("y", "w")])).collect()
    assert [r["tfidf"] for r in got] == pytest.approx([math.log(2 / 3)] * 2)


def test_properties_on_documents(spark):
    docs = read_documents(spark, f"{SF}/documents.parquet")
    tf = index.term_frequency(docs)
    total = index.tokenize(docs).agg(F.sum(F.size("tokens"))).first()[0]
    df = index.document_frequency(tf)
    assert tf.agg(F.sum("tf")).first()[0] == total
    assert df.agg(F.max("df")).first()[0] <= docs.count()
    assert tuple(index.index_stats(docs, df).first()) == (docs.count(), df.count())


def test_posting_blocks_hold_each_posting_once(spark):
    rows = [(f"u{i:03d}", "hot" if i % 3 else "hot cold") for i in range(300)]
    postings = index.build_postings(pages(spark, rows))
    blocks = index.inverted_index(postings, block_size=40).collect()
    hot = sorted((r for r in blocks if r["term"] == "hot"), key=lambda r: r["block"])
    assert len(hot) == 8
    assert [p["url"] for r in hot for p in r["postings"]] == [u for u, _ in rows]
    assert all([p["url"] for p in r["postings"]] == sorted(p["url"] for p in r["postings"]) for r in blocks)
    whole = index.inverted_index(postings).collect()
    assert sorted((r["term"], r["block"], len(r["postings"])) for r in whole) == [("cold", 0, 100), ("hot", 0, 300)]


def test_lookup_join_with_heavy_and_light_keys(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"), "id"
    )
    lookup = rows.groupBy("key").agg(F.count("*").alias("n"))
    parts = split_lookup_join(rows, lookup, "key", "n", max_rows=10)
    assert len(parts) == 2
    assert parts[0].select("key").distinct().collect()[0]["key"] == "hot" and parts[0].count() == 400
    assert union_all(parts).select("key", "id", "n").exceptAll(rows.join(lookup, "key").select("key", "id", "n")).isEmpty()
    assert union_all(parts).count() == 1000
    assert len(split_lookup_join(rows, lookup, "key", "n")) == 1


def test_rank_all_equals_a_window_over_the_whole_group(spark):
    rows = spark.range(2000).select(
        F.when(F.col("id") < 1500, 1).otherwise(F.col("id") % 7).alias("q"),
        (F.xxhash64("id") % 100).alias("score"), F.col("id").cast("string").alias("url"),
    )
    order = [F.desc("score"), F.col("url").asc()]
    expected = top_k(rows, ["q"], order, 10_000)
    got = rank_all(rows, ["q"], order, partitions=9)
    columns = ["q", "url", "rank"]
    assert got.count() == 2000
    assert got.select(columns).exceptAll(expected.select(columns)).isEmpty()


@pytest.mark.parametrize("query, exact, partial", [
    ("a b", ["u1", "u4"], ["u2"]),
    ("b b B", ["u1", "u4"], []),
    ("c zzz", [], ["u2"]),
    ("zzz", [], []),
    ("!!!", [], []),
])
def test_ranked_search(spark, small, query, exact, partial):
    rows = search.in_order(search.ranked_search(small, asked(spark, query))).collect()
    assert [r["url"] for r in rows if r["match_kind"] == "exact"] == exact
    assert [r["url"] for r in rows if r["match_kind"] == "partial"] == partial


def test_batch_equals_brute_force_and_single_queries(spark, tmp_path):
    rows = [tuple(r) for r in read_documents(spark, f"{SF}/documents.parquet").collect()]
    saved = write_index(pages(spark, rows), str(tmp_path / "index"))
    queries = ["the", "la que", "is of and", "", "zzz the", rows[3][1]]
    got = defaultdict(dict)
    for r in search.ranked_search(saved, asked(spark, *queries)).collect():
        got[r["query_id"]][r["url"]] = (r["match_kind"], round(r["score"], 6), r["tokens"])
    postings = brute_postings(rows)
    assert len(set(re.findall(r"[^\W_]+", queries[5].lower()))) > search.BITS
    for i, query in enumerate(queries):
        expected = brute_search(postings, query)
        assert got[i].keys() == expected.keys()
        for url, (kind, score, tokens) in expected.items():
            assert got[i][url][0] == kind and got[i][url][2] == tokens
            assert got[i][url][1] == pytest.approx(score, abs=2e-6)


def test_large_batches_are_joined_by_salted_parts(spark, small, monkeypatch):
    queries = asked(spark, "a b", "c", "a")
    expected = search.in_order(search.ranked_search(small, queries)).collect()
    monkeypatch.setattr(search, "MAX_QUERY_TERMS", 1)
    monkeypatch.setattr(search, "SALT_ROWS", 2)
    assert search.in_order(search.ranked_search(small, queries)).collect() == expected


def test_top_prompt_and_response(spark, tmp_path):
    rows = [(f"u{i:02d}", "same word") for i in range(12)] + [("v", "other")]
    saved = write_index(pages(spark, rows), str(tmp_path / "index"))
    queries = asked(spark, "same", " ", "nothing")
    results = search.ranked_search(saved, queries)
    assert [r["url"] for r in search.top_results(results).orderBy("rank").collect()] == [f"u{i:02d}" for i in range(10)]
    assert search.prompt_view(results).count() == 11
    got = {(r["query_id"], r["section"]): r for r in search.search_response(queries, results).collect()}
    assert [e["url"] for e in got[(0, "exact")]["entries"]] == [f"u{i:02d}" for i in range(10)]
    assert [e["url"] for e in got[(0, "more_exact")]["entries"]] == ["u10", "u11"]
    assert got[(1, "error")]["note"] == "Empty query" and got[(2, "message")]["note"] == "No results found"
    assert len(got) == 4
    paged = search.search_response(queries, results, more=1)
    assert {(r["section"], r["page"]) for r in paged.collect() if r["query_id"] == 0} == {
        ("exact", 0), ("more_exact", 0), ("more_exact", 1)
    }
    assert '"section":"error"' in search.response_json(search.search_response(queries, results)).filter(
        "query_id = 1").first()["body"]


def test_grep_returns_whole_entries(spark, small):
    assert {(r["term"], r["url"]) for r in search.grep_index(small.postings(), "u2").collect()} == {
        ("a", "u1"), ("a", "u2"), ("a", "u4"), ("c", "u2")
    }
    assert search.grep_index(small.postings(), "B").isEmpty()


def test_index_is_replaced_only_by_a_complete_one(spark, tmp_path):
    path = str(tmp_path / "index")
    first = write_index(pages(spark), path)
    assert write_index(pages(spark, []), path) is None
    assert read_index(spark, path) == first
    (tmp_path / "index" / "generation=99999999999999999999").mkdir()
    assert read_index(spark, path) == first
    second = write_index(pages(spark, [("n", "new")]), path)
    assert read_index(spark, path) == second
    assert [r["term"] for r in second.postings().collect()] == ["new"]
    with pytest.raises(FileNotFoundError):
        read_index(spark, str(tmp_path / "absent"))


def test_index_of_pages_without_tokens(spark, tmp_path):
    saved = write_index(pages(spark, [("u", "!!!")]), str(tmp_path / "index"))
    assert saved.stats["docs_count"] == 1 and saved.stats["terms_count"] == 0
    assert search.ranked_search(saved, asked(spark, "a")).isEmpty()


def test_lookup_reads_only_matching_shards_and_row_groups(spark, small):
    def found(terms):
        return small.lookup(small.placed(spark.createDataFrame([(t,) for t in terms], "term string")).collect())

    plan = found(["a", "c"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shard" in plan and "PushedFilters: [Or(EqualTo(term,a),EqualTo(term,c))]" in plan
    assert found([]).isEmpty()
    assert found(["a"] + [f"t{i}" for i in range(600)]).count() == 3
    assert found(["a", "it's"]).count() == 3


def test_frequent_terms_fill_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "MIN_POSTINGS_PER_FILE", 10)
    rows = [(f"u{i}", f"hot w{i}") for i in range(400)]
    saved = write_index(pages(spark, rows), str(tmp_path / "index"), shards=2)
    files = saved.postings().filter("term = 'hot'").groupBy("shard", F.input_file_name().alias("f")).count().collect()
    assert sum(r["count"] for r in files) == 400 and len(files) >= 8 and len({r["shard"] for r in files}) == 1
    assert saved.postings().count() == 800 and saved.postings().filter("term = 'w7'").count() == 1


def test_term_frequency_counts_inside_the_row(spark):
    docs = read_documents(spark, f"{SF}/documents.parquet")
    plan = index.term_frequency(docs)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Aggregate" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


@pytest.mark.parametrize("text, counts", [
    ("b a b", [("a", 1), ("b", 2)]), ("one", [("one", 1)]), ("x X x", [("x", 3)]), ("", []), (None, []), ("--- \n", []), ("ab a ab", [("a", 1), ("ab", 2)]),
])
def test_term_counts(spark, text, counts):
    row = spark.createDataFrame([(text,)], "content string").select(index.term_counts(F.col("content")).alias("n")).first()
    assert [tuple(n) for n in row["n"]] == counts


def test_posting_lists_combine_pages_and_keep_equal_urls_apart(spark, tmp_path):
    rows = [("u", "b a b"), ("u", "b"), (None, "a"), ("v", None), ("w", ""), ("x", "\U0001d7d8 É")]
    docs = pages(spark, rows).coalesce(1)
    lists = index.posting_lists(docs, "url", F.lit(0))
    assert lists.agg(F.sum("n")).first()[0] == 6
    many = pages(spark, [(f"u{i:05d}", "one two") for i in range(20_000)])
    assert index.posting_lists(many, "url", F.lit(0)).count() <= 200
    cut = index.cut_lists(index.posting_lists(many, "url", F.lit(0)), 7)
    assert cut.agg(F.max(F.size("members")), F.sum(F.size("counts"))).first() == (7, 40_000)
    wanted = sorted([("a", "u", 1), ("a", "", 1), ("b", "u", 2), ("b", "u", 1), ("é", "x", 1), ("\U0001d7d8", "x", 1)])
    for got in (index.build_postings(docs), write_index(docs, str(tmp_path / "index")).postings()):
        assert sorted((r["term"], r["url"] or "", r["tf"]) for r in got.collect()) == wanted


def test_lists_are_grouped_by_block(spark):
    rows = spark.createDataFrame([(3, 1, "a b"), (1, 0, "a"), (2, 1, "a a")], "place int, block int, content string").coalesce(1)
    got = index.posting_lists(rows, "place", F.col("block")).select("term", "block", F.arrays_zip("members", "counts").alias("p"))
    found = sorted((r["term"], r["block"], *p) for r in got.collect() for p in r["p"])
    assert found == [("a", 0, 1, 1), ("a", 1, 2, 2), ("a", 1, 3, 1), ("b", 1, 3, 1)]
    assert len({(t, b) for t, b, *_ in found}) == 3
