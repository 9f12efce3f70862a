from collections import Counter

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.functions.text import code_point_bucket, tokens, words
from gleanery.operators import words as jobs

CASES = [
    (None, []),
    ("", []),
    ("!!!", []),
    ("The THE the", ["the", "the", "the"]),
    ('a"b "c"', ["ab", "c"]),
    ("don't x-y", ["don", "t", "x", "y"]),
    ("snake_case [x]^y\\z", ["snake", "case", "x", "y", "z"]),
    ("3.5 v2", ["3", "5", "v2"]),
    ("Über été 日本", ["über", "été", "日本"]),
    ("ét", ["e", "t"]),
]

CORPUS = [("d1", "A a, a a"), ("d10", "a"), ("d2", "a  b")]


def test_tokens(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "i int, text string")
    got = {r["i"]: r["t"] for r in df.select("i", tokens(F.col("text")).alias("t")).collect()}
    assert [got[i] for i in range(len(CASES))] == [expected for _, expected in CASES]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB1é_\"'“”-.<>  \n日 \x1c", max_size=30), min_size=1, max_size=40))
def test_tokens_and_words_against_plain_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for row in df.select("i", tokens(F.col("text")).alias("t"), words(F.col("text")).alias("w")).collect():
        text = texts[row["i"]]
        assert row["t"] == re.findall(r"[^\W_]+", text.lower().replace('"', ""))
        assert row["w"] == text.split()


def test_bucket(spark):
    got = spark.range(1).select(
        code_point_bucket(F.lit("ab"), 3), code_point_bucket(F.lit("日本"), 7)
    ).first()
    assert tuple(got) == ((97 + 98) % 3, (ord("日") + ord("本")) % 7)


def corpus(spark):
    return spark.createDataFrame(CORPUS, "doc_id string, text string")


def test_word_count(spark):
    got = {r["word"]: r["count"] for r in jobs.word_count(corpus(spark)).collect()}
    assert got == {"A": 1, "a,": 1, "a": 4, "b": 1}


def test_invert_words_in_string_order(spark):
    got = {(r["word"], r["block"]): r["doc_ids"] for r in jobs.invert_words(corpus(spark)).collect()}
    assert got[("a", 0)] == "d1,d10,d2"
    assert len(got) == 4


def test_invert_words_keeps_every_document_of_a_hot_word(spark):
    docs = spark.range(500).select(F.concat(F.lit("d"), "id").alias("doc_id"), F.lit("hot hot").alias("text"))
    rows = jobs.invert_words(docs, block_size=50).collect()
    found = [doc for r in rows for doc in r["doc_ids"].split(",")]
    assert [d for r in sorted(rows, key=lambda r: r["block"]) for d in r["doc_ids"].split(",")] == sorted(found)
    assert len(rows) == 10 and sorted(found) == sorted(f"d{i}" for i in range(500))
    assert max(len(r["doc_ids"].split(",")) for r in rows) < 100


def test_invert_words_with_many_rows_per_document(spark):
    docs = spark.createDataFrame([("d", "a b"), ("d", "a c"), ("e", "a")], "doc_id string, text string")
    assert {r["word"]: r["doc_ids"] for r in jobs.invert_words(docs).collect()} == {"a": "d,e", "b": "d", "c": "d"}


def test_sharding_partitions_all_words(spark, tmp_path):
    sharded = jobs.shard_words(corpus(spark), 3)
    jobs.write_sharded(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(tuple(r) for r in back.select("bucket", "word", "count").collect()) == sorted(
        tuple(r) for r in sharded.collect()
    )
    totals = {r["bucket"]: r["occurrences"] for r in jobs.bucket_totals(sharded).collect()}
    assert sum(totals.values()) == 7
    assert jobs.preview(sharded, 2)[0] == 4 and len(jobs.preview(sharded, 2)[1]) == 2


def test_map_reduce_with_expressions_and_with_python(spark):
    docs = spark.range(2000).select(
        F.col("id").cast("string").alias("doc_id"), F.concat(F.lit("x y"), F.col("id") % 3).alias("text")
    )
    mapper = F.transform(words(F.col("text")), lambda w: F.struct(w.alias("key"), F.length(w).cast("bigint").alias("value")))
    exact = jobs.map_reduce(docs, mapper, total=F.sum("value"), docs=F.count_distinct("doc_id"))
    got = {r["key"]: (r["total"], r["docs"]) for r in exact.collect()}
    counts = Counter(w for i in range(2000) for w in ("x", f"y{i % 3}"))
    assert got == {w: (n * len(w), n) for w, n in counts.items()}

    python = jobs.map_reduce_python(docs, mapper, lambda values: values.sum(), "bigint")
    assert {r["key"]: r["value"] for r in python.collect()} == {w: total for w, (total, _) in got.items()}


def test_reduce_steps_keep_null_keys(spark):
    docs = spark.createDataFrame([(None, 2), (None, 3), ("a", 1)], "key string, value long")
    pairs = F.array(F.struct(F.col("key").alias("key"), F.col("value").alias("value")))
    found = jobs.map_reduce_python(docs, pairs, lambda values: values.sum(), "bigint")
    assert {(r.key, r.value) for r in found.collect()} == {(None, 5), ("a", 1)}


def test_map_step_in_python(spark, monkeypatch):
    monkeypatch.setattr(jobs, "PAIRS_PER_BATCH", 3)
    docs = spark.createDataFrame([(1, "b a b"), (2, None), (3, ""), (4, "a " * 10), (5, "c")], "doc_id int, text string")

    def mapper(doc_id, text):
        assert text is None or isinstance(text, str)
        for word in (text or "").split():
            yield word, doc_id

    pairs = jobs.map_python(docs, mapper, "bigint")
    assert sorted((r.key, r.value) for r in pairs.collect()) == sorted([("b", 1), ("a", 1), ("b", 1), ("c", 5), *[("a", 4)] * 10])
    most = jobs.reduce_python(pairs, lambda values: values.max(), "bigint")
    assert sorted((r.key, r.value) for r in most.collect()) == [("a", 4), ("b", 1), ("c", 5)]
    assert jobs.map_python(docs.limit(0), mapper, "bigint").count() == 0
