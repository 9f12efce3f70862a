"""Registered queries of the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import alignment, mixing, negatives, packing, partenum, quality_knn, quality_rules, repeats, secret_scan, topk, toxicity, url_rules, vantage
from gleanery.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer() -> str:
    """Path of the byte-level vocabulary: the installed one, or ``GLEANERY_TOKENIZER``."""
    import public_tokenizers

    return os.environ.get("GLEANERY_TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")


def pieces() -> str:
    """Path of the piece vocabulary: the installed one, or ``GLEANERY_PIECES``."""
    import public_tokenizers

    return os.environ.get("GLEANERY_PIECES") or public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").withColumn("row_id", F.lit(0).cast("long"))
    found = secret_scan.report(secret_scan.secret_spans(rows))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov")


def op2_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    rows = mixing.taken(mixing.mix_sources(table(spark, sf, "documents")))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op3_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality_knn.train(docs, table(spark, sf, "labels"))
    found = quality_knn.scored(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


# The rules to apply.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op4_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_rules.apply_rules(table(spark, sf, "pages"), rules)


def op5_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = repeats.without_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    found = topk.nearest(vectors, vectors.where("vec_id % 100 = 0"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept")


def op8_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer())


def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return partenum.jaccard_components(table(spark, sf, "documents"))


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    found = toxicity.scored(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return vantage.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.aligned(table(spark, sf, "documents"), tokenizer(), pieces())


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return negatives.hard_negatives(rows, rows.where("vec_id % 100 = 0"))


def registered() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
