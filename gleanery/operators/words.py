"""Word count, word to documents, word buckets, and the general map and reduce step."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import code_point_bucket, words
from gleanery.operators.index import in_blocks
from gleanery.operators.joins import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, lookup_join
from gleanery.session import stage

DOCS_PER_BLOCK = 10_000
SALTS = 256
PAIRS_PER_BATCH = 10_000


def map_reduce(docs: DataFrame, mapper: Column, /, **reducers: Column) -> DataFrame:
    """``mapper`` gives an array of keys, or of ``struct(key, value)``, per document.

    ``reducers`` are aggregate expressions over ``key``, ``value`` and ``doc_id``; Spark combines them
    before the exchange.
    """
    pairs = docs.select("doc_id", F.explode(mapper).alias("pair"))
    if pairs.schema["pair"].dataType.typeName() == "struct":
        pairs = pairs.select("doc_id", "pair.key", "pair.value")
    else:
        pairs = pairs.select("doc_id", F.col("pair").alias("key"), F.lit(1).alias("value"))
    return pairs.groupBy("key").agg(*[column.alias(name) for name, column in reducers.items()])


def map_reduce_python(
    docs: DataFrame, mapper: Column, combine: Callable[[pd.Series], object], value_type: str
) -> DataFrame:
    """Like :func:`map_reduce` with a Python reduce step over ``struct(key, value)`` pairs.

    ``combine`` turns a series of values into one value of the same kind and must not depend on
    order or grouping. Values are combined per Arrow batch before the exchange and once more per
    slice of a key after it, so the last step sees only a few values even of a very frequent key.
    """
    pairs = docs.select(F.explode(mapper).alias("pair")).select("pair.key", "pair.value")
    return reduce_python(pairs, combine, value_type)


def map_python(
    docs: DataFrame, mapper: Callable[[object, str | None], Iterable[tuple[str, object]]], value_type: str
) -> DataFrame:
    """``(key, value)`` pairs that ``mapper(doc_id, text)`` yields for every document, a map step in Python.

    Documents go to Python in Arrow batches and pairs come back in batches, so neither the pairs of a task nor those of a long
    text are held at once. Null texts are passed on as ``None``; a document may yield nothing.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = (None if text is None or text != text else text for text in batch["text"])
            pairs = (pair for doc_id, text in zip(batch["doc_id"], texts) for pair in mapper(doc_id, text))
            while some := list(islice(pairs, PAIRS_PER_BATCH)):
                yield pd.DataFrame(some, columns=["key", "value"])

    return docs.select("doc_id", "text").mapInPandas(run, f"key string, value {value_type}")


def reduce_python(pairs: DataFrame, combine: Callable[[pd.Series], object], value_type: str) -> DataFrame:
    """The Python reduce step of :func:`map_reduce_python` over rows ``(key, value)``."""
    schema = f"key string, value {value_type}"

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = batch.groupby("key", dropna=False, sort=False)["value"].agg(combine)
            keys = [None if key is None or key != key else key for key in found.index]
            yield pd.DataFrame({"key": pd.Series(keys, dtype=object), "value": found.to_numpy()})

    def final(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": group["key"].iloc[:1], "value": [combine(group["value"])]})

    slices = pairs.mapInPandas(partial, schema).repartition(
        "key", F.pmod(F.spark_partition_id(), F.lit(SALTS))
    )
    return slices.mapInPandas(partial, schema).groupBy("key").applyInPandas(final, schema)


def word_count(docs: DataFrame) -> DataFrame:
    """``(word, count)`` of white-space separated words."""
    return map_reduce(docs, words(F.col("text")), count=F.count("*")).withColumnRenamed("key", "word")


def invert_words(docs: DataFrame, block_size: int = DOCS_PER_BLOCK) -> DataFrame:
    """``(word, block, doc_ids)``: distinct documents of each word, sorted and joined by commas.

    A word in up to ``block_size`` documents has a single block 0; more frequent ones continue in
    further blocks. A document may have many rows, as a file of lines has. Pairs are first made
    distinct per row; grouped afterwards, very frequent words go by block, all others by word. Blocks are
    consecutive: put after one another they are the sorted list.
    """
    pairs = stage(_distinct_pairs(docs), "word-docs")
    sizes = stage(pairs.groupBy("word").agg(F.count("*").alias("docs")), "word-sizes")
    placed = in_blocks(lookup_join(pairs, sizes, key="word", weight="docs"), "word", "doc_id", "docs", block_size)
    return placed.groupBy("word", "block").agg(
        F.array_join(F.sort_array(F.collect_list("doc_id")), ",").alias("doc_ids")
    )


def _distinct_pairs(docs: DataFrame) -> DataFrame:
    """``(doc_id, word)`` of each document once; ``docs`` is read twice.

    Words are made distinct inside a row. Only pairs of documents with several rows can still be equal, so
    those of all others are in no exchange.
    """
    pairs = docs.select("doc_id", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    several = stage(docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("again")), "repeated-docs")
    n, size = several.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col("again").cast("string"))), F.lit(0))).first()
    if not n:
        return pairs
    if n > MAX_BROADCAST_ROWS or size > MAX_BROADCAST_BYTES:
        return pairs.distinct()
    same = F.col("doc_id").eqNullSafe(F.col("again"))
    repeated = pairs.join(F.broadcast(several), same, "left_semi").distinct()
    return pairs.join(F.broadcast(several), same, "left_anti").unionByName(repeated)


def shard_words(docs: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, word, count)``: the reducer bucket of every word."""
    counts = word_count(docs)
    return counts.select(code_point_bucket(F.col("word"), buckets).alias("bucket"), "word", "count")


def bucket_totals(sharded: DataFrame) -> DataFrame:
    """``(bucket, words, occurrences)``."""
    return sharded.groupBy("bucket").agg(
        F.count("*").alias("words"), F.sum("count").alias("occurrences")
    )


def write_sharded(sharded: DataFrame, path: str) -> None:
    """One folder per bucket; a large bucket may fill several files."""
    sharded.write.mode("overwrite").partitionBy("bucket").parquet(path)


def preview(result: DataFrame, rows: int = 5) -> tuple[int, list]:
    """Row count and a few rows of a job's output."""
    return result.count(), result.limit(rows).collect()
