"""Readers for pages, documents and text files; writers for CSV metrics and URL lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_STORE = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("content", T.StringType()),
    T.StructField("last_scraped", T.TimestampType()),
])


def read_page_store(spark: SparkSession, path: str) -> DataFrame:
    """``(url, content)`` of a page store; other columns are not read."""
    return spark.read.parquet(path).select("url", "content")


def read_documents(spark: SparkSession, path: str, url: str = "doc_id", content: str = "text") -> DataFrame:
    """A document table as a page store: the document id is the URL."""
    return spark.read.parquet(path).select(
        F.col(url).cast("string").alias("url"), F.col(content).alias("content")
    )


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Text files as ``(doc_id, text)``, one row per line, with the file name as document id."""
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("text")
    )


def read_terms(spark: SparkSession, path: str, limit: int = 100) -> DataFrame:
    """``(query_id, query)``: the first ``limit`` lines in file order, trimmed.

    Fewer lines give fewer rows, a blank line is the empty query and repeats are kept.
    """
    line = F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id())
    first = (
        spark.read.text(path)
        .select(line.alias("at"), F.trim("value").alias("query"))
        .orderBy("at")
        .limit(limit)
    )
    # at most ``limit`` rows are left here, so numbering them in one task is fine
    return first.selectExpr("row_number() over (order by at) AS query_id", "query")


def append_csv(df: DataFrame, path: str) -> None:
    """Append rows to a folder of CSV files, each with a header line."""
    df.write.mode("append").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Write a single string column, one value per line."""
    lines.write.mode("overwrite").text(path)
