"""From raw documents to packed training sequences, in five stages of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import mixing, packing, partenum, quality_knn, secret_scan
from gleanery.llm.common import checked, free_name, short_batches, staged_count
from gleanery.llm.queries import table, tokenizer
from gleanery.session import stage

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts, with all their columns, whatever their names.

    A null text is judged as an empty one; repeated rows are judged alike, and all or none of them stay. Rows go to
    Python in short batches with their text once, so they are written here.
    """
    model = quality_knn.train(docs, table(spark, sf_dir, "labels"))
    row = free_name(docs, "row")
    is_text = [c.lower() == "text" for c in docs.columns]
    beside = F.struct(*[c for c, text in zip(docs.columns, is_text) if not text])
    scored = quality_knn.scored(docs.select("text", beside.alias(row)), model)
    columns = [F.col("text").alias(c) if text else F.col(row)[c].alias(c) for c, text in zip(docs.columns, is_text)]
    with short_batches(spark):
        return stage(scored.where("predicted = 1").select(*columns), "quality")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of least doc_id of each group of near-duplicate texts; rows without doc_id stay.

    A doc_id may recur with different texts: each of them is a node of its own. Of rows equal in doc_id and text one
    stays, any of them. Null and empty texts are near nothing; each such doc_id stays. Columns may have any names.
    """
    name = free_name(docs, "_row")
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    keyed = docs.withColumn(name, key)
    found = partenum.jaccard_components(keyed.select(F.col(name).alias("doc_id"), "text")).where("doc_id is not null")
    ids = found.groupBy(F.col("doc_id").alias("_row")).agg(F.min("component_id").alias("component_id"), F.count("*").alias("n"))
    names = keyed.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("_row")).agg(F.min(F.col("doc_id").cast("long")).alias("doc_id"))
    ids = stage(ids.join(names, "_row"), "near-duplicates")
    least = ids.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row")).alias("least")).select(F.col("least._row").alias("_row"))
    gone, n_gone = staged_count(ids.join(least, "_row", "left_anti").select("_row"), "gone")
    often, n_often = staged_count(ids.where("n > 1").join(gone, "_row", "left_anti").select("_row"), "repeated")
    kept = keyed.join(checked(gone.withColumnRenamed("_row", name), n_gone, 16), name, "left_anti")
    if not n_often:
        return kept.select(*docs.columns)
    repeated = checked(often.withColumnRenamed("_row", name), n_often, 16)
    once = kept.join(repeated, name, "left_semi").dropDuplicates([name])
    return kept.join(repeated, name, "left_anti").select(*docs.columns).unionAll(once.select(*docs.columns))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets replaced by a mark; rows without text, repeated rows and other columns as in ``redacted``."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of the documents, as documents; rows without words give none, see ``mixed_documents``."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their places in sequences; a null or empty text is its end mark alone."""
    return packing.pack_documents(docs, tokenizer())


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram jaccard join", one_of_each_group),
    ("secret scans", redact_secrets),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage keeps is written once for the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if step is not keep_quality and number < len(STAGES) - 1:  # that one has written its rows
            docs = stage(docs, f"pipeline-{number}")
    return docs
