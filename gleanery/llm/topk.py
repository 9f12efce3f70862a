"""Exact top-k by inner product, by aggregation over sorted lists without random access.

Candidates are dealt to blocks. A block has one list per dimension, sorted by component. For a query the lists
are read in step, from the end that is good for it, each time on to the end of equal values. What has been read of a
vector gives a lower bound and, with the last values read, an upper bound of its score. Reading stops when no vector
outside the best k can reach them; the scores of those that still could are then resolved. The best of all blocks are
merged. The queries that visit a block read its lists together, so the bounds of all of them are two products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import short_batches
from gleanery.llm.vectors import blocks_of, matrix, meetings
from gleanery.operators.ranking import top_k
from gleanery.session import stage

K = 10
BLOCK = 2048  # candidates
FIRST_DEPTH = 64
EXACT = 2**53  # whole numbers below it are exact in double precision


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, or null if the vector is null or not wholly finite numbers."""
    real = F.transform(vector, lambda x: x.cast("double"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = vector.isNotNull() & F.forall(real, finite)
    return F.when(good, F.transform(real, lambda x: F.floor(x * scale)))


def _read_lists(values: np.ndarray, ids: np.ndarray, asked: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The best ``k`` of a block for each query, as (number of the query, places, scores)."""
    rows, width = values.shape
    largest = [float(np.abs(x.astype(float)).max(initial=0)) for x in (values, asked)]
    if width * largest[0] * largest[1] < EXACT:
        values, asked = values.astype(float), asked.astype(float)
    lowest = -np.inf if values.dtype == float else np.iinfo(np.int64).min
    lists = np.sort(values, axis=0)
    # A list is read from its end for a positive weight, from its start for a negative one.
    weights = np.concatenate([np.maximum(asked, 0), np.minimum(asked, 0)], axis=1)
    pending, depth = np.arange(len(asked)), min(FIRST_DEPTH, rows)
    while len(pending):
        high, low = lists[rows - depth], lists[depth - 1]
        # What is unread of a vector is at least the list's least value, and at most the last value read.
        known = np.concatenate([np.where(values >= high, values, lists[0]), np.where(values <= low, values, lists[-1])], axis=1)
        least = weights[pending] @ known.T
        most = weights[pending] @ np.concatenate([np.maximum(values, high), np.minimum(values, low)], axis=1).T
        others = ids != own[pending, None]
        least[~others] = lowest
        bar = np.partition(least, rows - k, axis=1)[:, rows - k] if rows > k else np.full(len(pending), lowest)
        alive = others & (most >= bar[:, None])
        left = alive.sum(axis=1)
        ended = (left <= max(k, depth // 4)) | (depth == rows)
        for q in np.flatnonzero(ended).tolist():
            at = np.flatnonzero(alive[q])
            scores = values[at] @ asked[pending[q]]
            best = np.lexsort((ids[at], -scores))[:k]
            yield int(pending[q]), at[best], scores[best].astype(np.int64)
        pending, depth = pending[~ended], min(rows, 3 * depth)


def _visit(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, asked in zip(batch.column("rows"), batch.column("asked")):
                rows, asked = rows.values, asked.values
                width = max(matrix(x.field("vector"), kind=np.int64).shape[1] for x in (rows, asked))
                values, wanted = (matrix(x.field("vector"), width, np.int64) for x in (rows, asked))
                ids, own = rows.field("vec_id").to_numpy(), asked.field("query_id").to_numpy()
                found = list(_read_lists(values, ids, wanted, own, k))
                queries = np.repeat(own[[q for q, _, _ in found]], [len(at) for _, at, _ in found])
                columns = queries, np.concatenate([ids[at] for _, at, _ in found]), np.concatenate([x for _, _, x in found])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = 1024, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query its ``k`` best vectors but itself.

    Both tables have ``vec_id`` and ``embedding``; components become floor(scale * x) and scores are whole numbers.
    Ties go to the smaller vec_id. Vectors that are null, without vec_id, or hold null or non-finite components take
    no part; missing components of shorter vectors count as 0. A query with fewer candidates gets all. Rows
    with equal vec_id are candidates one by one, but never for a query of that vec_id; of queries with equal vec_id
    the least vector asks.

    Blocks of candidates meet batches of queries, so neither side is broadcast and a task holds one of each.
    """

    def whole(df: DataFrame) -> DataFrame:
        usable = df.select(F.col("vec_id").cast("long"), quantised(F.col("embedding"), scale).alias("vector"))
        return usable.where("vector is not null and vec_id is not null")

    candidates = stage(whole(vectors).withColumn("row", F.monotonically_increasing_id()), "candidates")
    blocks, count = blocks_of(candidates, ["vec_id", "vector"], candidates.count(), block, "blocks")
    asked = stage(whole(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector")), "queries")
    everywhere = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    with short_batches(vectors.sparkSession, 4):
        met = meetings(blocks, everywhere, "block", ["query_id", "vector"])
        found = met.mapInArrow(_visit(k), "query_id long, vec_id long, score long")
        best = stage(top_k(found, ["query_id"], [F.desc("score"), F.asc("vec_id")], k), "nearest")
    return best
