"""Approximate nearest neighbours by inner product with vantage-point trees.

A small tree over a bounded sample deals all rows to shards, which are regions; each shard, cut to pieces of bounded size,
is a vantage-point tree of its own. Vectors get one more component that makes them equally long, so that the order by inner
product is that by distance and the triangle inequality holds. A part of a tree is skipped when its distance from the query
times ``stretch`` exceeds the distance of the k-th best found: 1 skips only what can't hold a better one, more skips more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import short_batches
from gleanery.llm.vectors import best_of_each, finite, gathered, matrix, meetings
from gleanery.operators.joins import union_all
from gleanery.operators.ranking import top_k
from gleanery.session import MAX_PARTITIONS, stage

K = 20
STRETCH = 5.0
LEAF = 256
PIECE = 16_384  # rows of a tree
PIECE_BYTES = 16 << 20
SAMPLE = 16_384  # rows that the shards are fitted on
SAMPLE_BYTES = 16 << 20
SAMPLED_LEAF = 16  # sampled rows of a shard at least
SLACK = 1e-6  # of the longest vector, against rounding
NONE = np.iinfo(np.int64).max

INDEX = "shard int, ids array<bigint>, vectors array<double>, radius array<double>"
FOUND = "query_id long, vec_id long, score double"


class Space:
    """Vectors as points of equal length: the last coordinate fills up to ``longest``."""

    def __init__(self, vectors: np.ndarray, longest: float) -> None:
        self.vectors, self.longest = vectors, longest
        self.last = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))

    def between(self, at: int | np.ndarray, other: int) -> np.ndarray:
        """Distances of some points from one of them."""
        gap = self.vectors[at] - self.vectors[other]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap) + (self.last[at] - self.last[other]) ** 2)


class Asked:
    """Queries as points of that space: scaled to the greatest length, with a last coordinate of 0."""

    def __init__(self, vectors: np.ndarray, longest: float) -> None:
        self.vectors, self.longest = vectors, longest
        self.length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.scale = longest / np.where(self.length > 0, self.length, np.inf)

    def distance(self, who: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Of a vector with that product; without a product, or a direction of the query, nothing is far."""
        known = np.isfinite(score) & (self.length[who] > 0)
        gap = 2 * self.longest**2 - 2 * self.scale[who] * np.where(known, score, 0)
        return np.where(known, np.sqrt(np.maximum(gap, 0)), np.inf)


def _split(space: Space, members: np.ndarray) -> tuple[np.ndarray, float, int]:
    """Members with a vantage point first, then those inside its radius, which are half of them, then the others."""
    far = members[np.argmax(space.between(members, members[0]))]
    rest = members[members != far]
    gap = space.between(rest, far)
    half = len(rest) // 2
    order = np.argpartition(gap, half) if half < len(rest) else np.arange(len(rest))
    radius = float(gap[order[:half]].max(initial=0.0))
    return np.concatenate([[far], rest[order]]), radius, half


class Shards:
    """The tree over the sample: which shard a vector lies in, and which shards may hold a query's neighbours."""

    def __init__(self, sample: np.ndarray, longest: float, shards: int) -> None:
        self.longest, self.depth = longest, 0
        most = max(1, min(shards, len(sample) // SAMPLED_LEAF))
        self.depth = int(math.log2(most))
        self.vantage = np.zeros((2**self.depth, sample.shape[1]))
        self.last, self.radius = np.zeros(2**self.depth), np.zeros(2**self.depth)
        space, parts = Space(sample, longest), {1: np.arange(len(sample))}
        for node in range(1, 2**self.depth):
            order, radius, half = _split(space, parts.pop(node))
            self.vantage[node], self.last[node], self.radius[node] = sample[order[0]], space.last[order[0]], radius
            parts[2 * node], parts[2 * node + 1] = order[1 : half + 1], order[half + 1 :]

    def __len__(self) -> int:
        return 2**self.depth

    def _gap(self, vectors: np.ndarray, last: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Distance from the node's vantage point beyond its radius."""
        gap = vectors - self.vantage[node]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap) + (last - self.last[node]) ** 2) - self.radius[node]

    def home(self, vectors: np.ndarray, last: np.ndarray) -> np.ndarray:
        node = np.ones(len(vectors), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (self._gap(vectors, last, node) > 0)
        return node - len(self)

    def reached(self, asked: Asked, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and a shard that no vantage point shows to be farther away than ``bound``."""
        who, node = np.arange(len(bound)), np.ones(len(bound), np.int64)
        points, slack = asked.vectors * asked.scale[:, None], SLACK * self.longest
        for _ in range(self.depth):
            gap = self._gap(points[who], np.zeros(len(who)), node)
            inside, outside = gap <= bound[who] + slack, -gap <= bound[who] + slack
            who, node = np.concatenate([who[inside], who[outside]]), np.concatenate([2 * node[inside], 2 * node[outside] + 1])
        return who, node - len(self)


def _tree(vectors: np.ndarray, longest: float, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows and radius of each vantage point: a part is its vantage point, the inner half and the outer."""
    space, order, radius = Space(vectors, longest), np.arange(len(vectors)), np.zeros(len(vectors))
    parts = [(0, len(order))]
    while parts:
        low, high = parts.pop()
        if high - low > leaf:
            order[low:high], radius[low], half = _split(space, order[low:high])
            parts += [(low + 1, low + 1 + half), (low + 1 + half, high)]
    return order, radius


def _middle(low: int, high: int) -> int:
    """Where the outer half of a part begins."""
    return low + 1 + (high - low - 1) // 2


class Search:
    """The best ``k`` of one tree for a batch of queries."""

    def __init__(self, ids, vectors, radius, asked: Asked, own: np.ndarray, bar: np.ndarray, k: int, stretch: float, leaf: int) -> None:
        self.ids, self.space, self.radius = ids, Space(vectors, asked.longest), radius
        self.asked, self.own, self.k, self.stretch, self.leaf = asked, own, k, stretch, leaf
        self.bar = bar.copy()
        self.slack = 1e-9 * asked.longest * asked.length
        self.score, self.found = np.full((len(own), k), -np.inf), np.full((len(own), k), NONE)

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.ids):
            self._descend(0, len(self.ids), np.flatnonzero(~np.isfinite(self.bar)))
            self._visit(0, len(self.ids), np.arange(len(self.own)))
        who, place = np.nonzero(self.found != NONE)
        return who, self.found[who, place], self.score[who, place]

    def _gap(self, low: int, who: np.ndarray) -> np.ndarray:
        """Distance from a vantage point beyond its radius."""
        points = self.asked.vectors[who] * self.asked.scale[who, None] - self.space.vectors[low]
        return np.sqrt(np.einsum("ij,ij->i", points, points) + self.space.last[low] ** 2) - self.radius[low]

    def _descend(self, low: int, high: int, who: np.ndarray) -> None:
        """A first bar for queries without one: the k-th best of the leaf that they lie in."""
        if high - low > self.leaf:
            inside, middle = self._gap(low, who) <= 0, _middle(low, high)
            for part, some in (((low + 1, middle), who[inside]), ((middle, high), who[~inside])):
                if len(some):
                    self._descend(*part, some)
        elif high - low >= self.k:
            score = self.asked.vectors[who] @ self.space.vectors[low:high].T
            score[self.ids[None, low:high] == self.own[who, None]] = -np.inf
            self.bar[who] = np.partition(score, -self.k, axis=1)[:, -self.k] - self.slack[who]

    def _visit(self, low: int, high: int, who: np.ndarray) -> None:
        if not len(who) or low >= high:
            return
        if high - low <= self.leaf:
            self._compare(low, high, who)
            return
        self._compare(low, low + 1, who)
        gap, middle = self._gap(low, who), _middle(low, high)
        self._visit(low + 1, middle, who[gap <= self._reach(who)])
        self._visit(middle, high, who[-gap <= self._reach(who)])

    def _reach(self, who: np.ndarray) -> np.ndarray:
        return self.asked.distance(who, self.bar[who]) / self.stretch + SLACK * self.asked.longest

    def _compare(self, low: int, high: int, who: np.ndarray) -> None:
        near = self.asked.vectors[who] @ self.space.vectors[low:high].T >= (self.bar - self.slack)[who, None]
        near &= self.ids[None, low:high] != self.own[who, None]
        q, x = np.nonzero(near)
        if not len(q):
            return
        # Products of a whole matrix may differ in the last digits; what is returned doesn't depend on a row's place.
        score = np.einsum("ij,ij->i", self.asked.vectors[who[q]], self.space.vectors[low + x])
        touched = who[np.unique(q)]
        group = np.concatenate([who[q], np.repeat(touched, self.k)])
        score = np.concatenate([score, self.score[touched].ravel()])
        ids = np.concatenate([self.ids[low + x], self.found[touched].ravel()])
        best, place = best_of_each(group, score, ids, self.k)
        self.score[group[best], place], self.found[group[best], place] = score[best], ids[best]
        self.bar[touched] = np.maximum(self.bar[touched], self.score[touched, -1])


def usable(vectors: DataFrame, label: str) -> DataFrame:
    """Staged ``(row, vec_id, vector)`` of the rows that take part."""
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    whole = whole.where(F.col("vec_id").isNotNull() & finite(F.col("vector"))).where(F.exists("vector", lambda x: x != 0))
    return stage(whole.withColumn("row", F.monotonically_increasing_id()), label)


def _length(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))


def _dealt(shared, longest: float, query: bool):
    """Adds the shard of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = shared.value
        for batch in batches:
            vectors = matrix(batch.column("vector"), shards.vantage.shape[1])
            if query:
                shard = shards.home(vectors * Asked(vectors, longest).scale[:, None], np.zeros(len(vectors)))
            else:
                shard = shards.home(vectors, Space(vectors, longest).last)
            yield batch.append_column("shard", pa.array(shard.astype(np.int32)))

    return run


def _reached(shared, longest: float, stretch: float):
    """The shards other than its own that a query still has to visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            asked = Asked(matrix(batch.column("vector"), shards.vantage.shape[1]), longest)
            bar = batch.column("bar").to_numpy(zero_copy_only=False)
            who, shard = shards.reached(asked, asked.distance(np.arange(len(bar)), bar) / stretch)
            other = shard != batch.column("shard").to_numpy()[who]
            out = batch.drop_columns(["shard"]).take(pa.array(who[other]))
            yield out.append_column("shard", pa.array(shard[other].astype(np.int32)))

    return run


def _planted(width: int, longest: float, leaf: int):
    schema = pa.schema([("shard", pa.int32()), ("ids", pa.list_(pa.int64())), ("vectors", pa.list_(pa.float64())), ("radius", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, rows in zip(batch.column("shard").to_pylist(), batch.column("rows")):
                ids, vectors = rows.values.field("vec_id").to_numpy(), matrix(rows.values.field("vector"), width)
                first = np.argsort(ids, kind="stable")
                order, radius = _tree(vectors[first], longest, leaf)
                order = first[order]
                lists = [pa.array([x], pa.list_(t)) for x, t in ((ids[order], pa.int64()), (vectors[order].ravel(), pa.float64()), (radius, pa.float64()))]
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *lists], schema=schema)

    return run


def _searched(width: int, longest: float, k: int, stretch: float, leaf: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors, radius, asked in zip(*(batch.column(c) for c in ("ids", "vectors", "radius", "asked"))):
                ids, radius, asked = ids.values.to_numpy(), radius.values.to_numpy(), asked.values
                tree = vectors.values.to_numpy().reshape(len(ids), width)
                own = asked.field("query_id").to_numpy()
                queries = matrix(asked.field("vector"), width)
                bar = asked.field("bar").to_numpy(zero_copy_only=False)
                search = Search(ids, tree, radius, Asked(queries, longest), own, bar, k, stretch, leaf)
                who, found, score = search.run()
                yield pa.RecordBatch.from_arrays([pa.array(own[who]), pa.array(found), pa.array(score)], schema=schema)

    return run


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = K, stretch: float = STRETCH, piece: int = PIECE, leaf: int = LEAF, sample: int = SAMPLE
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query about its ``k`` nearest vectors but itself, nearest first.

    Both tables have ``vec_id`` and ``embedding``; nearness is the inner product in double precision. Ties go to the smaller
    vec_id. ``stretch`` 1 gives the exact answer; the default is approximate, and what is returned is ranked by true scores.
    Rows without vec_id, and vectors that are null, zero or hold null or non-finite components take no part; missing components
    of shorter vectors count as 0. A query with fewer candidates gets all. Rows with equal vec_id are candidates one by one, but
    never for a query of that vec_id; of queries with equal vec_id the one of least vector counts. Other columns are ignored.

    The shards are fitted on at most ``sample`` rows, drawn by hash; every row is dealt to one. A query first visits its own
    shard; the k-th best there bounds what it needs from the others.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, "vectors")
    count, width, longest = rows.agg(F.count("*"), F.max(F.size("vector")), F.max(_length(F.col("vector")))).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    piece = max(1, min(piece, PIECE_BYTES // (8 * width)))
    sample = max(1, min(sample, SAMPLE_BYTES // (8 * width)))
    share = 1 << 30
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(share)) < F.lit(math.ceil(share * min(1.0, sample / count)))).select("vector").limit(sample)
    fitted = np.zeros((0, width))
    if count > piece:
        fitted = matrix(pa.array([r[0] for r in drawn.collect()], pa.list_(pa.float64())), width)
    shards = Shards(fitted, longest, 1 << max(0, math.ceil(math.log2(count / piece))))
    shared = spark.sparkContext.broadcast(shards)

    dealt = stage(rows.mapInArrow(_dealt(shared, longest, False), "vec_id long, vector array<double>, row long, shard int"), "dealt")
    pieces = dealt.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(piece)).cast("int").alias("pieces"))
    cut = dealt.join(F.broadcast(pieces), "shard").withColumn("piece", F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int"))
    parts = min(MAX_PARTITIONS, 2 * max(len(shards), math.ceil(count / piece)))
    packed = gathered(cut.repartition(parts, "shard", "piece"), ["shard", "piece"], ["vec_id", "vector"], "rows")
    with short_batches(spark, 4):
        index = stage(packed.mapInArrow(_planted(width, longest, leaf), INDEX), "trees")

    asked = usable(queries, "queries").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    asked = asked.withColumn("vector", F.slice("vector", 1, width))  # no candidate has more components
    home = "query_id long, vector array<double>, shard int"
    asked = stage(asked.mapInArrow(_dealt(shared, longest, True), home), "asked").withColumn("bar", F.lit(float("-inf")))

    def searched(who: DataFrame, label: str) -> DataFrame:
        with short_batches(spark, 4):
            met = meetings(index, who, "shard", ["query_id", "vector", "bar"])
            return stage(met.mapInArrow(_searched(width, longest, k, stretch, leaf), FOUND), label)

    def best(found: DataFrame) -> DataFrame:
        return top_k(found, ["query_id"], [F.desc("score"), F.asc("vec_id")], k)

    first = searched(asked, "at-home")
    if len(shards) == 1:
        return best(first).select("query_id", "rank", "vec_id", "score")
    bars = best(first).groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("found"))
    known = asked.drop("bar").join(bars, "query_id", "left").withColumn("bar", F.coalesce("found", F.lit(float("-inf")))).drop("found")
    others = stage(known.mapInArrow(_reached(shared, longest, stretch), "query_id long, vector array<double>, bar double, shard int"), "reached")
    return best(union_all([first, searched(others, "elsewhere")])).select("query_id", "rank", "vec_id", "score")
