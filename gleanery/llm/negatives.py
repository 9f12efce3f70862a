"""Hard negatives by threshold joins over inverted lists with norm bounds.

Rows lie in blocks. In a block, a dimension's list leaves out the vectors whose components from that dimension on can't
lift any product to the least threshold asked for. A join reads the lists, dimensions of much weight first, adds up partial
scores, drops what can't reach its anchor's threshold with the norms that remain, and completes the rest. The positives
of an anchor open windows of scores; thresholds start high in the lowest window and fall until every window is full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import short_batches
from gleanery.llm.topk import quantised
from gleanery.llm.vectors import best_of_each, blocks_of, matrix, meetings
from gleanery.operators.joins import union_all
from gleanery.operators.ranking import top_k
from gleanery.session import stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST, MOST = 80, 100  # percent of the positive's score
FALLS = (0.15, 0.5, 1.0)  # of the way from MOST to LEAST
BLOCK = 16_384
ANCHORS = 64  # that read the lists together
STEP = 8  # dimensions that are read together
TRIAL = 1024  # rows of a label that set the first threshold of its positives
EXACT = 2.0**52
LARGEST = np.iinfo(np.int64).max

FOUND = "anchor_id long, place int, vec_id long, score long"


class Lists:
    """Inverted lists of a block, for anchors of length ``longest`` at most and thresholds of ``floor`` at least.

    Dimensions are in order of weight. A row is in the lists up to its cut; rows stand in order of falling cuts, so a list is
    a prefix of the rows. ``left`` keeps what the lists omit.
    """

    def __init__(self, values: np.ndarray, floor: float, longest: float) -> None:
        real = values.astype(np.float64)
        self.order = np.argsort(-(real**2).sum(0), kind="stable")
        self.norms = _suffix_norms(real[:, self.order])
        reaches = self.norms * longest * (1 + 1e-12) >= floor
        self.cut = np.where(floor > 0, reaches.sum(1), values.shape[1]).astype(np.int64).clip(0, values.shape[1])
        self.rows = np.argsort(-self.cut, kind="stable")
        self.norms, self.cut = self.norms[self.rows], self.cut[self.rows]
        ordered = values[self.rows][:, self.order]
        kept = np.arange(values.shape[1]) < self.cut[:, None]
        self.listed, self.left = np.where(kept, ordered, 0), np.where(kept, 0, ordered)

    def join(self, queries: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of all products of at least ``floors`` of the query."""
        width, queries = len(self.order), queries[:, self.order]
        norms = _suffix_norms(queries.astype(np.float64))
        alive = np.arange(len(self.rows))
        listed, cut, rest = self.listed, self.cut, self.norms
        score = np.zeros((len(queries), len(alive)), queries.dtype)
        for start in range(0, width, STEP):
            stop = min(width, start + STEP)
            read = np.searchsorted(-cut, -start)  # rows whose cut is behind the start
            score[:, :read] += queries[:, start:stop] @ listed[:read, start:stop].T
            if start < 3 * width // 4 <= stop < width:
                behind = np.minimum(cut, stop)
                most = score + norms[:, behind] * rest[np.arange(len(cut)), behind] * (1 + 1e-9)
                keep = (most >= floors[:, None]).any(0)
                if 2 * keep.sum() < len(keep):
                    alive, listed, cut, rest, score = alive[keep], listed[keep], cut[keep], rest[keep], score[:, keep]
        most = score + norms[:, cut] * rest[np.arange(len(cut)), cut] * (1 + 1e-9)
        query, at = np.nonzero(most >= floors[:, None])
        omitted = np.flatnonzero(cut[at] < width)
        total = score[query, at]
        total[omitted] += np.einsum("ij,ij->i", queries[query[omitted]], self.left[alive[at[omitted]]])
        reached = total >= floors[query]
        return query[reached], self.rows[alive[at[reached]]], total[reached].astype(np.int64)


def _suffix_norms(values: np.ndarray) -> np.ndarray:
    """Norms of what each row has from every dimension on; 0 behind the last."""
    squares = np.zeros((len(values), values.shape[1] + 1))
    squares[:, :-1] = np.cumsum((values**2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(squares)


def _exact(values: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As floating point numbers where all sums stay exact, which is faster."""
    if float(np.abs(values).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, values.shape[1]) < EXACT:
        return values.astype(np.float64), queries.astype(np.float64)
    return values, queries


def _longest(queries: np.ndarray) -> float:
    return float(np.sqrt((queries.astype(np.float64) ** 2).sum(1)).max(initial=0))


class Block:
    def __init__(self, rows: pa.StructArray, asked: pa.StructArray) -> None:
        values, queries = matrix(rows.field("vector"), kind=np.int64), matrix(asked.field("vector"), kind=np.int64)
        width = max(values.shape[1], queries.shape[1])
        values, queries = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (values, queries))
        self.values, self.queries = _exact(values, queries)
        self.ids, self.labels = rows.field("vec_id").to_numpy(), rows.field("label").to_numpy()
        self.own, self.own_labels = asked.field("query_id").to_numpy(), asked.field("label").to_numpy()

    def positives(self, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, row, score): the best ``k`` rows of the anchor's label but itself."""
        for label in np.unique(self.own_labels):
            members, asking = np.flatnonzero(self.labels == label), np.flatnonzero(self.own_labels == label)
            if not len(members):
                continue
            # The k-th best of a trial is a threshold that fills the window for sure.
            trial = members[:TRIAL]
            score = np.where(self.ids[trial] == self.own[asking, None], -np.inf, self.queries[asking] @ self.values[trial].T)
            floors = np.partition(score, -k, axis=1)[:, -k] if len(trial) >= k else np.full(len(asking), -np.inf)
            floors = floors - np.abs(floors) * 1e-12  # large sums lose digits as floating point numbers
            lists = Lists(self.values[members], floors.min(), _longest(self.queries[asking]))
            for at in range(0, len(asking), ANCHORS):
                part = asking[at : at + ANCHORS]
                who, row, score = lists.join(self.queries[part], floors[at : at + ANCHORS])
                row = members[row]
                other = self.ids[row] != self.own[part[who]]
                who, row, score = part[who[other]], row[other], score[other]
                best, _ = best_of_each(who, score, self.ids[row], k)
                yield who[best], row[best], score[best]

    def negatives(self, marks: list[np.ndarray], places: list[np.ndarray], share: float, least: int, most: int, k: int):
        """(anchor, window, row, score): the best ``k`` rows of other labels in each window, down to the threshold ``share``."""
        floors = np.array([max(-(-least * int(m.min()) // 100), int(np.ceil(share * int(m.min()) / 100))) for m in marks], np.float64)
        lists = Lists(self.values, floors.min(initial=np.inf), _longest(self.queries))
        for at in range(0, len(self.queries), ANCHORS):
            who, row, score = lists.join(self.queries[at : at + ANCHORS], floors[at : at + ANCHORS])
            who = who + at
            other = self.labels[row] != self.own_labels[who]
            who, row, score = who[other], row[other], score[other]
            for window in range(max(len(m) for m in marks[at : at + ANCHORS])):
                # As whole numbers of any size: a percentage of a large score is beyond 64 bits.
                mark = [int(m[window]) if window < len(m) else None for m in marks]
                low = np.array([LARGEST if m is None else min(LARGEST, -(-least * m // 100)) for m in mark])
                high = np.array([-1 if m is None else min(LARGEST, most * m // 100) for m in mark])
                inside = (score >= low[who]) & (score <= high[who])
                some, line, value = who[inside], row[inside], score[inside]
                best, _ = best_of_each(some, value, self.ids[line], k)
                named = np.array([p[window] if window < len(p) else 0 for p in places])
                yield some[best], named[some[best]], line[best], value[best]


_SCHEMA = pa.schema([("anchor_id", pa.int64()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _emitted(anchors, places, ids, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in ((anchors, "i8"), (places, "i4"), (ids, "i8"), (scores, "i8"))], schema=_SCHEMA)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.StructArray]]:
    for batch in batches:
        for rows, asked in zip(batch.column("rows"), batch.column("asked")):
            yield Block(rows.values, asked.values), asked.values


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in _met(batches):
            for who, row, score in block.positives(k):
                yield _emitted(block.own[who], np.zeros(len(who)), block.ids[row], score)

    return run


def _negatives(share: float, least: int, most: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, asked in _met(batches):
            marks, places = ([x.values.to_numpy() for x in asked.field(c)] for c in ("marks", "places"))
            for who, place, row, score in block.negatives(marks, places, share, least, most, k):
                yield _emitted(block.own[who], place, block.ids[row], score)

    return run


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
    scale: int = SCALE, block: int = BLOCK, falls: tuple[float, ...] = FALLS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``, all exact.

    ``rows`` and ``anchors`` have ``vec_id``, ``label`` and ``embedding``; components become floor(scale * x) and a score is
    the integer inner product with the anchor, ties going to the smaller vec_id. An anchor's positives are its best
    ``positives`` rows of its label; a positive's negatives the best ``negatives`` rows of other labels with a score of ``least``
    to ``most`` percent of its own. Fewer are given where there are no more; a positive without negatives, such as one of
    a negative score, has no row. Rows with a null vec_id, label or vector, or a null or non-finite component take no part;
    missing components of shorter vectors count as 0. Rows with equal vec_id count one by one, but never for an anchor of
    that vec_id; of anchors with equal vec_id the one of least label, then vector, counts. Sums must fit in 64 bits.
    Other columns are ignored.

    Every anchor meets every block; each round of ``falls`` asks only for the windows that the higher threshold left open.
    """
    spark = rows.sparkSession

    def usable(table: DataFrame) -> DataFrame:
        whole = table.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), quantised(F.col("embedding"), scale).alias("vector"))
        return whole.where("vec_id is not null and label is not null and vector is not null")

    kept = stage(usable(rows).withColumn("row", F.monotonically_increasing_id()), "vectors")
    blocks, count = blocks_of(kept, ["vec_id", "label", "vector"], kept.count(), block, "blocks")
    first = usable(anchors).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("label", "vector")).alias("least"))
    asked = stage(first.select("query_id", "least.label", "least.vector"), "anchors")

    def everywhere(who: DataFrame, columns: list[str]) -> DataFrame:
        """Anchors at each block."""
        return who.select(*columns, F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("block"))

    with short_batches(spark, 4):
        columns = ["query_id", "label", "vector"]
        found = meetings(blocks, everywhere(asked, columns), "block", columns).mapInArrow(_positives(positives), FOUND)
        best = stage(top_k(found, ["anchor_id"], [F.desc("score"), F.asc("vec_id")], positives), "positives")
    open_ = best.where("score >= 0").select(F.col("anchor_id").alias("query_id"), F.col("rank").cast("int").alias("place"), F.col("score").alias("mark"))
    open_ = stage(open_, "windows")
    done = []
    for fall in falls:
        marks = F.sort_array(F.collect_list(F.struct("place", "mark"))).alias("marks")
        pending = open_.groupBy("query_id").agg(marks).join(asked, "query_id")
        pending = pending.select(*columns, F.col("marks.mark").alias("marks"), F.col("marks.place").alias("places"))
        with short_batches(spark, 4):
            met = meetings(blocks, everywhere(pending, [*columns, "marks", "places"]), "block", [*columns, "marks", "places"])
            found = met.mapInArrow(_negatives(most - (most - least) * fall, least, most, negatives), FOUND)
            nearest = stage(top_k(found, ["anchor_id", "place"], [F.desc("score"), F.asc("vec_id")], negatives), "negatives")
        if fall == falls[-1]:
            done.append(nearest)
            break
        full = nearest.groupBy(F.col("anchor_id").alias("query_id"), "place").agg(F.count("*").alias("n")).where(F.col("n") == negatives).drop("n")
        full = stage(full, "full")
        done.append(nearest.join(full.withColumnRenamed("query_id", "anchor_id"), ["anchor_id", "place"], "left_semi"))
        open_ = stage(open_.join(full, ["query_id", "place"], "left_anti"), "windows")
        if open_.isEmpty():
            break
    chosen = best.select("anchor_id", F.col("rank").cast("int").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return union_all(done).join(chosen, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
