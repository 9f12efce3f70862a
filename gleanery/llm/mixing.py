"""Mixing sources to target weights.

The texts of a source are one stream of words, cut into blocks of ``block`` words. Output slots are dealt to
shards: a shard draws how many of its slots each source gets. The draws are multinomial under the condition that
all shards together give each source its quota, so shards differ as independent draws would and totals are exact;
every shard finds its own counts by walking down a tree of seeded draws. The slots of a source run through a
pseudorandom permutation of its block numbers, one permutation for each pass. Slots and blocks are joined by number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from gleanery.llm.common import WORD, free_name, placed, staged_count
from gleanery.llm.words import PART, in_chunks, mix as mixed_bits, words_of

BLOCK = 256
SHARD_SLOTS = 4096
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_PASSES = 2.0
MAX_SOURCES = 100_000
DRAWN_SLOTS = 500_000_000  # of larger parts sources are drawn one by one, by the limits of the distribution
RARE = 1_000_000  # slots of a source up to which its draw is binomial there


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST_PASSES) -> list[float]:
    """Words for each source: ``share`` of all, by weight, at most ``most`` times its own; the excess is reshared."""
    goal, free = share * sum(sizes), list(range(len(sizes)))
    out = [0.0] * len(sizes)
    while free:
        whole = sum(weights[i] for i in free)
        over = [i for i in free if goal * weights[i] > most * sizes[i] * whole]
        if not over:
            for i in free:
                out[i] = goal * weights[i] / whole
            break
        for i in over:
            out[i] = most * sizes[i]
            goal -= out[i]
        free = [i for i in free if i not in set(over)]
    return out


def _rounds(x: np.ndarray, half: int, keys: list[int], back: bool) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for key in reversed(keys) if back else keys:
        if back:
            left, right = right ^ (mixed_bits(left, key) & mask), left
        else:
            left, right = right, left ^ (mixed_bits(right, key) & mask)
    return left << np.uint64(half) | right


def permuted(index: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """A seeded permutation of 0 to n - 1, or its inverse, at the given places."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    keys = [seed * 4 + i + 1 for i in range(4)]
    out = _rounds(np.asarray(index, np.uint64), half, keys, back)
    while (far := out >= np.uint64(n)).any():
        out[far] = _rounds(out[far], half, keys, back)
    return out.astype(np.int64)


@dataclass
class Source:
    """One source's stream and its slots: ``passes`` whole passes, then ``rest`` words of another."""

    size: int
    quota: int
    seed: int
    block: int
    slots: int = 0
    passes: int = 0
    rest: int = 0
    blocks: int = 0
    short: int = 0
    short_at: int = field(default=0)

    def __post_init__(self) -> None:
        if not self.size:
            return
        self.blocks = -(-self.size // self.block)
        self.short = self.size - (self.blocks - 1) * self.block
        self.passes, self.rest = divmod(self.quota, self.size)
        self.slots = self.passes * self.blocks
        if self.rest:
            last = np.array([self.blocks - 1])
            self.short_at = int(permuted(last, self.blocks, self.seed + self.passes, back=True)[0])
            before = self.short_at * self.block
            if self.rest <= before:
                self.slots += -(-self.rest // self.block)
            else:
                self.slots += self.short_at + 1 + max(0, -(-(self.rest - before - self.short) // self.block))

    def read(self, first: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pass, block and words taken from the block's start, of slots ``first`` to ``first + count - 1``."""
        number = np.arange(first, first + count)
        at_pass, place = np.divmod(number, self.blocks)
        block = np.empty(count, np.int64)
        for p in np.unique(at_pass):
            here = at_pass == p
            block[here] = permuted(place[here], self.blocks, self.seed + int(p))
        length = np.where(block == self.blocks - 1, self.short, self.block)
        done = place * self.block - np.where(place > self.short_at, self.block - self.short, 0)
        return at_pass, block, np.where(at_pass == self.passes, np.minimum(length, self.rest - done), length)


def _halved(counts: np.ndarray, take: int, seed: list[int]) -> np.ndarray:
    total, draws = int(counts.sum()), np.random.Generator(np.random.PCG64(seed))
    if total <= DRAWN_SLOTS:
        return draws.multivariate_hypergeometric(counts, take, method="marginals")
    # Each source's draw from what is left; of so many slots a rare source's is binomial, another's normal.
    left = np.zeros_like(counts)
    for i in np.flatnonzero(counts):
        own, others = int(counts[i]), total - int(counts[i])
        share = take / total
        if own <= RARE:
            drawn = int(draws.binomial(own, share))
        else:
            drawn = round(draws.normal(own * share, (own * share * (1 - share) * others / (total - 1)) ** 0.5))
        left[i] = min(max(drawn, take - others, 0), own, take)
        total, take = others, take - int(left[i])
    return left


def shard_counts(slots: np.ndarray, shard: int, shard_slots: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source in one shard, and its slots in the shards before."""
    low, high = 0, max(1, -(-int(slots.sum()) // shard_slots))
    counts, before = slots.copy(), np.zeros_like(slots)
    while high - low > 1:
        middle = (low + high) // 2
        left = _halved(counts, (middle - low) * shard_slots, [seed, low, high])
        if shard < middle:
            counts, high = left, middle
        else:
            counts, before, low = counts - left, before + left, middle
    return counts, before


@dataclass
class Mix:
    """``rows``: documents with sizes and targets. ``pieces``: what slots take of them, in words."""

    rows: DataFrame
    pieces: DataFrame


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES,
    block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 1,
) -> Mix:
    """Plan a mix of ``docs (doc_id, text, source)``.

    Sources by code point, null last, get ``weights`` in turn. ``rows`` has one row per document: row_id, doc_id,
    text_id, source, size, source_size, target. ``pieces`` has shard, slot, pass, row_id, text_id, start, n_words.
    A source's pieces sum to its rounded target; no document is taken more than ``most`` times, rounded up to a
    whole pass. Null and empty texts have size 0 and are never taken. Equal rows are interchangeable. Results depend
    on the rows and the seed only. Sources are a small table (``MAX_SOURCES`` at most, else an error).
    """
    spark = docs.sparkSession
    sized = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("text_id"),
        F.col("source").cast("string"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sized, count = staged_count(sized.withColumn("row_id", F.monotonically_increasing_id()), "sizes")
    found = sized.groupBy("source").agg(F.sum("size")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals = sorted(((r[0], r[1]) for r in found), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [n for _, n in totals]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, most)
    plans = [Source(n, min(round(t), int(most * n)), seed * 1_000_003 + 1009 * i, block) for i, (n, t) in enumerate(zip(sizes, wanted))]
    listed = spark.createDataFrame(
        [(name, i, n, t) for i, ((name, n), t) in enumerate(zip(totals, wanted))],
        "source string, sid int, source_size long, target double",
    )
    # One short row per source, at most MAX_SOURCES.
    rows = sized.alias("d").join(F.broadcast(listed.alias("s")), F.expr("d.source <=> s.source"))
    rows = rows.select("d.row_id", "d.doc_id", "d.text_id", "d.source", "d.size", "s.sid", "s.source_size", "s.target")
    put = placed(rows.where("size > 0").select("row_id", "doc_id", "text_id", "sid", "size"), ["sid"], ["doc_id", "text_id"], "size", count)
    cut = put.withColumn("block", F.explode(F.expr(f"sequence(before div {block}, (before + size - 1) div {block})")))
    cut = cut.select(
        "sid", "block", "row_id", "text_id",
        F.greatest(F.lit(0), F.col("block") * block - F.col("before")).alias("start"),
        F.greatest(F.lit(0), F.col("before") - F.col("block") * block).alias("at"),
        F.least(F.col("before") + F.col("size"), (F.col("block") + 1) * block).alias("to"),
    ).withColumn("to", F.col("to") - F.col("block") * block)
    slots = np.array([p.slots for p in plans], np.int64)
    shards = -(-int(slots.sum()) // shard_slots)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                counts, before = shard_counts(slots, int(shard), shard_slots, seed)
                parts, slot = [], 0
                for sid in np.flatnonzero(counts):
                    at_pass, number, take = plans[sid].read(int(before[sid]), int(counts[sid]))
                    parts.append(pd.DataFrame({
                        "shard": shard, "slot": np.arange(slot, slot + len(number)), "sid": sid,
                        "pass": at_pass, "block": number, "take": take,
                    }))
                    slot += len(number)
                if parts:
                    yield pd.concat(parts)

    filled = spark.range(0, shards, 1, max(1, min(shards, 10_000))).mapInPandas(fill, "shard long, slot long, sid int, pass int, block long, take long")
    # The optimizer takes a shard for one row, but it has many slots: they are merged, not broadcast.
    pieces = cut.join(filled.hint("merge"), ["sid", "block"]).withColumn("n_words", F.least("take", "to") - F.col("at")).where("n_words > 0")
    return Mix(rows.drop("sid"), pieces.select("shard", "slot", "pass", "row_id", "text_id", "start", "n_words"))


def taken(mix: Mix) -> DataFrame:
    """Documents with the words that the mix takes of them."""
    sums = mix.pieces.groupBy("row_id").agg(F.sum("n_words").alias("taken"))
    return mix.rows.join(sums, "row_id", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def _cut_text(columns: list[str], schema: pa.Schema, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", PART):
            words, texts, row, whole = words_of(batch.column("text")), [], [], batch.column("text")
            for d, pieces in enumerate(batch.column(into).to_pylist()):
                first, last = int(words.first[d]), int(words.first[d + 1])
                runs: list[list[int]] = []
                for at_pass, row_id, start, n_words in sorted(tuple(p.values()) for p in pieces):
                    if runs and runs[-1][:2] == [at_pass, row_id] and runs[-1][3] == start:
                        runs[-1][3] += n_words
                    else:
                        runs.append([at_pass, row_id, start, start + n_words])
                for _, _, start, end in runs:
                    cut = words.data[words.start[first + start] : words.end[first + end - 1]]
                    texts.append(whole[d].as_py() if end - start == last - first else cut.tobytes().decode())
                    row.append(d)
            kept = batch.take(pa.array(row, pa.int64()))
            made = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            arrays = [made[c] if c in made else kept.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, schema)], schema=schema)

    return run


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of ``docs``: each unbroken run of words that a pass takes of a document is one row.

    A document that is taken whole keeps its text unchanged; of one taken twice there are two rows. ``n_chars``,
    where there is one, follows the text. Null and empty texts have no words and give no row. Rows equal in doc_id and
    text are interchangeable: other columns are those of any of them. Columns of any names stay as they are.
    """
    mix, key, into = mix_sources(docs, **options), free_name(docs, "text_id"), free_name(docs, "pieces")
    pieces = mix.pieces.groupBy(F.col("text_id").alias(key)).agg(F.collect_list(F.struct("pass", "row_id", "start", "n_words")).alias(into))
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    joined = keyed.join(pieces, key).dropDuplicates([key])
    schema = to_arrow_schema(docs.schema)
    return joined.select(*docs.columns, into).mapInArrow(_cut_text(docs.columns, schema, into), docs.schema)
