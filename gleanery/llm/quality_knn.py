"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms are hashed byte pairs, word shapes and marks of repetition, counted for each text. Term weights and the latent
space (a truncated singular value decomposition) are fitted on a bounded sample of labelled texts. Their vectors are
broadcast; every document's cosine with each of them is computed exactly, in blocks of documents, and the
labels of the nearest vote with weights that grow with similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import held_out, only
from gleanery.llm.words import PART, buffers, in_chunks, mix, sequences, words_of
from gleanery.operators.ranking import top_k
from gleanery.session import stage

SAMPLE = 2000  # labelled texts of each label at most
DIMENSIONS = 24
NEIGHBOURS = 12
SHARPNESS = 10.0

PAIRS = 512
SHAPES = 128
EXTRA = 8
TERMS = PAIRS + SHAPES + EXTRA

_FOLD = np.arange(256)
_FOLD[65:91] += 32
_PAIR = (mix(np.arange(65536, dtype=np.uint64), 31) % np.uint64(PAIRS)).astype(np.int32)
_KIND = np.zeros(256, np.int64)  # letters and bytes of letters 0, capitals 1, digits 2, other signs 3
_KIND[33:127] = 3
_KIND[48:58] = 2
_KIND[65:91] = 1
_KIND[97:123] = 0


def term_counts(texts: pa.Array) -> np.ndarray:
    """Logarithmic counts of each text's terms, of unit length before weighting."""
    data, offsets = buffers(texts)
    n = len(texts)
    out = np.zeros((n, TERMS))
    words = words_of(texts)
    if len(data):
        doc = np.repeat(np.arange(n), np.diff(offsets))
        folded = _FOLD[data].astype(np.int32)
        code = _PAIR[folded[:-1] * 256 + folded[1:]] + doc[:-1] * PAIRS
        out[:, :PAIRS] = np.bincount(code[doc[:-1] == doc[1:]], minlength=n * PAIRS).reshape(n, PAIRS)
    if len(words.start):
        of = words.doc_of()
        kinds = _KIND[words.data]
        length = words.end - words.start
        shape = np.minimum(length, 15)
        for kind in (1, 2, 3):
            total = np.concatenate([[0], np.cumsum(kinds == kind)])
            many = 2 * (total[words.end] - total[words.start]) > (length if kind == 1 else 0)
            shape = shape + many * (16 << (kind - 1))
        out[:, PAIRS : PAIRS + SHAPES] = np.bincount(of * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES)
        index, grams = sequences(words, 3)
        if len(index):
            # Runs of three words that the text has had before.
            key = mix(grams + mix(of[index].astype(np.uint64), 33), 34)
            _, first = np.unique(key, return_index=True)
            again = np.ones(len(key), bool)
            again[first] = False
            share = np.bincount(of[index][again], minlength=n) / np.maximum(1, np.diff(words.first))
            level = np.minimum(EXTRA - 2, np.ceil(np.sqrt(share) * (EXTRA - 2))).astype(int)
            out[np.arange(n), PAIRS + SHAPES + level] = np.diff(words.first)
        out[:, TERMS - 1] = np.diff(words.first) < 50
    # Within each family counts become shares, so that a text's length does not matter.
    for low, high in ((0, PAIRS), (PAIRS, PAIRS + SHAPES), (PAIRS + SHAPES, TERMS)):
        part = np.sqrt(out[:, low:high])
        out[:, low:high] = part / np.maximum(1e-9, np.linalg.norm(part, axis=1, keepdims=True))
    return out


@dataclass
class Model:
    mean: np.ndarray
    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float

    def place(self, counts: np.ndarray) -> np.ndarray:
        latent = ((counts - self.mean) * self.weight) @ self.axes
        return latent / np.maximum(1e-9, np.linalg.norm(latent, axis=1, keepdims=True))

    def score(self, counts: np.ndarray, block: int = 512) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        latent, out = self.place(counts).astype(np.float32), np.empty(len(counts))
        near = min(NEIGHBOURS, len(self.labels))
        for begin in range(0, len(latent), block):
            cosine = latent[begin : begin + block] @ self.vectors.T
            best = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            similar = np.take_along_axis(cosine, best, axis=1)
            weight = self.votes[best] * np.exp(SHARPNESS * (similar - 1.0))
            out[begin : begin + block] = (weight * self.labels[best]).sum(axis=1) / weight.sum(axis=1)
        return out


def fit(counts: np.ndarray, labels: np.ndarray, shares: dict[int, float], dimensions: int = DIMENSIONS) -> Model:
    """The latent space and vectors of labelled texts; ``shares`` has each label's part of all labelled rows."""
    prior = shares.get(1, 0.5)
    if not len(labels):
        empty = np.zeros((0, dimensions))
        return Model(np.zeros(TERMS), np.ones(TERMS), np.zeros((TERMS, dimensions)), empty, labels, labels, prior)
    mean = counts.mean(axis=0)
    weight = 1 / (counts.std(axis=0) + 0.02)
    centred = (counts - mean) * weight
    values, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, np.argsort(-values)[:dimensions]]
    model = Model(mean, weight, axes, np.zeros((0, dimensions)), labels, labels, prior)
    model.vectors = model.place(counts).astype(np.float32)
    # A label of which only a part was sampled keeps its share of the vote.
    sampled = {label: (labels == label).mean() for label in shares}
    model.votes = np.array([shares[label] / sampled[label] for label in labels.tolist()])
    return model


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_chunks(batches, "text", PART):
        counts = term_counts(batch.column("text")).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array([x.tobytes() for x in counts], pa.binary())], names=["label", "counts"]
        )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> tuple[DataFrame, dict[int, float]]:
    """Texts ``(text, label)`` of rows that may be learnt from, ``most`` of each label, and the labels' shares.

    The choice is by a hash of the id. Labels other than 0 and 1, null ids and texts not among ``docs`` are left out.
    Of several labels of an id the least counts, of several texts the least, so recurring ids don't widen the sample.
    """
    usable = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
    usable = usable.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("label").alias("label"))
    counts = {int(r[0]): int(r[1]) for r in usable.groupBy("label").count().collect()}
    shares = {k: n / sum(counts.values()) for k, n in counts.items()}
    chosen = top_k(usable, ["label"], [F.xxhash64("doc_id"), F.col("doc_id")], most).select("doc_id", "label")
    chosen = stage(chosen, "labelled")
    # At most ``most`` rows of each label.
    found = only(docs, doc_id="long", text="string").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label"), shares


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> Model:
    """Fit on at most ``most`` labelled texts of each label whose rows are not held out."""
    sample, shares = labelled_sample(docs, labels, label, most)
    rows = sample.mapInArrow(_counts, "label int, counts binary").collect()
    rows = sorted((int(r[0]), bytes(r[1])) for r in rows)
    counts = np.array([np.frombuffer(c, np.float32) for _, c in rows], float).reshape(-1, TERMS)
    return fit(counts, np.array([y for y, _ in rows], float), shares)


def scored(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    All rows and columns stay, but for columns of these two names. A null text is scored as an empty one.
    Without labelled rows every score is the same.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = docs.select(*kept, F.lit(0.0).alias("score")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text"):
            # Terms are counted in parts; the rows of a block, on which the last digits depend, stay together.
            counts = np.concatenate([term_counts(x.column("text")) for x in in_chunks(iter([batch]), "text", PART)])
            score = shared.value.score(counts)
            score = np.clip(np.nan_to_num(score, nan=0.5), 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    made = docs.select(*kept).mapInArrow(run, schema)
    return made.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
