"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

Two first-order models over the characters of tokens are compared by log-likelihood ratio: one of random
strings, trained on the values the patterns find and smoothed by uniformly random strings; one of ordinary
identifiers and words, trained on all other tokens. Both are counted over the whole corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from gleanery.llm.common import checked, free_name, short_batches, staged_count
from gleanery.llm.words import PART, buffers, in_chunks
from gleanery.session import stage

# Patterns, least lengths of what counts, and the characters of tokens.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = (*LEAST, "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

SIDE = len(ALPHABET) + 1  # class 0 is the edge of a token
THRESHOLD = 14.0  # nats by which the random model must win
UNIFORM = 0.5  # part of uniformly random strings in the random model
PRIOR = 200.0  # what a pair's kinds of characters count against its own samples in the ordinary model
MOST_PAIR = 3.0  # nats of one pair, so that a rare pair alone is no evidence

# Kinds of characters: the edge of a token, upper case, lower case, digits, signs.
_KIND = np.array([0, *np.repeat([1, 2, 3, 4], [26, 26, 10, len(ALPHABET) - 62])])
_CLASS = np.zeros(256, np.int64)
_CLASS[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, SIDE)
_JOINS = np.zeros(256, bool)
_JOINS[np.frombuffer(b"/_=-+", np.uint8)] = True
_IS_HEX = np.zeros(256, bool)
_IS_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True


def pairs_of(text: bytes | np.ndarray) -> np.ndarray:
    """Counts of neighbouring character classes."""
    data = np.frombuffer(text, np.uint8) if isinstance(text, bytes) else text
    classes = np.zeros(len(data) + 2, np.int64)
    classes[1:-1] = _CLASS[data]
    return np.bincount(classes[:-1] * SIDE + classes[1:], minlength=SIDE * SIDE)


def log_ratio(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each character pair, from the counts of both classes of samples.

    A pair that ordinary tokens hardly have is as likely there as pairs of its kinds are on average: a number of any
    digits is as ordinary as other numbers.
    """

    def samples(counts: np.ndarray) -> np.ndarray:
        table = counts.reshape(SIDE, SIDE).astype(float) + 1e-3
        table[0, 0] = 1e-3  # gaps between tokens
        return table

    def share(table: np.ndarray) -> np.ndarray:
        return table / table.sum(axis=1, keepdims=True)

    member = np.eye(_KIND.max() + 1)[_KIND]
    plain = samples(ordinary)
    by_kind = share(member.T @ plain @ member) / member.sum(axis=0)
    usual = share(plain + PRIOR * by_kind[_KIND][:, _KIND])
    unusual = (1 - UNIFORM) * share(samples(random)) + UNIFORM / SIDE
    return np.minimum(np.log(unusual) - np.log((1 - 1e-4) * usual + 1e-4 / SIDE), MOST_PAIR)


def _has_run(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int) -> set[int]:
    """Texts with a run of at least ``least`` member bytes, or that seem to have one across their edge."""
    breaks = np.flatnonzero(np.append(~member[data], True))
    before = np.concatenate([[-1], breaks[:-1]])
    long = breaks - before > least
    starts, ends = before[long] + 1, breaks[long]
    first = np.searchsorted(offsets, starts, side="right") - 1
    last = np.searchsorted(offsets, ends, side="left")
    return {d for a, b in zip(first.tolist(), last.tolist()) for d in range(a, b)}


def base_spans(text: str, assign: bool = True, access: bool = True, hexes: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find, per kind leftmost and not overlapping."""
    found = []
    if assign:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if access:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if hexes:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(found)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, dict[int, list[tuple[int, int, int]]]]]:
    """Batches with their bytes and offsets, and the pattern spans of the texts that have some."""
    for batch in in_chunks(batches, "text", PART):
        texts = batch.column("text")
        data, offsets = buffers(texts)
        hexes = _has_run(data, offsets, _IS_HEX, LEAST["hex"])
        lowered, whole = data.tobytes().lower(), data.tobytes()
        hits = {k: any(w in lowered for w in KEYWORDS) if k == "assign" else b"AKIA" in whole for k in ("assign", "access")}
        found = {}
        for d in range(batch.num_rows) if any(hits.values()) else sorted(hexes):
            low, high = int(offsets[d]), int(offsets[d + 1])
            assign = hits["assign"] and any(lowered.find(w, low, high) >= 0 for w in KEYWORDS)
            access = hits["access"] and whole.find(b"AKIA", low, high) >= 0
            if assign or access or d in hexes:
                base = base_spans(texts[d].as_py() or "", assign, access, d in hexes)
                if base:
                    found[d] = base
        yield batch, data, offsets, found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the task's pair counts."""
    random, ordinary = np.zeros(SIDE * SIDE, np.int64), np.zeros(SIDE * SIDE, np.int64)
    for batch, data, _, found in _chunks(batches):
        ordinary += pairs_of(data)
        for d, base in found.items():
            text = batch.column("text")[d].as_py()
            for start, kind, end in base:
                value = text[start:end]
                if kind == 0:
                    value = ASSIGN.match(value)[2]
                counts = pairs_of(value.encode())
                random += counts
                ordinary -= counts
    kind = pa.list_(pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array([random], kind), pa.array([np.maximum(ordinary, 0)], kind)], names=["random", "ordinary"])


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens of all texts, of any length."""
    inside = _CLASS[data] > 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def hopeful(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray, threshold: float) -> np.ndarray:
    """Numbers of the tokens that may hold a run above the threshold; no other token does."""
    if not len(starts):
        return np.zeros(0, np.int64)
    # Each token has an edge before and behind it.
    size = ends - starts + 2
    first = np.cumsum(size) - size
    classes = np.zeros(int(size.sum()), np.int64)
    at = np.arange(len(classes)) - np.repeat(first, size)
    here = (at > 0) & (at <= np.repeat(size - 2, size))
    classes[here] = _CLASS[data[(np.repeat(starts - 1, size) + at)[here]]]
    ratios = np.zeros(len(classes))
    ratios[1:] = table[classes[:-1], classes[1:]]
    ratios[first] = 0
    gains = np.add.reduceat(np.maximum(ratios, 0), first)
    # A token whose positive ratios do not add up to the threshold has no run; few are left.
    return np.flatnonzero(gains > threshold)


def random_runs(ratios: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Disjoint runs of ratios, ``[first, last]``, whose sum exceeds the threshold, from left to right."""
    # A run ends where its sum is greatest, before the sum falls to nothing or by as much as the threshold.
    found, total, best, start, end = [], 0.0, 0.0, 0, 0
    for i, r in enumerate(ratios.tolist()):
        if total <= 0:
            total, best, start = 0.0, 0.0, i
        total += r
        if total > best:
            best, end = total, i
        if best > threshold and (total <= 0 or total < best - threshold):
            found.append((start, end))
            total = best = 0.0
        elif total <= 0:
            best = 0.0
    if best > threshold:
        found.append((start, end))
    return found


def markov_spans(token: bytes, base: list[tuple[int, int]], table: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """What looks random in a token, outside the pattern spans ``base``.

    A run above the threshold is widened to the next sign that joins parts of names, so its ends are not cut off. Pattern
    spans add to a run, whose rest is then given.
    """
    data = np.frombuffer(token, np.uint8)
    classes = np.concatenate([[0], _CLASS[data], [0]])
    joins = np.flatnonzero(_JOINS[data])
    out: list[tuple[int, int]] = []
    for first, last in random_runs(table[classes[:-1], classes[1:]], threshold):
        # Characters with both their pairs in the run; those at its ends, if signs, only divide it from names.
        inner = first + np.flatnonzero(~_JOINS[data[first:last]])
        low, high = (int(inner[0]), int(inner[-1]) + 1) if len(inner) else (max(first - 1, 0), min(last + 1, len(data)))
        before, after = int(np.searchsorted(joins, low)), int(np.searchsorted(joins, high))
        low = int(joins[before - 1]) + 1 if before else 0
        high = int(joins[after]) if after < len(joins) else len(data)
        low = max(low, out[-1][1] if out else 0)
        for start, end in [*sorted(base), (len(data), len(data))]:
            if low < min(start, high):
                out.append((low, min(start, high)))
            low = max(low, end)
    return out


def _scan(table: np.ndarray, threshold: float):
    schema = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("spans", pa.list_(pa.list_(pa.int32())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets, found in _chunks(batches):
            spans = [[list(s) for s in found.get(d, ())] for d in range(batch.num_rows)]
            starts, ends = _tokens(data, offsets)
            chosen = hopeful(data, starts, ends, table, threshold)
            doc = np.searchsorted(offsets, starts[chosen], side="right") - 1
            # Bytes that begin a character, so that places count code points.
            places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            for d, low, high in zip(doc.tolist(), starts[chosen].tolist(), ends[chosen].tolist()):
                at = int(places[low] - places[offsets[d]])
                base = [(a - at, b - at) for a, _, b in found.get(d, ()) if b > at and a < at + high - low]
                for a, b in markov_spans(data[low:high].tobytes(), base, table, threshold):
                    spans[d].append([at + a, KINDS.index("markov"), at + b])
            spans = pa.array([sorted(s) for s in spans], schema[2].type)
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("doc_id"), spans], schema=schema)

    return run


def secret_spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(row_id, doc_id, spans)`` for every row of ``docs (row_id, doc_id, text)``.

    ``spans`` are arrays (start, kind, end) in code points, in order; kinds are numbered as in ``KINDS``. Pattern
    kinds may overlap each other; Markov spans are the random runs of tokens of any length, without what pattern
    spans cover. Null and empty texts have none, and repeated rows are scanned one by one.
    """
    docs = docs.select("row_id", F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    with short_batches(docs.sparkSession):
        found = stage(docs.mapInArrow(_count, "random array<bigint>, ordinary array<bigint>"), "secrets")
    counts = {}
    for name in ("random", "ordinary"):
        # As many rows as there are pairs of characters.
        summed = found.select(F.posexplode(name)).groupBy("pos").agg(F.sum("col").alias("n")).collect()
        counts[name] = np.zeros(SIDE * SIDE, np.int64)
        for pos, n in summed:
            counts[name][pos] = n
    table = log_ratio(counts["random"], counts["ordinary"])
    return docs.mapInArrow(_scan(table, threshold), "row_id long, doc_id long, spans array<array<int>>")


def report(spans: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the pattern spans, and all spans as text."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda s: F.concat_ws(":", F.get(kinds, s[1]), s[0].cast("string"), s[2].cast("string"))
    base = F.filter("spans", lambda s: s[1] < 3)
    count = lambda i: F.size(F.filter("spans", lambda s: s[1] == i)).cast("long")
    return spans.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(F.array_join(F.transform(base, shown), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", shown), ",").alias("spans"),
    )


def _redact(mark: str, columns: list[str], schema: pa.Schema, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", PART):
            texts = []
            for text, spans in zip(batch.column("text"), batch.column(into).to_pylist()):
                text = text.as_py()
                for start, end in reversed(_merged(spans or [])):
                    text = text[:start] + mark + text[end:]
                texts.append(text)
            made = {"text": pa.array(texts, pa.string())}
            if "n_chars" in columns:
                lengths = zip(texts, batch.column(into), batch.column("n_chars").to_pylist())
                made["n_chars"] = pa.array([len(t) if spans.is_valid else n for t, spans, n in lengths], pa.int64())
            arrays = [made[c] if c in made else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, schema)], schema=schema)

    return run


def _merged(spans: list[list[int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, _, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def redacted(docs: DataFrame, mark: str = "[secret]", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; all rows and columns stay, ``n_chars`` follows the text.

    Columns may have any names. Null and empty texts stay as they are, repeated rows change alike.
    """
    key, into = free_name(docs, "row_id"), free_name(docs, "spans")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    spans = secret_spans(keyed.select(F.col(key).alias("row_id"), "doc_id", "text"), threshold)
    spans = spans.where(F.size("spans") > 0).select(F.col("row_id").alias(key), F.col("spans").alias(into)).dropDuplicates([key])
    with short_batches(docs.sparkSession):
        found, rows = staged_count(spans, "secret-spans")
    joined = keyed.join(checked(found, rows, 256), key, "left").select(*docs.columns, into)
    return joined.mapInArrow(_redact(mark, docs.columns, to_arrow_schema(docs.schema), into), docs.schema)
