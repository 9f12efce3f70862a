"""Toxicity after noisy-channel deobfuscation.

Strings that may be disguised (digits and signs among letters, letters set apart, letters repeated) become
lattices of characters. A Viterbi search finds the likeliest reading under a character trigram model, counted
over the whole corpus, and a channel with a cost for each disguise. The restored text is scored by a lexicon
of words and word beginnings learnt from labelled texts. Plain words have one path and are their own reading.
"""

from __future__ import annotations


from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import fields, only
from gleanery.llm.quality_knn import labelled_sample
from gleanery.llm.words import buffers, byte_hashes, in_chunks, mix, spans_hash, words_of
from gleanery.session import stage

SAMPLE = 20_000  # labelled texts of each label at most
SIGNIFICANCE = 24.0  # likelihood-ratio statistic that a lexicon entry must reach
LEXICON = 50_000
LEAST_WEIGHT = 4.5  # log-odds of a lexicon entry
PREFIXES = (4, 5, 6)

# What a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "(": "c",
}
SEPARATORS = ".-_*~ "
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SIDE = 28  # 0: edge or gap, 1 to 26: letters, 27: any other letter
COSTS = {"plain": 0.05, "leet": 1.5, "kept": 6.0, "dropped": 1.0, "repeat": 1.0}
JOINED = 24  # letters of a part of short words read as one; their whole reading has any length

_CLASS = np.zeros(256, np.int64)
_CLASS[128:] = 27
for _i, _c in enumerate(LETTERS):
    _CLASS[ord(_c)] = _CLASS[ord(_c.upper())] = _i + 1
_GAPS = _CLASS == 0
_SIGN = np.zeros(256, bool)
_SIGN[np.frombuffer("".join(LEET).encode(), np.uint8)] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SEPARATES = np.zeros(256, bool)
_SEPARATES[np.frombuffer(SEPARATORS.encode(), np.uint8)] = True


def letter_class(c: str) -> int:
    return int(_CLASS[ord(c)]) if ord(c) < 128 else 27


def trigram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of three neighbouring character classes; texts are set apart by gaps."""
    classes = np.zeros(len(data) + len(offsets) + 1, np.int32)
    place = np.arange(len(data)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) + 1
    classes[place] = _CLASS[data]
    code = (classes[:-2] * SIDE + classes[1:-1]) * SIDE + classes[2:]
    return np.bincount(code, minlength=SIDE**3)


def language_model(counts: np.ndarray) -> np.ndarray:
    """log P(third | first two), interpolated with lower orders."""
    three = counts.reshape(SIDE, SIDE, SIDE).astype(float)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one + 1).sum()
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3)


def _channel(c: str) -> tuple[int, tuple[tuple[str, int], ...], float | None]:
    """A character's own class, the letters it may stand for, and the cost of leaving it out."""
    leave = COSTS["dropped"] + (0 if c in SEPARATORS else 1.5) if c in SEPARATORS or c in LEET else None
    return letter_class(c), tuple((x, letter_class(x)) for x in LEET.get(c, "")), leave


_CHANNEL = {chr(i): _channel(chr(i)) for i in range(128)}
_OTHER = _channel("\x80")


def viterbi(text: str, costs: list[float]) -> list[str]:
    """What each character becomes in the likeliest reading: itself, a letter it stands for, or nothing.

    ``costs`` are the negative logarithms of the character model. Texts of any length are read in one go.
    """
    # A state is the last two classes; of each, the cheapest reading so far, as a chain of (before, character).
    plain, leet, kept, repeat = (COSTS[k] for k in ("plain", "leet", "kept", "repeat"))
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    other = ""
    for c in text.lower():
        step: dict[int, tuple[float, tuple | None]] = {}
        own, letters, leave = _CHANNEL.get(c, _OTHER)
        offers: list[tuple[int, float, tuple]] = []
        offer = offers.append
        # The last letter of a reading is that of its last class; class 27 has many, of which the last can't be left out.
        again = own < 27 or c == other
        for state, (cost, path) in states.items():
            b = state % SIDE
            if own:
                offer((b * SIDE + own, cost + plain + costs[state * SIDE + own], (path, c)))
                if b == own and again:
                    offer((state, cost + repeat, (path, "")))
            else:
                for letter, to in letters:
                    offer((b * SIDE + to, cost + leet + costs[state * SIDE + to], (path, letter)))
                    if b == to:
                        offer((state, cost + leet + repeat, (path, "")))
                if leave is not None:
                    offer((state, cost + leave, (path, "")))
                offer((b * SIDE, cost + kept + costs[state * SIDE], (path, " ")))
        for state, cost, path in offers:
            if state not in step or cost < step[state][0]:
                step[state] = (cost, path)
        if own == 27:
            other = c
        states = step
    path = min(states.items(), key=lambda s: s[1][0] + costs[s[0] * SIDE])[1][1]
    out = []
    while path:
        path, c = path
        out.append(c)
    return out[::-1]


def decoded(text: str, model: np.ndarray) -> str:
    return "".join(viterbi(text, (-model).ravel().tolist()))


def restored(text: str, costs: list[float]) -> str:
    """The reading of a string, or nothing if it is the string. Of words read as one, also parts from word to word."""
    text = text.lower()
    reading = viterbi(text, costs)
    found = ["".join(reading)]
    if found[0] == text:
        return ""
    if " " in text:
        parts = [""]
        for c, into in zip(text, reading):
            if c == " ":
                parts.append("")
            parts[-1] += into
        for first in range(len(parts)):
            joined = parts[first].strip()
            for part in parts[first + 1 :]:
                joined += part
                if len(joined) > JOINED or " " in joined:
                    break
                found.append(joined)
    return " ".join(dict.fromkeys(found))


def suspects(texts: pa.Array) -> list[list[str]]:
    """Strings of each text that may be disguised words.

    Words with a letter and a sign of ``LEET``, a letter twice in a row, or separators between characters; rows of three or
    more words of one or two characters, which may have separators around and between them. A word of signs alone is a number.
    """
    texts = pc.utf8_lower(texts)
    data, offsets = buffers(texts)
    out: list[list[str]] = [[] for _ in range(len(texts))]
    if len(data) < 3:
        return out
    letter, sign, gap = _CLASS[data] > 0, _SIGN[data], _SEPARATES[data] & (data != 32)
    unit, begins = letter | sign, (data & 0xC0) != 0x80
    twice = np.zeros(len(data), bool)
    for n, of in enumerate((data < 128, data >> 5 == 6, data >> 4 == 14, data >> 3 == 30), 1):
        same = letter[: -2 * n + 1] & of[: -2 * n + 1] if len(data) >= 2 * n else np.zeros(0, bool)
        for i in range(n if len(same) else 0):
            same = same & (data[i : i + len(same)] == data[i + n : i + n + len(same)])
        twice[n : n + len(same)] |= same
    # Units with nothing but separators before them, and then another unit.
    units, gaps = np.flatnonzero(unit), np.concatenate([[0], np.cumsum(gap)])
    apart = np.zeros(len(data), bool)
    far = np.diff(units)
    apart[units[1:][(far > 1) & (gaps[units[1:]] - gaps[units[:-1]] == far - 1)]] = True
    words = words_of(texts)

    def count(of: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(of)])
        return total[words.end] - total[words.start]

    marked = (count(letter) > 0) & (count(sign | twice | apart) > 0)
    # Single characters set apart may be signs alone.
    signs = np.zeros(len(data), bool)
    if len(data) >= 5:
        signs[:-4] = unit[:-4] & gap[1:-3] & unit[2:-2] & gap[3:-1] & unit[4:]
    marked |= count(signs) > 0
    doc = words.doc_of()
    for w in np.flatnonzero(marked).tolist():
        out[doc[w]].append(data[words.start[w] : words.end[w]].tobytes().decode())
    # Short words in a row, and rows of single characters inside it.
    clean, n_units = count(unit | gap) == words.end - words.start, count(unit & begins)
    for most in (2, 1):
        short = clean & (n_units <= most)
        edge = np.diff(np.concatenate([[0], short.astype(np.int8), [0]]))
        for begin, end in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            while begin < end:
                stop = min(end, int(words.first[doc[begin] + 1]))
                if np.count_nonzero(n_units[begin:stop]) >= 3:
                    row = " ".join(data[words.start[w] : words.end[w]].tobytes().decode() for w in range(begin, stop))
                    out[doc[begin]].append(row)
                begin = stop
    return out


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts and fingerprints of all words; then word number and fingerprint of each word and word beginning."""
    words = words_of(texts, lower=True, gaps=_GAPS)
    length = words.end - words.start
    found = [(np.arange(len(words.hash)), words.hash)]
    for n in PREFIXES:
        long = np.flatnonzero(length > n)
        found.append((long, byte_hashes(words.data, words.start[long], words.start[long] + n) + np.uint64(n)))
    return words.doc_of(), words.hash, np.concatenate([w for w, _ in found]), np.concatenate([h for _, h in found])


@dataclass
class Model:
    """Sorted fingerprints with log-odds, the log-odds of label 1, and the character model."""

    entries: np.ndarray
    weights: np.ndarray
    prior: float
    characters: np.ndarray

    def weight_of(self, texts: pa.Array) -> np.ndarray:
        """Sum over each text's distinct words of the greatest weight of the word and its beginnings."""
        out = np.zeros(len(texts))
        if not len(self.entries) or not len(texts):
            return out
        doc, names, word, hashes = features(texts)
        at = np.minimum(np.searchsorted(self.entries, hashes), len(self.entries) - 1)
        hit = self.entries[at] == hashes
        best = np.zeros(len(doc))
        np.maximum.at(best, word[hit], self.weights[at[hit]])
        toxic = np.flatnonzero(best)
        _, first = np.unique(np.stack([doc[toxic].astype(np.uint64), names[toxic]]), axis=1, return_index=True)
        np.add.at(out, doc[toxic[first]], best[toxic[first]])
        return out

    def score(self, texts: pa.Array, cache: dict[str, str]) -> np.ndarray:
        total = self.weight_of(texts)
        found = suspects(texts)
        costs = (-self.characters).ravel().tolist()
        rows, readings = [], []
        for row, strings in enumerate(found):
            changed = {}
            for s in dict.fromkeys(strings):
                if s not in cache:
                    if len(cache) > 200_000:
                        cache.clear()
                    cache[s] = restored(s, costs)
                if cache[s]:
                    changed[s] = cache[s]
            if changed:
                # The restored text: readings in place of what they were read from. Words count once, in any order.
                words = pc.utf8_lower(texts[row]).as_py().encode().split()
                rows.append(row)
                readings.append(" ".join([*(w for w in map(bytes.decode, dict.fromkeys(words)) if w not in changed), *changed.values()]))
        if rows:
            total[rows] = np.maximum(total[rows], self.weight_of(pa.array(readings, pa.string())))
        return 1 / (1 + np.exp(-np.clip(self.prior + total, -30, 30)))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add a fingerprint of all words of each text in their order, equal for copies only."""
    for batch in in_chunks(batches, "text"):
        words = words_of(batch.column("text"), lower=True)
        first, last = words.first[:-1], words.first[1:]
        mark = mix(spans_hash(words.hash, first, last) + mix((last - first).astype(np.uint64))).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mark)], names=[*batch.schema.names, "mark"])


def _lexicon_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each label in which a fingerprint occurs, summed within the batch."""
    for batch in in_chunks(batches, "text"):
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        of, _, word, hashes = features(batch.column("text"))
        if not len(of):
            continue
        doc = of[word]
        order = np.lexsort((doc, hashes))
        doc, hashes = doc[order], hashes[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
        doc, hashes = doc[fresh], hashes[fresh]
        entry, which = np.unique(hashes, return_inverse=True)
        toxic = np.bincount(which, weights=labels[doc], minlength=len(entry)).astype(np.int64)
        every = np.bincount(which, minlength=len(entry))
        yield pa.RecordBatch.from_arrays([pa.array(entry.astype(np.int64)), pa.array(toxic), pa.array(every)], names=["entry", "toxic", "n"])


def _character_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIDE**3, np.int64)
    for batch in in_chunks(batches, "text"):
        total += trigram_counts(*buffers(batch.column("text")))
    yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=["counts"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Trigram model of all texts; the table has a row for each combination of three classes."""
    each = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_character_counts, "counts array<bigint>")
    counts = np.zeros(SIDE**3, np.int64)
    for place, n in each.select(F.posexplode("counts")).groupBy("pos").agg(F.sum("col")).collect():
        counts[place] = n
    return language_model(counts)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = SAMPLE) -> Model:
    """Lexicon from at most ``most`` labelled texts of each label that are not held out; characters from all texts."""
    sample, shares = labelled_sample(docs, labels, label, most)
    # Copies of one text would make its rare words look toxic. Copies have the same features, so any of them may stay.
    sample = sample.mapInArrow(_marked, "text string, label int, mark long").dropDuplicates(["mark", "label"])
    sample = stage(sample.select("text", "label"), "toxicity-sample")
    sizes = {int(r[0]): int(r[1]) for r in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    counted = sample.mapInArrow(_lexicon_counts, "entry long, toxic long, n long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    weight = F.log((F.col("toxic") + 0.1) / (toxic + 0.2)) - F.log((F.col("n") - F.col("toxic") + 0.5) / (clean + 1))
    # Twice the gain in log-likelihood over the base rate; rare entries can't look toxic by chance.
    base = min(max(toxic / max(1, toxic + clean), 1e-6), 1 - 1e-6)
    gain = lambda n, rate: F.when(n > 0, n * F.log(n / F.col("n") / rate)).otherwise(0.0)
    counted = counted.withColumn("g", 2 * (gain(F.col("toxic"), base) + gain(F.col("n") - F.col("toxic"), 1 - base)))
    kept = counted.where(F.col("g") >= SIGNIFICANCE).withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
    rows = sorted((int(np.int64(e).astype(np.uint64)), float(w)) for e, w in kept.orderBy(F.desc("weight"), "entry").limit(LEXICON).select("entry", "weight").collect())
    share = min(max(shares.get(1, 0.0), 1e-3), 1 - 1e-3)
    entries = np.array([e for e, _ in rows], np.uint64)
    return Model(entries, np.array([w for _, w in rows]), float(np.log(share / (1 - share))), character_model(docs))


def scored(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, score, predicted)`` for every row of ``docs (doc_id, text)``.

    A null text is scored as an empty one, and repeated rows alike. Without labelled rows all scores are low.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, str] = {}
        for batch in in_chunks(batches, "text"):
            score = shared.value.score(batch.column("text"), cache)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    made = only(docs, doc_id="long", text="string").mapInArrow(run, fields("doc_id long, score double"))
    return made.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
