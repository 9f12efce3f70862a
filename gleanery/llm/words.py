"""Words of Arrow text columns as numpy arrays: positions and 64-bit fingerprints, without a Python string per word.

A word is ``[^\\x20\\x09-\\x0D]+``. Fingerprints are sums of random byte values times powers of an odd
number, modulo 2**64, then mixed; sequences of words are fingerprinted the same way. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20  # bytes that are fingerprinted at once
PART = SEGMENT // 4  # bytes of text for work that holds many times its text, as worker processes keep their peak
ROWS = 1 << 14  # rows of a batch at most
_MULT = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(256, dtype=np.uint64), 7)
_ASCII_LOWER = np.arange(256)
_ASCII_LOWER[65:91] += 32
_LOWER_BYTES = _BYTES[_ASCII_LOWER]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse."""
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _powers:
        base = np.full(size, _MULT)
        inverse = np.full(size, np.uint64(pow(int(_MULT), -1, 2**64)))
        base[0] = inverse[0] = 1
        _powers[size] = np.multiply.accumulate(base), np.multiply.accumulate(inverse)
    base, inverse = _powers[size]
    return base[:n], inverse[:n]


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of ``values[start:end]`` for each span; equal content gives equal numbers anywhere."""
    base, inverse = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * base[:-1], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts]


@dataclass
class Words:
    """Words of several texts: ``first[d]`` to ``first[d + 1]`` are those of text ``d``."""

    data: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[places[0] : places[-1]], places - places[0]


def words_of(column: pa.Array, lower: bool = False, gaps: np.ndarray = _SPACE) -> Words:
    """All words of a text column; ``lower`` folds A-Z before fingerprinting, ``gaps`` marks the bytes between words."""
    data, offsets = buffers(column)
    gap = np.ones(len(data) + 1, bool)
    np.take(gaps, data, out=gap[:-1])
    begins = ~gap[:-1]
    inside = begins.copy()
    begins[1:] &= gap[:-2]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    start = np.flatnonzero(begins)
    # A word ends before a gap or where the next text begins.
    ends = inside & gap[1:]
    lasts = edges[1:] - 1
    ends[lasts] = inside[lasts]
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    return Words(data, first, start, end, byte_hashes(data, start, end, lower))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """Fingerprints of byte spans, given in order of their starts; the same as of words."""
    values, out, done = _LOWER_BYTES if lower else _BYTES, np.empty(len(starts), np.uint64), 0
    while done < len(starts):
        upto = max(done + 1, int(np.searchsorted(starts, starts[done] + SEGMENT)))
        low, high = int(starts[done]), int(ends[done:upto].max())
        out[done:upto] = spans_hash(values[data[low:high]], starts[done:upto] - low, ends[done:upto] - low)
        done = upto
    return mix(out)


def in_chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = 2 * SEGMENT) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, a longer text alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(lengths)
        done = 0
        while done < batch.num_rows:
            spent = total[done - 1] if done else 0
            upto = max(done + 1, min(done + ROWS, int(np.searchsorted(total, spent + size, side="right"))))
            yield batch.slice(done, upto - done)
            done = upto


def sequences(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index and fingerprint of every run of ``n`` words inside one text."""
    count = len(words.start)
    if count < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = np.repeat(words.first[1:], np.diff(words.first))
    index = np.flatnonzero(np.arange(count) + n <= last)
    return index, mix(spans_hash(words.hash, index, index + n), n)
