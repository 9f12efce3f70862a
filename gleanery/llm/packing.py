"""Best-fit packing of tokenised documents by the linear grouping scheme.

Lengths are whole numbers up to the capacity, so a histogram of them, of bounded size, says all about the
problem. From it the driver makes the plan: large lengths are sorted, cut into groups of equal size, and
rounded up to the largest of their group; the few sizes left are packed by linear programming over
configurations (column generation); the actual lengths take the places of their groups; small lengths go,
longest first, into the bin they fit best. The plan gives intervals of ranks to each length. Spark ranks the pieces
of each length and looks their places up.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import only, placed, short_batches
from gleanery.llm.words import PART, in_chunks
from gleanery.session import stage

CAPACITY = 1024
END = 2
GROUPS = 48
SMALL = 8  # lengths up to capacity / SMALL are small
MAX_PIVOTS = 600

# Fixed value: how the tokenizer cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_IDS = ("ids", pa.list_(pa.int32()))
Bins = list[tuple[int, list[int]]]


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of a byte-level BPE vocabulary file of ``tokenizers``, with no special tokens added around a text.

    The same merges run in ``tiktoken``, which is several times faster; texts that hold one of the file's added
    tokens, which become its id, and texts that ``tiktoken`` can't take go to ``tokenizers``.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        self.path, self._slow = path, None
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters, special = _byte_letters(), {t["content"] for t in model["added_tokens"]}
        self._added = sorted(special)
        ranks = {bytes(letters[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        self._fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if any(token in text for token in self._added):
            return self.slow_ids(text)
        try:
            return self._fast.encode_ordinary(text)
        except BaseException as error:  # a panic of the library is no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit)):
                raise
            return self.slow_ids(text)

    def slow_ids(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow.encode(text, add_special_tokens=False).ids


_encoders: dict[str, Encoder] = {}


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: each text's ids and ``end``, cut if longer than ``capacity``.

    All pieces but a cut text's first have ``capacity`` ids. ``tokenizer`` is a path that every worker can read.
    """
    schema = _PIECES.append(pa.field(*_IDS)) if keep_ids else _PIECES
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer)
        encoder = _encoders[tokenizer]
        for batch in in_chunks(batches, "text", PART):
            out = {name: [] for name in schema.names}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array([*encoder.ids(text.as_py() or ""), end], "<u4")
                first = (len(ids) - 1) % capacity + 1
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(edges, edges[1:])):
                    part = ids[start:stop]
                    for name, value in zip(out, (doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32))):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return only(docs, doc_id="long", text="string").mapInArrow(run, shape)


def grouped(counts: list[tuple[int, int]], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Cut (length, count), longest first, into groups of equal count: (largest length, its lengths)."""
    total = sum(n for _, n in counts)
    size = -(-total // groups)
    out, room = [], 0
    for length, n in counts:
        while n:
            if not room:
                out.append((length, []))
                room = size
            take = min(room, n)
            out[-1][1].append((length, take))
            room, n = room - take, n - take
    merged: list[tuple[int, list[tuple[int, int]]]] = []
    for top, members in out:
        if merged and merged[-1][0] == top:
            merged[-1][1].extend(members)
        else:
            merged.append((top, members))
    return merged


def _best_configuration(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity."""
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(int(sizes.min()), capacity + 1):
        fits = np.where(sizes <= room, value[room - np.minimum(sizes, room)] + prices, 0.0)
        best = int(fits.argmax())
        value[room], last[room] = (fits[best], best) if fits[best] > value[room - 1] + 1e-12 else (value[room - 1], -2)
    config, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0 and last[room] != -1:
        if last[room] == -2:
            room -= 1
        else:
            config[last[room]] += 1
            room -= sizes[last[room]]
    return float(value[capacity]), config


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """(bins, items of each size) within the demand: the whole parts of a linear programme's optimum."""
    size, need = np.array(sizes), np.array(demand, float)
    basis = np.diag(capacity // size).astype(float)
    for _ in range(MAX_PIVOTS):
        prices = np.linalg.solve(basis.T, np.ones(len(size)))
        worth, config = _best_configuration(size, prices, capacity)
        if worth <= 1 + 1e-7:
            break
        amounts = np.linalg.solve(basis, need)
        column = np.linalg.solve(basis, config.astype(float))
        ratio = np.where(column > 1e-9, amounts / np.where(column > 1e-9, column, 1), np.inf)
        basis[:, int(ratio.argmin())] = config
    amounts = np.maximum(np.linalg.solve(basis, need), 0)
    left, out = np.array(demand), []
    for amount, config in zip(np.floor(amounts + 1e-9).astype(np.int64), basis.T.round().astype(np.int64)):
        bins = int(min(amount, *(left[config > 0] // config[config > 0]))) if config.any() else 0
        if bins > 0:
            out.append((bins, config.tolist()))
            left = left - bins * config
    return out


def _substituted(bins: int, config: list[int], members: list[list[list[int]]]) -> Bins:
    """Actual lengths in place of the groups' sizes, as runs of equal bins."""
    slots = []
    for i, many in enumerate(config):
        for _ in range(many):
            runs, want = [], bins
            while want:
                length, n = members[i][0]
                take = min(n, want)
                runs.append([length, take])
                members[i][0][1] -= take
                want -= take
                if not members[i][0][1]:
                    members[i].pop(0)
            slots.append(runs)
    out: Bins = []
    while bins:
        step = min(runs[0][1] for runs in slots)
        out.append((step, [runs[0][0] for runs in slots]))
        for runs in slots:
            runs[0][1] -= step
            if not runs[0][1]:
                runs.pop(0)
        bins -= step
    return out


def _best_fit(bins: Bins, lengths: list[tuple[int, int]], capacity: int) -> Bins:
    """Put (length, count), longest first, into the bins they fit best, and into new ones."""
    by_room: dict[int, Bins] = defaultdict(list)
    for many, inside in bins:
        by_room[capacity - sum(inside)].append((many, inside))
    for length, n in sorted(lengths, reverse=True):
        for room in range(length, capacity + 1):
            while n and by_room.get(room):
                many, inside = by_room[room].pop()
                take = min(n, many)
                n -= take
                by_room[room - length].append((take, [*inside, length]))
                if take < many:
                    by_room[room].append((many - take, inside))
        each = capacity // length
        if n >= each:
            by_room[capacity - each * length].append((n // each, [length] * each))
        if n % each:
            by_room[capacity - n % each * length].append((1, [length] * (n % each)))
    return [b for room in sorted(by_room) for b in by_room[room]]


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Bins:
    """Kinds of bins, (bins of this kind, lengths in it), that hold every length as often as it occurs.

    Rounding up leaves gaps. Bins whose gap, with actual lengths, is above a tolerance are given up, and their
    lengths join the small ones; of several tolerances the one with the fewest bins is taken.
    """
    full = histogram.get(capacity, 0)
    rest = sorted(((l, n) for l, n in histogram.items() if l < capacity and n), reverse=True)
    large = [(l, n) for l, n in rest if l * SMALL > capacity]
    small = [(l, n) for l, n in rest if l * SMALL <= capacity]
    made: Bins = []
    over: dict[int, int] = defaultdict(int)
    if large:
        parts = grouped(large, max(1, min(groups, sum(n for _, n in large) // 4)))
        members = [[list(m) for m in lengths] for _, lengths in parts]
        demand = [sum(n for _, n in lengths) for _, lengths in parts]
        for bins, config in configurations([top for top, _ in parts], demand, capacity):
            made += _substituted(bins, config, members)
        # What the whole parts of the optimum leave is at most a few bins for each size.
        for length, n in (m for group in members for m in group):
            over[length] += n
    plans = []
    for tolerance in (0, capacity // 256, capacity // 64, capacity):
        pool = over.copy()
        for bins, inside in made:
            for length in inside if capacity - sum(inside) > tolerance else ():
                pool[length] += bins
        kept = [b for b in made if capacity - sum(b[1]) <= tolerance]
        plans.append(_best_fit(kept, small + list(pool.items()), capacity))
    best = min(plans, key=lambda plan: sum(bins for bins, _ in plan))
    return ([(full, [capacity])] if full else []) + best


def placements(plan: Bins) -> dict[str, np.ndarray]:
    """For each length and first rank: how its ranks map to sequences, and the offset there."""
    ranks: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for bins, lengths in plan:
        offset = 0
        for length in lengths:
            rows.append((length, ranks[length], sequence, offset))
            ranks[length] += bins
            offset += length
        sequence += bins
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "sequence", "offset"), columns))


def _place(table: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(table["length"], length)
            until = np.searchsorted(table["length"], length, side="right")
            # Intervals of one length are consecutive; find the last that starts at or before the rank.
            while (open_ := until - at > 1).any():
                middle = (at + until) // 2
                before = table["rank"][np.minimum(middle, len(table["rank"]) - 1)] <= rank
                at, until = np.where(open_ & before, middle, at), np.where(open_ & ~before, middle, until)
            sequence = table["sequence"][at] + rank - table["rank"][at]
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(table["offset"][at])],
                names=[*kept, "sequence_id", "offset"],
            )

    return run


def packed(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ...) with ``sequence_id`` and ``offset``.

    Lengths are from 1 to ``capacity``; equal rows are placed one by one. ``pieces`` is staged, as its
    histogram (``capacity`` rows at most) and its ranks both need it.
    """
    with short_batches(pieces.sparkSession):
        pieces = stage(pieces, "pieces")
    histogram = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}
    plan = packing_plan(histogram, capacity, groups)
    ranked = placed(pieces.withColumn("_one", F.lit(1)), ["length"], ["doc_id", "piece", "start", "ids_crc32"], "_one", sum(histogram.values()), "rank")
    ranked = ranked.drop("_one")
    shape = ranked.drop("rank").withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return ranked.mapInArrow(_place(placements(plan)), shape)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """Every row of ``docs (doc_id, text)`` as pieces in sequences of at most ``capacity`` ids.

    Null and empty texts are the ``end`` id alone; rows without doc_id are packed too; other columns are ignored.
    """
    return packed(pieces_of(docs, tokenizer, capacity, end, keep_ids), capacity)
