"""Alignment of two tokenizers' tokens by merging their byte ends along a merge path.

A text's ends in tokenizer A and in tokenizer B are two sorted lists. Their merge is cut on diagonals, found by
binary search, into pieces of equal work that need nothing of each other but one token of lookahead. A piece emits
the overlaps of its ends and the groups that it closes; what it leaves open at its borders is stitched afterwards.
Short texts are a piece each and stay where they are; the pieces of long ones are dealt to all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import only, short_batches
from gleanery.llm.packing import Encoder, _byte_letters
from gleanery.llm.words import in_chunks
from gleanery.session import fan_out, stage

PIECE = 65_536  # merged ends
REMEMBERED = 300_000  # words whose tokens a worker keeps
RUN = 2048  # new words that are encoded at once
PENDING = 4_000_000  # pairs that a task gathers before it passes on their counts
FREQUENT = 1_000_000  # pairs whose counts go to every task; the others are joined
SPACE = "▁"  # stands for a space in pieces

DIGEST = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, pairs binary, times binary"
SLICE = (
    "piece int, own_a int, own_b int, before long, start_a long, start_b long, "
    "a_ids binary, a_sizes binary, b_ids binary, b_sizes binary"
)
MERGED = (
    "row long, doc_id long, piece int, n_a long, n_b long, n_groups long, n_links long, head_a binary, head_b binary, "
    "body string, tail_a binary, tail_b binary, pairs binary, times binary"
)


class PlainEncoder(Encoder):
    """Ids of a byte-level vocabulary; the strings of its special tokens are ordinary text."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self._added = []

    def slow_ids(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.encode_special_tokens = True
        return self._slow.encode(text, add_special_tokens=False).ids

    def token_bytes(self) -> list[bytes]:
        import json

        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _byte_letters()
        vocab = model["model"]["vocab"] | {t["content"]: t["id"] for t in model["added_tokens"]}
        out = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        return out


class Pieces:
    """Ids of a sentencepiece model, which adds the space in front by itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self._space = self._model.piece_to_id(SPACE)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1) if texts else []

    def after_line(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that start with a line end and follow other text, so without a space in front."""
        found = self.ids(texts)
        return [ids[1:] if ids[:1] == [self._space] else [] for ids in found]

    def token_bytes(self) -> list[bytes]:
        model = self._model
        shown = lambda i: model.id_to_piece(i).replace(SPACE, " ").encode()
        return [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else shown(i) for i in range(model.get_piece_size())]

    def words_apart(self) -> bool:
        """Whether no piece goes on behind a space that follows something else: then words can be encoded one by one."""
        pieces = (self._model.id_to_piece(i).lstrip(SPACE) for i in range(self._model.get_piece_size()))
        return not any(SPACE in p or "\n" in p for p in pieces)


class Side(NamedTuple):
    """Tokens of several texts: ids, ends (bytes, running over all texts), and each text's first token."""

    ids: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def only(self, texts: np.ndarray) -> Side:
        counts = np.diff(self.first)
        keep = np.repeat(texts, counts)
        return Side(self.ids[keep], self.ends[keep], np.concatenate([[0], np.cumsum(np.where(texts, counts, 0))]))

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Both:
    """Tokens of texts by both tokenizers.

    A text whose words have one space or line end between them is encoded word by word: no token of either side
    spans a word's start, so each distinct word is encoded once and remembered. Other texts are encoded whole.
    """

    def __init__(self, a_path: str, b_path: str, remembered: int = REMEMBERED) -> None:
        self.a, self.b, self.remembered = PlainEncoder(a_path), Pieces(b_path), remembered
        self.bytes = self.a.token_bytes(), self.b.token_bytes()
        self.lengths = [np.array([len(t) for t in side], np.int64) for side in self.bytes]
        self.width = len(self.bytes[1])
        self.splits = self.b.words_apart()
        # What stands for a token in the text of the groups: with a comma, or with what follows a group's last.
        self.shown = [f"{i}{after}" for side, last in zip(self.bytes, "|;") for i in range(len(side)) for after in ("," + last)]
        self.pair = np.uint32 if len(self.bytes[0]) * self.width < 2**32 else np.uint64
        self._forget()

    def _forget(self) -> None:
        self._place: dict[str, int] = {}
        self._good = np.zeros(0, bool)
        self._known = [(np.zeros(0, np.int32), np.zeros(1, np.int64)) for _ in range(2)]

    def _learn(self, words: list[str]) -> None:
        """Remember the tokens of words, encoded in runs; a run that doesn't fall apart at its words goes word by word."""
        spaced = [w for w in words if w[0] != "\n"]
        lined = [w for w in words if w[0] == "\n"]
        for at in range(0, max(len(spaced), 1), RUN):
            run = spaced[at : at + RUN]
            if run and at + RUN >= len(spaced):
                run, lined = run + lined, []
            if run:
                self._remember(run, self._run(run) or self._one_by_one(run))
        if lined:
            self._remember(lined, self._one_by_one(lined))

    def _remember(self, words: list[str], found: tuple[list, np.ndarray]) -> None:
        sides, good = found
        self._place |= zip(words, range(len(self._place), len(self._place) + len(words)))
        self._good = np.append(self._good, good)
        for k, (ids, counts) in enumerate(sides):
            flat, first = self._known[k]
            self._known[k] = np.append(flat, ids), np.append(first, np.cumsum(counts) + first[-1])

    def _run(self, words: list[str]) -> tuple[list, np.ndarray] | None:
        texts = [w if w[0] == "\n" else " " + w for w in words]
        whole = "".join(texts)
        edges = np.cumsum([len(t.encode()) for t in texts])
        sides = []
        for k, ids in enumerate((self.a.ids(whole), self.b.ids([whole[1:]])[0])):
            ends = np.cumsum(self.lengths[k][ids])
            at = np.searchsorted(ends, edges)
            if self.joined(k, ids) != whole.encode() or not np.array_equal(ends[at], edges):
                return None
            sides.append((np.array(ids, np.int32), np.diff(at + 1, prepend=0)))
        return sides, np.ones(len(words), bool)

    def _one_by_one(self, words: list[str]) -> tuple[list, np.ndarray]:
        spaced = [w for w in words if w[0] != "\n"]
        lined = [w for w in words if w[0] == "\n"]
        in_b = dict(zip(spaced, self.b.ids(spaced))) | dict(zip(lined, self.b.after_line(lined)))
        texts = [w if w[0] == "\n" else " " + w for w in words]
        sides = [self.a.ids(t) for t in texts], [in_b[w] for w in words]
        good = [all(self.joined(k, sides[k][n]) == t.encode() for k in (0, 1)) for n, t in enumerate(texts)]
        flat = [(np.array([t for i in side for t in i], np.int32), [len(i) for i in side]) for side in sides]
        return flat, np.array(good, bool)

    def joined(self, side: int, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes[side].__getitem__, ids))

    def _words(self, text: str) -> list[str] | None:
        if not self.splits:
            return None
        words = text.split()
        gaps = text.count(" ") + text.count("\n")
        if len(words) != gaps + 1 or len(text) - sum(map(len, words)) != gaps:
            return None
        return text.replace("\n", " \n").split(" ")

    def _whole(self, text: str) -> tuple[list[int], list[int]]:
        wanted = (" " + text).encode()
        ids = self.a.ids(" " + text), self.b.ids([text])[0]
        return ids if all(self.joined(k, ids[k]) == wanted for k in (0, 1)) else ([], [])

    def encode(self, texts: list[str | None]) -> list[Side]:
        """A's and B's tokens; texts that are null, empty or not restored by their tokens have none."""
        if len(self._place) > self.remembered:
            self._forget()
        split = [self._words(t) if t else None for t in texts]
        new = {w: None for words in split for w in words or () if w not in self._place}
        if new:
            self._learn(list(new))
        places = [np.fromiter(map(self._place.__getitem__, words), np.int64, len(words)) if words else None for words in split]
        parts: tuple[list, list] = ([], [])
        counts = np.zeros((2, len(texts)), np.int64)
        for n, (text, at) in enumerate(zip(texts, places)):
            by_word = at is not None and self._good[at].all()
            whole = self._whole(text) if text and not by_word else ([], [])
            for k, (flat, first) in enumerate(self._known):
                if by_word:
                    sizes = first[at + 1] - first[at]
                    shift = first[at] - np.cumsum(sizes) + sizes
                    ids = flat[np.repeat(shift, sizes) + np.arange(sizes.sum())]
                else:
                    ids = np.array(whole[k], np.int32)
                parts[k].append(ids)
                counts[k, n] = len(ids)
        out = []
        for k in (0, 1):
            ids = np.concatenate(parts[k]) if parts[k] else np.zeros(0, np.int32)
            out.append(Side(ids, np.cumsum(self.lengths[k][ids]), np.concatenate([[0], np.cumsum(counts[k])])))
        return out


def diagonal(a: np.ndarray, b: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """How many of the first ``steps`` ends of the merge are A's, for each of ``steps``; of equal ends A's comes first."""
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (searching := low < high).any():
        middle = (low + high) // 2
        earlier = a[np.minimum(middle, len(a) - 1)] <= b[np.clip(steps - middle - 1, 0, len(b) - 1)]
        low, high = np.where(searching & earlier, middle + 1, low), np.where(searching & ~earlier, middle, high)
    return low


class Merge(NamedTuple):
    """Of a piece: A and B ids of each overlap, which of A's or B's ends made it, and how many ends precede each cut."""

    a: np.ndarray
    b: np.ndarray
    by_a: np.ndarray
    by_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


def merge(a_ids, a_ends, b_ids, b_ends, own_a: int, own_b: int, before: int) -> Merge:
    """Merge the first ``own_a`` and ``own_b`` ends; one more token on a side is the one that goes on behind the piece.

    ``before`` is A's last end in front of the piece. Every end closes one overlap, an end of both sides only once,
    under A; the cut of a group belongs to B's end.
    """
    mine, theirs = a_ends[:own_a], b_ends[:own_b]
    over_a, over_b = np.searchsorted(theirs, mine), np.searchsorted(mine, theirs)
    shared = theirs == before
    inside = over_b < own_a
    shared[inside] |= mine[over_b[inside]] == theirs[inside]
    alone = np.flatnonzero(~shared)
    return Merge(
        np.concatenate([a_ids[:own_a], a_ids[over_b[alone]]]),
        np.concatenate([b_ids[over_a], b_ids[alone]]),
        np.arange(own_a), alone,
        np.searchsorted(mine, theirs[shared], side="right"), np.flatnonzero(shared) + 1,
    )


def _shown(both: Both, a_ids: np.ndarray, b_ids: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[str]:
    """The tokens of whole groups as text, group after group, with what separates them."""
    codes = np.empty(len(a_ids) + len(b_ids), np.int64)
    starts_b = cut_b - np.diff(cut_b, prepend=0)
    for ids, cuts, other, base in ((a_ids, cut_a, starts_b, 0), (b_ids, cut_b, cut_a, 2 * len(both.bytes[0]))):
        sizes = np.diff(cuts, prepend=0)
        last = np.zeros(len(ids), np.int64)
        last[cuts[sizes > 0] - 1] = 1
        codes[np.arange(len(ids)) + np.repeat(other, sizes)] = base + 2 * ids.astype(np.int64) + last
    return list(map(both.shown.__getitem__, codes.tolist()))


def _counted(both: Both, group: np.ndarray, a: np.ndarray, b: np.ndarray, groups: int) -> tuple[list[bytes], list[bytes]]:
    """Of each group its distinct pairs, sorted, and how often each is in it."""
    shift = np.uint64(40)
    if both.pair is np.uint32:
        keys, times = np.unique(group.astype(np.uint64) << shift | a.astype(np.uint64) * np.uint64(both.width) + b.astype(np.uint64), return_counts=True)
        edges = np.searchsorted(keys, np.arange(groups + 1, dtype=np.uint64) << shift)
        pairs = (keys & np.uint64(2**32 - 1)).astype(np.uint32)
        spans = list(zip(edges, edges[1:]))
        return [pairs[x:y].tobytes() for x, y in spans], [times[x:y].astype(np.uint32).tobytes() for x, y in spans]
    out = [np.unique(a[group == g].astype(np.uint64) * np.uint64(both.width) + b[group == g].astype(np.uint64), return_counts=True) for g in range(groups)]
    return [p.tobytes() for p, _ in out], [t.astype(np.uint32).tobytes() for _, t in out]


_workers: dict[tuple, Both] = {}


def _both(paths: tuple[str, str]) -> Both:
    if paths not in _workers:
        _workers[paths] = Both(*paths)
    return _workers[paths]


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split() for column in ddl.split(","))])


def _slices(a: Side, b: Side, text: int, size: int) -> Iterator[dict]:
    """The pieces of one text; ends are kept as sizes of tokens behind a start."""
    (a_ids, a_ends), (b_ids, b_ends) = ((s.ids[s.first[text] : s.first[text + 1]], s.ends[s.first[text] : s.first[text + 1]]) for s in (a, b))
    total = len(a_ids) + len(b_ids)
    steps = np.append(np.arange(0, total, size), total)
    in_a = diagonal(a_ends, b_ends, steps)
    in_b = steps - in_a
    for piece, (x, x_end, y, y_end) in enumerate(zip(in_a, in_a[1:], in_b, in_b[1:])):
        before = int(a_ends[x - 1]) if x else -1
        out = {"piece": piece, "own_a": int(x_end - x), "own_b": int(y_end - y), "before": before}
        for name, ids, ends, first, last in (("a", a_ids, a_ends, x, x_end + 1), ("b", b_ids, b_ends, y, y_end + 1)):
            start = int(ends[first - 1]) if first else 0
            out |= {f"start_{name}": start, f"{name}_ids": _small(ids[first:last]), f"{name}_sizes": _small(np.diff(ends[first:last], prepend=start))}
        yield out


def _small(numbers: np.ndarray) -> bytes:
    """As 16-bit numbers where they fit, after a mark of their width."""
    kind = np.uint16 if len(numbers) == 0 or numbers.max() < 2**16 else np.uint64
    return bytes([kind().itemsize]) + numbers.astype(kind).tobytes()


def _read(small: bytes) -> np.ndarray:
    return np.frombuffer(small, np.uint16 if small[0] == 2 else np.uint64, offset=1).astype(np.int64)


def _ends(row: dict, side: str) -> np.ndarray:
    return np.cumsum(_read(row[f"{side}_sizes"])) + row[f"start_{side}"]


def _tokenised(paths: tuple[str, str], size: int, keep_groups: bool):
    schema = _arrow(f"{DIGEST}, {SLICE}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _both(paths)
        for batch in in_chunks(batches, "text"):
            names = [{"row": r, "doc_id": d} for r, d in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist())]
            a, b = both.encode(batch.column("text").to_pylist())
            n_a, n_b = np.diff(a.first), np.diff(b.first)
            long = n_a + n_b > size
            for text in np.flatnonzero(long):
                for part in _slices(a, b, text, size):
                    yield _batch([names[text] | part], schema)
            a, b = a.only(~long), b.only(~long)
            found = merge(a.ids, a.ends, b.ids, b.ends, len(a.ids), len(b.ids), -1)
            parts = _shown(both, a.ids, b.ids, found.cut_a, found.cut_b)
            text_b = b.text_of()
            group = np.concatenate([a.text_of()[found.by_a], text_b[found.by_b]])
            pairs, times = _counted(both, group, found.a, found.b, len(names))
            links = np.bincount(group, minlength=len(names))
            groups = np.bincount(text_b[found.cut_b - 1], minlength=len(names))
            edges = a.first + b.first
            rows = []
            for text in np.flatnonzero(~long):
                shown = "".join(parts[edges[text] : edges[text + 1]])[:-1]
                rows.append(names[text] | {
                    "n_a": int(n_a[text]), "n_b": int(n_b[text]), "n_groups": int(groups[text]), "n_links": int(links[text]),
                    "groups": shown if keep_groups else None, "groups_sha256": _digest(shown), "pairs": pairs[text], "times": times[text],
                })
            yield _batch(rows, schema)

    return run


def _digest(shown: str) -> str:
    return hashlib.sha256(shown.encode()).hexdigest() if shown else ""


def _merged(paths: tuple[str, str]):
    schema = _arrow(MERGED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _both(paths)
        for batch in batches:
            for row in batch.to_pylist():
                a_ids, b_ids = _read(row["a_ids"]), _read(row["b_ids"])
                a_ends, b_ends = _ends(row, "a"), _ends(row, "b")
                own_a, own_b = row["own_a"], row["own_b"]
                found = merge(a_ids, a_ends, b_ids, b_ends, own_a, own_b, row["before"])
                pairs, times = _counted(both, np.zeros(len(found.a), np.int64), found.a, found.b, 1)
                out = {k: row[k] for k in ("row", "doc_id", "piece")}
                out |= {"n_a": own_a, "n_b": own_b, "n_groups": len(found.cut_a), "n_links": len(found.a), "pairs": pairs[0], "times": times[0]}
                first_a, first_b, last_a, last_b = own_a, own_b, own_a, own_b
                if len(found.cut_a):
                    first_a, first_b, last_a, last_b = (int(c[n]) for n in (0, -1) for c in (found.cut_a, found.cut_b))
                body = _shown(both, a_ids[first_a:last_a], b_ids[first_b:last_b], found.cut_a[1:] - first_a, found.cut_b[1:] - first_b)
                out |= {"head_a": _small(a_ids[:first_a]), "head_b": _small(b_ids[:first_b]), "body": "".join(body)}
                out |= {"tail_a": _small(a_ids[last_a:own_a]), "tail_b": _small(b_ids[last_b:own_b])}
                yield _batch([out], schema)

    return run


def stitched(parts: pd.DataFrame) -> str:
    """The groups of a text from its pieces: what a piece leaves open is closed by the first cut behind it."""
    out: list[str] = []
    open_a: list[int] = []
    open_b: list[int] = []
    for part in parts.sort_values("piece").itertuples():
        open_a += _read(part.head_a).tolist()
        open_b += _read(part.head_b).tolist()
        if part.n_groups:
            out += [",".join(map(str, open_a)), "|", ",".join(map(str, open_b)), ";", part.body]
            open_a, open_b = _read(part.tail_a).tolist(), _read(part.tail_b).tolist()
    return "".join(out)[:-1]


def _stitch(kind: type, keep_groups: bool):
    def run(parts: pd.DataFrame) -> pd.DataFrame:
        shown = stitched(parts)
        pairs = np.concatenate([np.frombuffer(p, kind) for p in parts["pairs"]])
        times = np.concatenate([np.frombuffer(t, np.uint32) for t in parts["times"]])
        pairs, at = np.unique(pairs, return_inverse=True)
        times = np.bincount(at, times, len(pairs)).astype(np.uint32)
        out = {c: [parts[c].iloc[0]] for c in ("row", "doc_id")} | {c: [parts[c].sum()] for c in ("n_a", "n_b", "n_groups", "n_links")}
        out |= {"groups": [shown if keep_groups else None], "groups_sha256": [_digest(shown)], "pairs": [pairs.tobytes()], "times": [times.tobytes()]}
        return pd.DataFrame(out).astype({"doc_id": "Int64"})

    return run


def _documents_of_pairs(kind: type, pending: int):
    """Counts of pairs over the texts of a task, as a partial sum."""
    schema = _arrow("pair long, docs long")

    def summed(pairs: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        pair, at = np.unique(np.concatenate(pairs), return_inverse=True)
        return pair, np.bincount(at, np.concatenate(docs), len(pair)).astype(np.int64)

    def rows(pair: np.ndarray, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(pair), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(pair[part].astype(np.int64)), pa.array(docs[part])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weights, size = [], [], 0
        for batch in batches:
            for value in batch.column("pairs"):
                held.append(np.frombuffer(value.as_py(), kind))
                weights.append(np.ones(len(held[-1]), np.int64))
                size += len(held[-1])
                if size > pending:
                    pair, docs = summed(held, weights)
                    if len(pair) > pending // 2:
                        yield from rows(pair, docs)
                        pair, docs = pair[:0], docs[:0]
                    held, weights, size = [pair], [docs], len(pair)
        if size:
            yield from rows(*summed(held, weights))

    return run


def _looked_up(kind: type, shared):
    """Sums over the links whose pairs are frequent, and the other pairs themselves."""
    ddl = "row long, sum_known long, best_known long"
    schema = _arrow(ddl).append(pa.field("pairs", pa.list_(pa.int64()))).append(pa.field("times", pa.list_(pa.int64())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = shared.value
        for batch in batches:
            rows = []
            for row, pairs, times in zip(*(batch.column(c).to_pylist() for c in ("row", "pairs", "times"))):
                pair, n = np.frombuffer(pairs, kind).astype(np.int64), np.frombuffer(times, np.uint32).astype(np.int64)
                at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
                hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                at = at[hit]
                rows.append({
                    "row": row, "sum_known": int((n[hit] * docs[at]).sum()), "best_known": int(n[hit][best[at]].sum()),
                    "pairs": pair[~hit], "times": n[~hit],
                })
            yield _batch(rows, schema)

    return run


def _frequent_from(counts: DataFrame, limit: int) -> tuple[int, int]:
    """Least number of documents, a power of two, that at most ``limit`` pairs reach; how many pairs don't."""
    bits = sorted(((r["bits"], r["n"]) for r in counts.groupBy(F.length(F.bin("docs")).alias("bits")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, 1 << 62
    for at, n in bits:
        if total + n > limit:
            break
        total, least = total + n, 1 << (at - 1)
    return least, sum(n for _, n in bits) - total


def tokens_merged(docs: DataFrame, a_path: str, b_path: str, piece: int = PIECE, keep_groups: bool = False) -> DataFrame:
    """One staged row for each row of ``docs (doc_id, text)``: counts, groups, and its distinct pairs as sorted numbers."""
    spark, paths = docs.sparkSession, (a_path, b_path)
    rows = fan_out(only(docs, doc_id="long", text="string")).withColumn("row", F.monotonically_increasing_id())
    with short_batches(spark, 256):
        made = stage(rows.mapInArrow(_tokenised(paths, piece, keep_groups), f"{DIGEST}, {SLICE}"), "tokens")
    names = _arrow(DIGEST).names
    whole = made.where("piece is null").select(*names)
    slices = made.where("piece is not null").drop(*(n for n in names if n not in ("row", "doc_id")))
    n_slices = slices.count()
    if not n_slices:
        return whole
    with short_batches(spark, 16):
        dealt = slices.repartition(max(1, min(n_slices, 4 * spark.sparkContext.defaultParallelism)), "row", "piece")
        merged = dealt.mapInArrow(_merged(paths), MERGED)
        kind = _pair_type(paths)
        long = stage(merged.groupBy("row").applyInPandas(_stitch(kind, keep_groups), DIGEST), "stitched")
    return whole.unionByName(long)


def _pair_type(paths: tuple[str, str]) -> type:
    return _both(paths).pair


def _width(paths: tuple[str, str]) -> int:
    return _both(paths).width


def pair_counts(merged: DataFrame, a_path: str, b_path: str, pending: int = PENDING) -> DataFrame:
    """``(pair, docs, best)``, staged: how many rows hold a pair linked, and whether no pair of its A id is in more.

    ``pair`` is A id times the size of B's vocabulary plus B id. Tasks add up their texts before the exchange.
    """
    paths = (a_path, b_path)
    a_id = F.expr(f"pair div {_width(paths)}")
    with short_batches(merged.sparkSession, 256):
        partial = merged.select("pairs").mapInArrow(_documents_of_pairs(_pair_type(paths), pending), "pair long, docs long")
        counts = stage(partial.groupBy("pair").agg(F.sum("docs").alias("docs")), "pairs").withColumn("a", a_id)
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return stage(counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pair-counts")


def aligned(
    docs: DataFrame, a_path: str, b_path: str, piece: int = PIECE, frequent: int = FREQUENT, keep_groups: bool = False, pending: int = PENDING
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups])`` for each row of ``docs``.

    A is a byte-level vocabulary file of ``tokenizers`` on a space and the text, B a ``sentencepiece`` model that adds the
    space. Groups are cut where tokens of both end, as text ``a1,a2|b1;a3|b2,b3``. Links are the overlapping A-B
    token pairs; a pair's count is the number of rows of ``docs`` that hold it linked, n_best the links whose count is the
    highest of their A id, ties included. Null and empty texts, and texts whose tokens don't restore them, have
    zeros and empty groups. Rows are taken one by one: a repeated doc_id, or a null one, is judged like others. Columns
    other than ``doc_id`` and ``text`` are ignored.

    Counts of the ``frequent`` most frequent pairs at most go to every task; the others, of which each is in few rows, are
    joined.
    """
    spark, paths = docs.sparkSession, (a_path, b_path)
    merged = tokens_merged(docs, a_path, b_path, piece, keep_groups)
    counts = pair_counts(merged, a_path, b_path, pending)
    least, others = _frequent_from(counts, frequent)
    known = counts.where(F.col("docs") >= least).toPandas().sort_values("pair")
    table = (known["pair"].to_numpy(np.int64), known["docs"].to_numpy(np.int64), known["best"].to_numpy(bool))
    shared = spark.sparkContext.broadcast(table)
    with short_batches(spark, 256):
        looked = merged.select("row", "pairs", "times").mapInArrow(
            _looked_up(_pair_type(paths), shared), "row long, sum_known long, best_known long, pairs array<bigint>, times array<bigint>"
        )
        sums = stage(looked, "links")
    if others:
        rare = sums.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.pairs", "link.times")
        rare = rare.join(counts.where(F.col("docs") < least), rare["pairs"] == counts["pair"])
        rare = rare.groupBy("row").agg(
            F.sum(F.col("times") * F.col("docs")).alias("sum_rare"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_rare")
        )
        sums = sums.drop("pairs", "times").join(rare, "row", "left")
    else:
        sums = sums.withColumn("sum_rare", F.lit(0)).withColumn("best_rare", F.lit(0))
    total = lambda what: (F.col(f"{what}_known") + F.coalesce(F.col(f"{what}_rare"), F.lit(0))).cast("long")
    sums = sums.select("row", total("best").alias("n_best"), total("sum").alias("count_sum"))
    shown = ["groups_sha256", *["groups"] * keep_groups]
    return merged.join(sums, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", *shown)
