"""Passages that occur more than once, by seed and extend on winnowed anchors.

Seeds: of all runs of ``ANCHOR`` words in a window of ``length`` words, the one with the least fingerprint is
the window's anchor, so equal windows have the same anchor at the same place. Documents meet on anchors.
Extension: each anchor carries the fingerprints of its context, extended left and right to ``length`` words in
every way that keeps it the anchor. Two occurrences of an anchor match over at least ``length`` words around it
exactly where such an extension is equal. Adjoining matches are merged into maximal repeats. Two words of 64 bits
must agree, those of the anchor and of the extension, so chance makes no match at any size of a corpus.

A task sends each distinct extension once, so a passage in very many documents is a few entries per task, not
one per document; pairs of occurrences are never formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.buckets import bucket_count, bucket_of, dealt
from gleanery.llm.common import checked, only, short_batches, small_enough, staged_count
from gleanery.llm.words import SEGMENT, in_chunks, mix, sequences, spans_hash, words_of
from gleanery.session import stage

LENGTH = 35
ANCHOR = 8
FLUSH_WORDS = 100_000  # words whose windows a task holds at once

_PACKED = pa.schema([("bucket", pa.int32()), ("rows", pa.binary()), ("windows", pa.binary())])
_SPANS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
_ROW = np.dtype([("anchor", np.uint64), ("doc", np.int64), ("start", np.int64), ("count", np.int32), ("known", np.int32)])


def windows_of(words, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word, fingerprint, anchor place and anchor fingerprint of every window inside one text."""
    index, hashes = sequences(words, length)
    if not len(index):
        return index, hashes, index, hashes
    grams = mix(spans_hash(words.hash, np.arange(len(words.hash) - anchor + 1), np.arange(anchor, len(words.hash) + 1)), 21)
    least = np.lib.stride_tricks.sliding_window_view(grams, length - anchor + 1)[index].argmin(axis=1)
    place = index + least
    return index, hashes, place, grams[place]


def _fresh(*columns: np.ndarray) -> np.ndarray:
    """Rows of sorted columns that differ from the row before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _seed(length: int, anchor: int, buckets: int):
    """Runs of windows with one anchor, as rows (anchor, document, first window, windows, known).

    Bit i of ``known`` is set if this task saw the i-th window elsewhere too. A window that occurs
    several times in a task is sent once; the other occurrences are sent as already known, without it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            anchors, docs, starts, places, hashes = (np.concatenate(x) for x in zip(*parts))
            parts.clear()
            pa.default_memory_pool().release_unused()
            order = np.lexsort((hashes, anchors))
            head = _fresh(anchors[order], hashes[order])
            single = head.copy()
            single[:-1] &= head[1:]
            known, sent = np.empty(len(head), bool), np.empty(len(head), bool)
            known[order], sent[order] = ~single, head
            # A run has one anchor and unbroken windows, either all sent or all known and not sent again.
            cut = np.ones(len(docs), bool)
            cut[1:] = (places[1:] != places[:-1]) | (docs[1:] != docs[:-1]) | (starts[1:] != starts[:-1] + 1) | (sent[1:] != sent[:-1])
            at = np.flatnonzero(cut)
            count = np.diff(np.append(at, len(docs)))
            rows = np.empty(len(at), _ROW)
            rows["anchor"], rows["doc"], rows["start"] = anchors[at], docs[at], starts[at]
            bits = known.astype(np.int64) << (np.arange(len(docs)) - np.repeat(at, count))
            rows["known"] = np.add.reduceat(bits, at)
            rows["count"] = np.where(sent[at], count, -count)
            to = bucket_of(rows["anchor"], buckets)
            # What is only known needs no meeting and may go to any bucket.
            to = np.where(sent[at], to, bucket_of(mix(rows["doc"].astype(np.uint64)), buckets))
            order = np.argsort(to, kind="stable")
            of_window = np.repeat(np.argsort(order), count)
            moved = hashes[np.argsort(of_window, kind="stable")]
            keep = np.repeat(sent[at][order], count[order])
            moved, width = moved[keep], np.where(sent[at], count, 0)[order]
            ends = np.concatenate([[0], np.cumsum(width)])
            sizes = np.bincount(to, minlength=buckets)
            begin = 0
            for bucket in np.flatnonzero(sizes):
                end = begin + sizes[bucket]
                packed = rows[order[begin:end]].tobytes(), moved[ends[begin] : ends[end]].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((bucket, *packed), _PACKED.types)], schema=_PACKED)
                begin = end

        for batch in in_chunks(batches, "text", SEGMENT // 2):
            words = words_of(batch.column("text"))
            starts, hashes, places, anchors = windows_of(words, length, anchor)
            if not len(starts):
                continue
            docs = np.searchsorted(words.first, starts, side="right") - 1
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[docs]
            parts.append((anchors, ids, starts - words.first[docs], places + held, hashes))
            held += len(words.hash)
            if held > FLUSH_WORDS:
                yield from flush()
                held = 0
        yield from flush()

    return run


def _extend(length: int):
    def run(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x.as_buffer(), _ROW) for x in table["rows"]])
        windows = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table["windows"]])
        count = np.abs(rows["count"])
        sent = np.where(rows["count"] > 0, count, 0)
        # Seeds: anchors that occur in more than one run; the rest has nothing to extend.
        _, which, often = np.unique(rows["anchor"], return_inverse=True, return_counts=True)
        seeded = np.repeat(often[which] > 1, sent)
        met = np.zeros(len(windows), bool)
        at = np.flatnonzero(seeded)
        around = np.repeat(rows["anchor"], sent)[at]
        order = np.lexsort((windows[at], around))
        head = _fresh(around[order], windows[at][order])
        again = ~head
        again[:-1] |= ~head[1:]
        met[at[order]] = again
        full = np.zeros(count.sum(), bool)
        full[np.repeat(rows["count"] > 0, count)] = met
        offset = np.arange(len(full)) - np.repeat(np.cumsum(count) - count, count)
        full |= (np.repeat(rows["known"].astype(np.int64), count) >> offset) & 1 == 1
        docs, starts = np.repeat(rows["doc"], count)[full], (np.repeat(rows["start"], count) + offset)[full]
        order = np.lexsort((starts, docs))
        docs, starts = docs[order], starts[order]
        fresh = np.ones(len(docs), bool)
        fresh[1:] = (docs[1:] != docs[:-1]) | (starts[1:] > starts[:-1] + 1)
        at = np.flatnonzero(fresh)
        last = starts[np.append(at[1:], len(docs)) - 1] if len(at) else starts[:0]
        return pa.table([docs[at], starts[at], last + length - starts[at]], schema=_SPANS)

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``(row_id, start, length)`` in words: maximal repeats of at least ``length`` words, one row each.

    ``docs`` has ``row_id`` (long, one per row) and ``text``. Null and short texts have no repeats.
    """
    if not anchor < length <= anchor + 31:
        raise ValueError("length must be above anchor, by 31 at most")
    buckets = bucket_count(docs)
    packed = docs.select(F.col("row_id").alias("doc_id"), "text").mapInArrow(_seed(length, anchor, buckets), "bucket int, rows binary, windows binary")
    spans = dealt(packed, docs).applyInArrow(_extend(length), "doc_id long, start long, length long")
    return spans.withColumnRenamed("doc_id", "row_id")


def _trim():
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text"):
            out = {name: [] for name in schema.names}
            marks = batch.column("spans").to_pylist() if "spans" in batch.schema.names else [None] * batch.num_rows
            for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text"), marks):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                kept = words
                if spans:
                    gone = np.zeros(len(words) + 1, np.int64)
                    for span in spans:
                        gone[min(span["start"], len(words))] += 1
                        gone[min(span["start"] + span["length"], len(words))] -= 1
                    keep = np.cumsum(gone[:-1]) == 0
                    kept = [w for w, k in zip(words, keep.tolist()) if k]
                for name, value in zip(out, (doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode())):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)`` for every row of ``docs (doc_id, text)``.

    Removes each word that lies in a run of ``length`` words found elsewhere too, in the same text or in
    another; kept words are joined by one space. Null and empty texts have no words. Rows that share a
    doc_id and differ in text would share spans, so such rows are told apart by a fingerprint of the text;
    equal rows are copies of each other and lose what they share. Rows without doc_id are treated like others.
    """
    docs = only(docs, doc_id="long", text="string").withColumn("row_id", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(docs, length, anchor)
    by_row = spans.groupBy("row_id").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    with short_batches(docs.sparkSession, 256):
        staged, rows = staged_count(by_row, "repeats")
    ids = staged.select("row_id")
    shape = "doc_id long, n_words long, n_removed long, kept_text string"
    if small_enough(staged, rows, 16):
        # Only texts that lose words are exchanged.
        touched = docs.join(F.broadcast(ids), "row_id", "left_semi").join(checked(staged, rows, 128), "row_id")
        clean = docs.join(F.broadcast(ids), "row_id", "left_anti")
        return clean.select("doc_id", "text").mapInArrow(_trim(), shape).unionAll(touched.select("doc_id", "text", "spans").mapInArrow(_trim(), shape))
    return docs.join(staged, "row_id", "left").select("doc_id", "text", "spans").mapInArrow(_trim(), shape)
