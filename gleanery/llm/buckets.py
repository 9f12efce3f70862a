"""Fingerprints through a shuffle as packed arrays: few large rows in place of one row per fingerprint."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, GroupedData

from gleanery.llm.common import shuffle_parts
from gleanery.session import MAX_PARTITIONS, MB, UNKNOWN_BYTES, plan_bytes

FLUSH_BYTES = 16 << 20


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by the upper bits, so that equal fingerprints meet."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def bucket_count(df: DataFrame) -> int:
    """Sixteen times the session's shuffle partitions: a bucket, which one call holds whole, is a small part of a task."""
    return 16 * shuffle_parts(df)


def dealt(packed: DataFrame, docs: DataFrame, part_mb: int = 4) -> GroupedData:
    """``packed`` grouped by bucket, in partitions for about ``part_mb`` of ``docs`` that are not merged into larger ones."""
    size = plan_bytes(docs)
    parts = 0 if size > UNKNOWN_BYTES else min(math.ceil(size / (part_mb * MB)), MAX_PARTITIONS)
    return packed.repartition(max(shuffle_parts(docs), parts), "bucket").groupBy("bucket")


def pack(hashes: np.ndarray, extras: list[np.ndarray], buckets: int) -> Iterator[tuple[int, list[bytes]]]:
    """Deal parallel arrays out by the bucket of their fingerprint."""
    to = bucket_of(hashes, buckets)
    order = np.argsort(to, kind="stable")
    sizes = np.bincount(to, minlength=buckets)
    arrays = [a[order] for a in (hashes, *extras)]
    begin = 0
    for bucket in np.flatnonzero(sizes):
        end = begin + sizes[bucket]
        yield int(bucket), [a[begin:end].tobytes() for a in arrays]
        begin = end
