"""Tokens and words as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as one token, and what separates words (Unicode white space).
TOKEN = r"([\p{L}\p{N}]+)"
NOT_SPACE = r"([^\s\x0B\x1c-\x1f\x85\p{Z}]+)"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order and with repeats.

    A double quote is removed before splitting, so it joins its neighbours; every other sign
    separates. NULL gives no tokens.
    """
    clean = F.lower(F.translate(F.coalesce(text, F.lit("")), '"', ""))
    return F.regexp_extract_all(clean, F.lit(TOKEN), F.lit(1))


def words(text: Column) -> Column:
    """White-space separated words, case and punctuation kept. NULL gives no words."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NOT_SPACE), F.lit(1))


def code_point_bucket(word: Column, buckets: int) -> Column:
    """Sum of the code points of ``word``, modulo ``buckets``."""
    points = F.transform(
        F.filter(F.split(word, ""), lambda c: c != ""), lambda c: F.ascii(c)
    )
    return F.aggregate(points, F.lit(0), lambda total, point: total + point) % F.lit(buckets)
