"""URL rules by a sort-merge range join.

The key of a host is its labels in reverse, each followed by ``\\x01``. A rule for a host and its subdomains is
then the interval of keys that start with the rule's key, and intervals of rules nest. URLs are sorted by key
over range partitions; in each, a sweep over URLs and rules keeps the stack of the rules whose intervals are open.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import ascii_lower, checked, shuffle_parts, staged_count
from gleanery.session import stage

ROWS_PER_RANGE = 200_000
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def key_of(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), "\x01"), F.lit("\x01"))


def _sweep(columns: list[str]):
    def run(urls: pd.DataFrame, rules: pd.DataFrame) -> pd.DataFrame:
        order = urls["key"].argsort(kind="stable").to_numpy()
        keys, hosts, paths = (urls[c].to_numpy()[order] for c in ("key", "host", "path"))
        waiting = sorted(zip(rules["key"], rules["rule_host"], rules["rule_path"], rules["action"]), reverse=True)
        best: list[tuple[str, str] | None] = []
        stack: list[tuple[str, str, str, str]] = []
        for key, host, path in zip(keys, hosts, paths):
            while waiting and waiting[-1][0] <= key:
                opened = waiting.pop()
                while stack and not opened[0].startswith(stack[-1][0]):
                    stack.pop()
                stack.append(opened)
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            fits = [
                (len(h) + len(p), len(h), h + p, action)
                for _, h, p, action in stack
                if path.startswith(p) and (host == h or host.endswith("." + h))
            ]
            best.append(max(fits)[2:] if fits else None)
        found = np.empty(len(best), object)
        found[:] = best
        back = np.empty(len(best), object)
        back[order] = found
        out = urls[columns].copy()
        out["rule"] = [b[0] if b else None for b in back]
        out["action"] = [b[1] if b else None for b in back]
        return out

    return run


def apply_rules(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages (page_id, url)``.

    ``rules`` has ``host``, ``path`` and ``action``. A rule fits its host and all subdomains where the URL's path
    starts with the rule's; the longest fitting rule (host and path together, then host, then the greater text)
    gives the verdict, else ``default``. Of equal rules the greatest action counts. A URL that is null or has
    no ``://`` has empty host and path. Repeated pages are judged one by one; rules with a null are ignored.
    """
    keyed = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    keyed = keyed.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    keyed, rows = staged_count(keyed.withColumn("key", key_of(F.col("host"))), "url-keys")
    parts = max(shuffle_parts(pages), rows // ROWS_PER_RANGE)
    # The path and the page keep a host with very many pages from being one range.
    ranged = keyed.repartitionByRange(parts, "key", "path", "page_id").withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "url-ranges")
    ends, ranges = staged_count(ranged.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")), "ranges")
    listed = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action").dropna()
    listed = listed.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
    listed = listed.withColumn("rule_key", key_of(F.col("rule_host")))
    # A rule goes to the ranges that its interval meets; there is one short row per range to compare with.
    meets = (F.col("rule_key") <= F.col("high")) & (F.concat("rule_key", F.lit("\U0010ffff")) >= F.col("low"))
    dealt = listed.join(checked(ends, ranges, 256), meets).select("part", F.col("rule_key").alias("key"), "rule_host", "rule_path", "action")
    columns = ["page_id", "host", "path"]
    judged = ranged.groupBy("part").cogroup(dealt.groupBy("part")).applyInPandas(
        _sweep(columns), "page_id long, host string, path string, rule string, action string"
    )
    return judged.select(*columns, "rule", F.coalesce("action", F.lit(default)).alias("verdict"))
