"""Compare registered queries with their SQL twins: ``python tests/check_queries.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as contract  # noqa: E402
from gleanery.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, sf: str, name: str) -> tuple[bool, str]:
    started = time.time()
    found = contract.queries()[name](spark, sf)
    got = rows_of(found.columns, found.collect())
    spent = time.time() - started
    cursor = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(found.columns):
        return False, f"columns {sorted(found.columns)} and {sorted(names)}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return False, f"{len(got)} and {len(want)} rows; only here {str(only_got)[:600]}; only there {str(only_want)[:600]}"
    return True, f"{len(got)} rows, {spent:.1f} s"


def main() -> int:
    sf, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    try:
        con = connect(sf)
        for name in chosen or contract.oracle_sql():
            try:
                good, note = compare(spark, con, sf, name)
            except Exception as error:
                good, note = False, f"{type(error).__name__}: {str(error)[:800]}"
            failed += not good
            print("ok  " if good else "FAIL", name, note, flush=True)
    finally:
        spark.stop()
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
