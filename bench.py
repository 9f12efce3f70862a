"""Time the headline jobs: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gleanery.operators import search  # noqa: E402
from gleanery.operators.top_search import top_search  # noqa: E402
from gleanery.plans import queries as q  # noqa: E402
from gleanery.session import build_session, fresh_path, stage  # noqa: E402
from gleanery.sources.index_store import read_index, write_index  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SCANS = ["word_count", "invert_words", "extract_links", "extract_content", "frontier_expand", "queue_length"]
SMALL = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.01")  # about as many documents as the published builds have


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def session():
    spark = build_session(
        "gleanery-bench", master=f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_build() -> None:
    """A build of the small table by a process of its own: how long until the session is there, and until the index is."""
    started = time.perf_counter()
    spark = session()
    spark.range(1).count()
    begun = time.perf_counter()
    write_index(q.documents(spark, SMALL), fresh_path(spark, "bench-index"))
    print(json.dumps([round(begun - started, 3), round(time.perf_counter() - started, 3)]))
    spark.stop()


def main() -> None:
    times: dict[str, float] = {}
    if os.path.isdir(SMALL):
        out = subprocess.run([sys.executable, __file__, "--small-build"], capture_output=True, text=True, timeout=600).stdout
        times["session_start_and_first_job"], times["index_build_sf0.01_cold_with_session"] = json.loads(out.strip().splitlines()[-1])

    def timed(name, job):
        started = time.perf_counter()
        result = job()
        times[name] = round(time.perf_counter() - started, 3)
        return result

    started = time.perf_counter()
    spark = session()
    try:
        path = fresh_path(spark, "bench-index")
        write_index(q.documents(spark, SF_DIR), path)
        times["index_build_cold_with_session"] = round(time.perf_counter() - started, 3)
        timed("index_build", lambda: write_index(q.documents(spark, SF_DIR), path))

        index = read_index(spark, path)
        terms = stage(q.batch_terms(spark, SF_DIR), "bench-terms")
        timed("batch_search_100_cold", lambda: run(search.in_order(search.ranked_search(index, terms))))
        timed("batch_search_100", lambda: run(search.in_order(search.ranked_search(index, terms))))
        asked = stage(q.asked(spark), "bench-asked")
        timed("search_top10", lambda: run(search.top_results(search.ranked_search(index, asked))))
        banded = timed("banded_index_build", lambda: q.banded_index(spark, SF_DIR))
        timed("search_top10_bounded", lambda: run(top_search(banded, asked)))
        for name in SCANS:
            timed(name, lambda: run(q.registered()[name](spark, SF_DIR)))
        print(json.dumps({
            "metric": "index, search, word and crawl jobs",
            "value": round(sum(times.values()), 3),
            "unit": "sec",
            "queries": times,
            "sf": SF_DIR.rsplit("sf", 1)[-1],
        }))
    finally:
        spark.stop()


if __name__ == "__main__":
    small_build() if "--small-build" in sys.argv else main()
