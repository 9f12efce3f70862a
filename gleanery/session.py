"""Session settings and the shared folder in which jobs keep intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession

MB = 1024 * 1024
MAX_PARTITIONS = 100_000
UNKNOWN_BYTES = 10**17  # beyond any table; the optimizer says so where it knows nothing

_own_dirs: dict[str, str] = {}
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def build_session(app: str = "gleanery", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are designed for; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a fresh one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/gleanery/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="gleanery-")
    return _own_dirs[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result feeds several later steps: it is computed once, a lost executor does not
    cost a recomputation, and the planner knows the true size of what it reads.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    paths = _staged.get()
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removes_stages(job: Callable) -> Callable:
    """For a job that has written all it gives back when it returns: what it staged is removed then, failed or not."""
    @wraps(job)
    def run(*args, **kwargs):
        paths: list[str] = []
        before = _staged.set(paths)
        try:
            return job(*args, **kwargs)
        finally:
            _staged.reset(before)
            for path in paths:
                remove(SparkSession.active(), path)

    return run


def remove(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """Texts go to Python in batches of few rows while tables are written inside this block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def one_writer(spark: SparkSession) -> Iterator[None]:
    """Inside this block a task writes the first partition folder it meets as its rows come; only rows of others are sorted."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, from file sizes for table scans."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def partitions_for(df: DataFrame, target_mb: int = 64) -> int:
    """Partition count that gives each task about ``target_mb`` and every core something to do.

    Meant for table scans. There are at most ``MAX_PARTITIONS``, which a driver can still track; beyond that
    partitions grow with the input. Where the optimizer has no usable size the session's setting decides.
    """
    spark = df.sparkSession
    size = plan_bytes(df)
    if size > UNKNOWN_BYTES:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(size / (target_mb * MB))
    return max(2 * spark.sparkContext.defaultParallelism, min(wanted, MAX_PARTITIONS))


def fan_out(df: DataFrame, per_core_mb: int = 32) -> DataFrame:
    """Spread a small input over all cores; an input with enough for every core stays as it is.

    For jobs that work hard on each row when their whole input may be a single file split.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if plan_bytes(df) < cores * per_core_mb * MB else df
