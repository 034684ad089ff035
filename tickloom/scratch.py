"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``; set here only where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-tickloom-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


#: The folder that ``durable`` writes to, where one is set.
_WORKSPACE: ContextVar[str | None] = ContextVar("workspace", default=None)
#: Spark removes the shuffle files of a query when it ends; else they stay until the driver collects garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a side that is sent to all tasks, at most; above it both sides of the join are shuffled.
BROADCAST_ROWS = 1_000_000


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_WORKSPACE.get() or scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def workspace(folder: str) -> Iterator[str]:
    """Intermediate tables written within the block go below ``folder``, so that ``remove`` frees them all at once."""
    token = _WORKSPACE.set(folder)
    try:
        yield folder
    finally:
        _WORKSPACE.reset(token)


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes tables or folders of the shared store that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back. The shuffle files of the write go when it ends."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back: lineage ends there, and a lost executor loses nothing.

    The table is deleted when the program ends with its session still running, if ``remove`` has not freed it before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return store(df, path)


#: Intermediate tables by application.
_WRITTEN: dict[str, list[str]] = {}


@atexit.register
def _free() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        remove(spark, *_WRITTEN.pop(spark.sparkContext.applicationId, []))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a written table of few narrow columns, to be broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
