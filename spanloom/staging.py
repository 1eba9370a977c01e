"""Cutting lineage: intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a session on a local master gets a folder of its own when the setting is missing.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spanloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_jobs = threading.local()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own; inside ``staged_job`` it goes when the job ends."""
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    if getattr(_jobs, "open", None):
        _jobs.open[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system that Spark reaches."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


@contextmanager
def staged_job(spark: SparkSession) -> Iterator[None]:
    """A job that writes its results: what it staged on the way is removed at its end.

    DataFrames made inside must not be used after it. Jobs in other threads are apart.
    """
    _jobs.open = getattr(_jobs, "open", None) or []
    _jobs.open.append([])
    try:
        yield
    finally:
        for path in _jobs.open.pop():
            remove(spark, path)


#: Removes the shuffle files of a query when it has ended, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> DataFrame:
    """The written table; the shuffle files that led to it go."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: later steps start from the written table, not from the lineage."""
    return _write(df, new_folder(df.sparkSession, name))


def stage_last(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Stage what ``make`` returns; what it staged on the way is removed."""
    path = new_folder(spark, name)
    with staged_job(spark):
        return _write(make(), path)
