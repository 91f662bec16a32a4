"""Folders for intermediate tables that every executor can reach.

File systems are reached through the session's JVM (``hadoop_files``), the one place where the package leaves the DataFrame API; jobs
that publish or remove folders therefore need a classic session, not a Connect one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders named in this process and not yet removed.
_named: set[str] = set()
# Has Spark remove the shuffle files of a query as it ends. Otherwise they stay until the driver's garbage collection finds the query gone.
REMOVES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table; nothing is created yet. :func:`sweep` removes it."""
    path = f"{shared_folder(spark)}/arrivalmart/{name}-{uuid.uuid4().hex}"
    _named.add(path)
    return path


def hadoop_files(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as its own kind of object."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def _remove(spark: SparkSession, path: str) -> None:
    files, folder = hadoop_files(spark, path)
    files.delete(folder, True)
    _named.discard(path)


def sweep(spark: SparkSession) -> None:
    """Remove every folder that :func:`new_folder` has named for this session, once the results that read them are consumed."""
    for path in sorted(p for p in _named if p.startswith(f"{shared_folder(spark)}/")):
        _remove(spark, path)


@contextmanager
def work_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for the intermediate tables of one job, removed with them when the job ends."""
    path = new_folder(spark, name)
    try:
        yield path
    finally:
        _remove(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Each query run within leaves no shuffle files on the disks, so that steps of a job that end in tables take the disk of one step at a time."""
    before = spark.conf.get(REMOVES_SHUFFLES, None)
    spark.conf.set(REMOVES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVES_SHUFFLES)
        else:
            spark.conf.set(REMOVES_SHUFFLES, before)


def kept(df: DataFrame, path: str) -> DataFrame:
    """A result that is used more than once, written as a table and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def kept_parts(spark: SparkSession, parts: Iterable[DataFrame], path: str) -> DataFrame:
    """All parts of a result, one or more, written one after the other into one table and read back."""
    for part in parts:
        part.write.mode("append").parquet(path)
    return spark.read.parquet(path)
