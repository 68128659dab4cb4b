"""Intermediate tables in the folder all machines share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a fresh temporary one where none is named and Spark
    runs on this machine alone."""
    named = spark.conf.get(_CHECKPOINT_DIR, None)
    if named:
        return f"{named.rstrip('/')}/sessionloom"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors reach")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="sessionloom-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def _files(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store Spark reads the path from."""
    files, place = _files(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    files, place = _files(spark, path)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete one of this library's own intermediate tables."""
    if "sessionloom" not in path:
        raise ValueError(f"not an intermediate table: {path}")
    files, place = _files(spark, path)
    files.delete(place, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _write_and_read(df: DataFrame, path: str, **options) -> DataFrame:
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str, **options) -> DataFrame:
    """Write the frame once and read it back.

    Cuts the lineage, survives lost executors, and gives the optimizer the real size, so a
    join with a small result is broadcast and one with a large result is not.
    """
    path = fresh_path(df.sparkSession, label)
    for made in _scopes:
        made.append(path)
    return _write_and_read(df, path, **options)


def materialize_large_rows(df: DataFrame, label: str) -> DataFrame:
    """``materialize`` for rows of megabytes.

    Writers and readers hold a row group at a time, readers as whole columns too, so each row is one.
    The footer keeps short bounds of each group's values.
    """
    return materialize(df, label, **{"parquet.block.row.count.limit": 1, "parquet.statistics.truncate.length": 64})


_scopes: list[list[str]] = []


@contextmanager
def removing_tables(spark: SparkSession) -> Iterator[list[str]]:
    """At the end, also after a failure, the tables that ``materialize`` wrote meanwhile are removed.

    Yields the list of their paths; one that is taken out of it stays.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes[:] = [scope for scope in _scopes if scope is not made]
        for path in made:
            remove(spark, path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Yields a ``materialize`` whose tables are removed at the end, also after a failure."""
    paths = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        paths.append(fresh_path(spark, label))
        return _write_and_read(df, paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            remove(spark, path)
