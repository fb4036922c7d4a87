"""Intermediate tables, written to the folder all executors share.

A written table cuts the plan as a cache does, but outlives a lost executor and is read column by
column. The folder is the session's ``spark.checkpoint.dir``. Tables that a result still reads are left to its
keeper; others are removed as soon as they are done with, or together at the end of a ``scratch_scope``.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"

# Paths written in the innermost open scope, if there is one.
_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="keytables-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder. Only a local session may leave the folder unset."""
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        folder = _local_folder()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, which lasts until the end of the innermost ``scratch_scope`` around it, if any."""
    path = scratch_path(df.sparkSession, name)
    _note(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _note(path: str) -> None:
    held = _written.get()
    if held is not None:
        held.append(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``write_scratch`` writes within the block are removed at its end, also after a failure.

    So nothing that reads them may leave the block unwritten.
    """
    token = _written.set([])
    try:
        yield
    finally:
        paths = _written.get()
        _written.reset(token)
        for path in paths:
            remove_scratch(spark, path)


def write_result(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, as a written table; the scratch tables it needed are removed. If it fails, nothing is left.
    Within a scope the table belongs to that scope."""
    path = scratch_path(spark, name)
    _note(path)
    try:
        with scratch_scope(spark):
            built = build()
            schema = built.schema
            built.write.parquet(path)
    except BaseException:
        remove_scratch(spark, path)
        raise
    return spark.read.schema(schema).parquet(path)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove what is at ``path``, if anything, by the file system that Spark uses for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as a written table that is removed at the end of the block, also after a failure."""
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_scratch(df.sparkSession, path)
