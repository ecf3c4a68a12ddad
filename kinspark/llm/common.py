"""What the corpus operators share: reading tables, scratch tables in the shared folder, Arrow batch limits."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import functools
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.sources.shared import shared_path

#: Rows and bytes of one Arrow batch handed to a Python worker, so that very long texts cannot pile up in memory.
ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20

_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_limits(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def frugal(run):
    """A function for mapInArrow after whose tasks the worker, which Spark keeps for other ones, gives freed memory back."""

    @functools.wraps(run)
    def frugal_run(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return frugal_run


def give_back() -> None:
    """Freed memory that the allocators of this process hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that no name of theirs can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])


@contextlib.contextmanager
def scratch(paths: list[str]):
    """Collects in paths the scratch tables that are written inside, for delete()."""
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)


def scratch_path(spark: SparkSession, what: str) -> str:
    path = shared_path(spark, what)
    if (paths := _scope.get()) is not None:
        paths.append(path)
    return path


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write a table to the shared folder and read it back, so lost executors cost no recomputation."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def small(keys: DataFrame, limit: int) -> DataFrame:
    """Keys that large rows meet: broadcast up to limit of them, so that the rows are shuffled once or not at all."""
    return F.broadcast(keys) if keys.count() <= limit else keys


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that nothing will read again."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while paths:
        p = jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(conf).delete(p, True)


def done_with(*frames: DataFrame) -> None:
    """Remove tables that materialise() made and whose last reader has written. A collection on the driver then lets Spark
    remove the shuffles that no plan refers to any more."""
    for df in frames:
        delete(df.sparkSession, [df.scratch_path])
    gc.collect()
    frames[0].sparkSession._jvm.System.gc()
