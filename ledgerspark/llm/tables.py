"""Intermediate tables in the shared folder that go when their operator is done, and the memory of Python workers."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerspark.staging import staged_path

_OPEN: ContextVar[list[str] | None] = ContextVar("open", default=None)


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write df once as Parquet and read it back. Inside scratch(), the table is removed at the end, unless kept."""
    path = staged_path(df.sparkSession, label)
    if not keep and (mine := _OPEN.get()) is not None:
        mine.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end, the tables that were staged inside."""
    mine: list[str] = []
    token = _OPEN.set(mine)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for name in mine:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: glibc's option for the size from which a block is mapped on its own, and the size set here.
_M_MMAP_THRESHOLD, _MAPPED_FROM = -3, 1 << 20


def frugal() -> None:
    """Freed memory goes back to the system at once, in the Python worker that calls this.

    Batches are large, workers live on after their task, and all workers of an executor share its memory. Without
    glibc only the Arrow buffers are returned.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt") and hasattr(libc, "malloc_trim"):
        libc.mallopt(_M_MMAP_THRESHOLD, _MAPPED_FROM)
        libc.malloc_trim(0)
