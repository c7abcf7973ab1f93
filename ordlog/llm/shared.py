"""What several operators need: tables, staging, and workers that stay small."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ordlog import workspace

BROADCAST_ROWS = 200_000  # rows of a few numbers each; beyond it Spark joins by shuffling


BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_DEFAULT_BATCH = "67108864b"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = workspace.fresh(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one made from it that no column of the table has in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small_batches(spark: SparkSession) -> None:
    """Texts reach Python in batches of BATCH_BYTES, unless the session has a limit of its own.

    For the program that owns the session: Spark reads the setting when a plan runs, so no
    operator could put it back, and none touches it."""
    if spark.conf.get(_BATCH) == _DEFAULT_BATCH:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


def _trim() -> None:
    """Hand freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """A mapInArrow function after which its worker, which lives on, keeps no freed memory."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _trim()

    return tidied
