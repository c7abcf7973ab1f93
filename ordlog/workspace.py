"""Where staged tables go.

On a cluster every executor must see a staged table, so it is written below the
shared folder the cluster names in ``spark.checkpoint.dir``. Only a local session,
where driver and executors are one process, may fall back to a temporary folder.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dirs: list[str] = []

# Arrow batches are bounded by their row count alone. With a byte limit Spark measures the
# batch after every row, which costs several times the order check itself. A session whose
# sort keys are long texts should keep the byte limit.
SHORT_KEYS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(2**31 - 1)}


def _local_dir() -> str:
    if not _local_dirs:
        path = tempfile.mkdtemp(prefix="ordlog-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _local_dirs.append(path)
    return _local_dirs[0]


def _checkpoint_dir(spark: SparkSession) -> str | None:
    """The folder given to the context itself, which makes one of its own below it."""
    given = spark.sparkContext.getCheckpointDir()
    return given.rpartition("/")[0] if given else None


def base(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or _checkpoint_dir(spark)
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_dir()
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def folder(spark: SparkSession) -> str:
    """All that this application stages lies below."""
    return f"{base(spark)}/ordlog/{spark.sparkContext.applicationId}"


def fresh(spark: SparkSession, label: str) -> str:
    """A path that nothing else uses; Spark creates it on write."""
    return f"{folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application has staged; tables read from it are no longer valid.

    Never called by the library: only the caller knows when the last result is taken.
    """
    drop(spark, folder(spark))
