"""Draining a log as a bounded stream that can be resumed.

A named group keeps its place in a checkpoint and its rows in a table, both below the
log's root. Each call reads what has been published since the last one, up to the end it
finds when it starts, and stops. Rows reach the table exactly once.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ordlog.functions.codec import drop_empty
from ordlog.sources import kafka
from ordlog.sources.log import STORED, data_path, place_rows, state

STREAM_COLUMNS = ("run", "partition", "shard", "pos", "key", "value")


class NotDrained(Exception):
    """The stream did not reach the end of the log in time."""


def stream_log(
    spark: SparkSession, root: str, topic: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The topic's rows as a stream. Files appear in it when their publish commits."""
    reader = spark.readStream.schema(STORED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(data_path(root, topic)).select(*STREAM_COLUMNS)


def _group_path(root: str, topic: str, group: str, part: str) -> str:
    return f"{root}/groups/{group}/{topic}/{part}"


class Progress(StreamingQueryListener):
    """Keeps what Spark reports of each batch of one query; Spark itself keeps the last ones."""

    def __init__(self, name: str):
        self.name = name
        self.batches: list[tuple] = []
        self.ended = threading.Event()
        self._run = None

    def onQueryStarted(self, event):  # noqa: N802
        if event.name == self.name:
            self._run = event.runId

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        if p.runId == self._run:
            self.batches += [
                (p.batchId, s.description, s.startOffset, s.endOffset, s.numInputRows) for s in p.sources
            ]

    def onQueryTerminated(self, event):  # noqa: N802
        if event.runId == self._run:
            self.ended.set()


def drain(stream: DataFrame, table: str, checkpoint: str, timeout: float | None = None) -> Progress:
    """Read the stream to its present end into a Parquet table; works on any source.

    Without ``timeout`` it takes as long as it takes."""
    spark = stream.sparkSession
    progress = Progress(f"drain-{uuid.uuid4().hex}")
    spark.streams.addListener(progress)
    try:
        query = (
            stream.writeStream.format("parquet")
            .option("path", table)
            .option("checkpointLocation", checkpoint)
            .queryName(progress.name)
            .trigger(availableNow=True)
            .start()
        )
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            query.stop()
            raise NotDrained(f"the stream was not drained in {timeout} s")
        progress.ended.wait(60)  # its reports come on a thread of their own
    finally:
        spark.streams.removeListener(progress)
    return progress


def checkpoint_batches(spark: SparkSession, checkpoint: str, files: str) -> DataFrame:
    """What Spark's own checkpoint knows of a stream over Parquet files: for each batch the
    end offset that was planned, whether the batch was committed, and the rows of the files
    it read.

    Read from the logs that Spark keeps: ``offsets`` is written before a batch, ``commits``
    after it, and the source's own log names the files of each batch."""
    name = F.regexp_extract("_metadata.file_path", r"/(\d+)$", 1).cast("bigint")
    planned = spark.read.text(f"{checkpoint}/offsets").select(name.alias("batch"), "value")
    planned = planned.filter(F.col("value").contains("logOffset")).select(
        "batch", F.get_json_object("value", "$.logOffset").cast("bigint").alias("log_offset")
    )
    committed = spark.read.text(f"{checkpoint}/commits").select(name.alias("_batch")).distinct()
    logged = spark.read.text(f"{checkpoint}/sources/0").select(
        F.regexp_extract(F.get_json_object("value", "$.path"), r"[^/]+$", 0).alias("file"),
        F.get_json_object("value", "$.batchId").cast("bigint").alias("of"),
    )
    # a compacted log repeats what the logs before it say
    logged = logged.filter("of is not null").distinct()
    rows = spark.read.schema(STORED).parquet(files).groupBy(F.col("_metadata.file_name").alias("_file")).agg(F.count("*").alias("n"))
    read = logged.join(rows, F.col("file") == F.col("_file")).groupBy("of").agg(F.sum("n").alias("n"))
    done = planned.join(committed, F.col("batch") == F.col("_batch"), "left").join(read, F.col("batch") == F.col("of"), "left")
    return done.select("batch", "log_offset", F.col("_batch").isNotNull().alias("committed"), F.coalesce("n", F.lit(0)).alias("rows"))


def group_progress(spark: SparkSession, root: str, topic: str, group: str) -> DataFrame:
    """``checkpoint_batches`` of a group that consumes a topic."""
    return checkpoint_batches(spark, _group_path(root, topic, group, "checkpoint"), data_path(root, topic))


def batch_report(spark: SparkSession, progress: Progress) -> DataFrame:
    """One row for each batch and source: rows read, and from where to where."""
    schema = "batch bigint, source string, start_offset string, end_offset string, rows bigint"
    return spark.createDataFrame(progress.batches, schema)


def _held(spark: SparkSession, table: str) -> int:
    """Rows of a group's table, from the files' footers."""
    at = spark._jvm.org.apache.hadoop.fs.Path(table)
    exists = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(STORED).parquet(table).count() if exists else 0


def consume_new(
    spark: SparkSession,
    root: str,
    topic: str,
    group: str,
    timeout: float | None = None,
    max_files_per_trigger: int | None = None,
) -> int:
    """Bring the group's table up to the end of the topic; returns the rows this added to it,
    counted in the table."""
    table = _group_path(root, topic, group, "rows")
    before = _held(spark, table)
    stream = drop_empty(stream_log(spark, root, topic, max_files_per_trigger))
    drain(stream, table, _group_path(root, topic, group, "checkpoint"), timeout)
    return _held(spark, table) - before


def drain_kafka(
    spark: SparkSession, bootstrap: str, topic: str, table: str, checkpoint: str, timeout: float | None = None, **options: str
) -> int:
    """Bring a table up to the end of a Kafka topic; the group's place is its checkpoint."""
    before = _held(spark, table)
    stream = drop_empty(kafka.stream_log(spark, bootstrap, topic, **options))
    drain(stream, table, checkpoint, timeout)
    return _held(spark, table) - before


def consumed(spark: SparkSession, root: str, topic: str, group: str) -> DataFrame:
    """What the group has read so far, as rows of the log.

    Rows of a publish that died before it was recorded have no place in the log and are left
    out, though the stream may have seen them."""
    stored = spark.read.schema(STORED).parquet(_group_path(root, topic, group, "rows"))
    return place_rows(stored, root, topic, state(spark, root, topic))
