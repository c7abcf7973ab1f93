"""The same logs on Kafka, where Spark's connector is on the class path.

Batch and streaming reads, unordered and ordered writes. Options pass through with their
``kafka.`` prefix, for readers and for producers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordlog.functions.codec import drop_empty, key_column, normalize_lines, serialize
from ordlog.operators import segments

FORMAT = "kafka"

# A retry must not reorder what is already in order.
IN_ORDER = {"kafka.acks": "all", "kafka.enable.idempotence": "true"}


def read_options(bootstrap: str, *topics: str, **extra: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
    } | extra


def write_options(bootstrap: str, topic: str, ordered: bool = False, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic} | (IN_ORDER if ordered else {}) | extra


def as_log(rows: DataFrame) -> DataFrame:
    return rows.select(
        "topic", "partition", "offset", F.col("key").cast("string"), F.col("value").cast("string")
    )


def read_log(spark: SparkSession, bootstrap: str, *topics: str, **extra: str) -> DataFrame:
    """Everything from the earliest offsets to the latest at planning time."""
    options = read_options(bootstrap, *topics, **({"endingOffsets": "latest"} | extra))
    return as_log(spark.read.format(FORMAT).options(**options).load())


def stream_log(spark: SparkSession, bootstrap: str, *topics: str, **extra: str) -> DataFrame:
    options = read_options(bootstrap, *topics, **extra)
    return as_log(spark.readStream.format(FORMAT).options(**options).load())


def consume(spark: SparkSession, bootstrap: str, topic: str, **extra: str) -> DataFrame:
    return drop_empty(read_log(spark, bootstrap, topic, **extra).select("value"))


def _send(rows: DataFrame, options: dict[str, str]) -> int:
    """Write and count in one pass. A task that is run again may send its rows again, which
    the order and row checks show."""
    sent = Observation("sent")
    rows.observe(sent, F.count("*").alias("rows")).write.format(FORMAT).options(**options).mode("append").save()
    return sent.get["rows"]


def publish(lines: DataFrame, bootstrap: str, topic: str, **extra: str) -> int:
    """Every line as a value without key; the topic's own partitioner spreads them."""
    return _send(normalize_lines(lines.select("value")), write_options(bootstrap, topic, **extra))


def sorted_rows(records: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows for an ordered topic: partition i holds what comes before partition i+1.

    One task fills one partition from front to back, so (partition, offset) is the order.
    """
    key_column(key)
    ordered = segments.range_sorted(records, [key], shards=partitions)
    return ordered.select(F.spark_partition_id().alias("partition"), serialize().alias("value"))


def publish_sorted(
    records: DataFrame, bootstrap: str, topic: str, key: str, partitions: int, **extra: str
) -> int:
    options = write_options(bootstrap, topic, ordered=True, **extra)
    return _send(sorted_rows(records, key, partitions), options)
