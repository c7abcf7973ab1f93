"""Where a job's logs live: below a folder, or on Kafka. Both offer the same four calls."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from ordlog.sources import kafka, log


class Logs(Protocol):
    def publish(self, lines: DataFrame, topic: str, partitions: int) -> int:
        """Write the lines to a topic, in no order; returns the rows sent."""

    def consume(self, topic: str) -> DataFrame:
        """The non-empty values of a topic, from its beginning to its present end."""

    def publish_ordered(self, records: DataFrame, keys: Sequence[str], shards: int | None) -> dict[str, int]:
        """Write the records, ordered by each key, to the topic of that name; returns the rows
        sent to each."""

    def read(self, topic: str) -> DataFrame:
        """The rows of a topic with partition and offset."""


class FileLogs:
    """Topics below a root folder; publishing replaces what was there."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def publish(self, lines: DataFrame, topic: str, partitions: int) -> int:
        return log.publish(lines, self.root, topic, partitions)

    def consume(self, topic: str) -> DataFrame:
        return log.consume(self.spark, self.root, topic)

    def publish_ordered(self, records: DataFrame, keys: Sequence[str], shards: int | None) -> dict[str, int]:
        return log.publish_orders(records, self.root, {k: k for k in keys}, shards)

    def read(self, topic: str) -> DataFrame:
        return log.read_topic(self.spark, self.root, topic)


class KafkaLogs:
    """Topics of a broker. They must exist and be empty; making them is the broker's matter.

    An ordered topic needs ``ordered_partitions`` partitions, each of which one task fills.
    A shard is a partition there, so another number of shards is an error.
    """

    def __init__(self, spark: SparkSession, bootstrap: str, ordered_partitions: int, **options: str):
        self.spark, self.bootstrap = spark, bootstrap
        self.ordered_partitions, self.options = ordered_partitions, options

    def publish(self, lines: DataFrame, topic: str, partitions: int | None = None) -> int:
        # how many there are is the topic's matter; the broker's own partitioner deals rows out
        return kafka.publish(lines, self.bootstrap, topic, **self.options)

    def consume(self, topic: str) -> DataFrame:
        return kafka.consume(self.spark, self.bootstrap, topic, **self.options)

    def publish_ordered(self, records: DataFrame, keys: Sequence[str], shards: int | None = None) -> dict[str, int]:
        partitions = self.ordered_partitions
        if shards not in (None, partitions):
            raise ValueError(f"an ordered topic has {partitions} partitions, not {shards} shards")
        return {k: kafka.publish_sorted(records, self.bootstrap, k, k, partitions, **self.options) for k in keys}

    def read(self, topic: str) -> DataFrame:
        return kafka.read_log(self.spark, self.bootstrap, topic, **self.options)
