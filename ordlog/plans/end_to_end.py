"""From records to three ordered logs, with proof.

publish the lines -> consume them once -> parse once -> sort three ways -> check.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordlog import workspace
from ordlog.functions import codec
from ordlog.operators import compare, order_check, reconcile, segments
from ordlog.schema import FIELDS, KEYS, SOURCE_PARTITIONS, SOURCE_TOPIC
from ordlog.sources import synth
from ordlog.sources.logs import FileLogs, Logs


@dataclass(frozen=True)
class Run:
    """``summary``: a row for each stage. ``report``: a row for each ordered log."""

    root: str
    summary: DataFrame
    report: DataFrame
    malformed: int


def sort_topics(
    records: DataFrame, logs: Logs, keys: tuple[str, ...] = KEYS, shards: int | None = None
) -> dict[str, int]:
    """Publish one ordered topic for each key; returns the rows of each.

    Every key is sorted in the same way, so its topic does not depend on how many values
    it has. The sort holds a copy of the data for each key as shuffle files while it runs."""
    return logs.publish_ordered(records, keys, shards)


def verify_topic(topic: DataFrame, key: str, width: int = order_check.WIDTH) -> DataFrame:
    """Rows, inversions of the key, gapless offsets and hash sums of one ordered topic.

    Its partitions, if there are several, follow one another."""
    parsed = codec.parse(topic, keep=("partition", "offset", "value"))
    report = order_check.order_report(
        parsed,
        codec.key_column(key),
        by=("partition",),
        line=F.col("value"),
        chain="partition",
        width=width,
    )
    # a topic without rows has no report
    return report.filter(F.col("partitions") > 0).select(F.lit(key).alias("topic"), "*")


def verify_topics(
    topics: dict[str, DataFrame], expected: dict[str, int] | None = None, width: int = order_check.WIDTH
) -> DataFrame:
    """One verdict for each ordered topic, given by its key, over its whole length.

    PASS needs rows, no inversion, gapless offsets and, given ``expected`` (the fingerprint
    of the lines that went in), the same multiset of rows. Each log is read once for order,
    count and fingerprint together.
    """
    report = reduce(DataFrame.unionByName, [verify_topic(t, k, width) for k, t in topics.items()])
    good = (F.col("rows") > 0) & (F.col("violations") == 0) & F.col("gapless")
    kept = ["topic", "partitions", *order_check.REPORT]
    if expected is not None:
        same = [F.col(c) == expected[c] for c in ("rows", *compare.QUARTERS)]
        report = report.withColumn("same_rows", reduce(Column.__and__, same))
        good = good & F.col("same_rows")
        kept.append("same_rows")
    return report.select(*kept, F.when(good, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("verdict"))


def run(
    spark: SparkSession,
    records: DataFrame | None = None,
    count: int = 0,
    seed: int = 42,
    root: str | None = None,
    logs: Logs | None = None,
    partitions: int = SOURCE_PARTITIONS,
    strict: bool = True,
    lines: DataFrame | None = None,
) -> Run:
    """The whole job on the given records or lines, or on ``count`` generated records.

    The logs are kept below ``root`` unless others are given. What is consumed is parsed
    into a typed table once, in a folder of this run below ``root``; the three sorts read
    that, and it goes when they are done. The same pass takes the fingerprint the topics
    must have. Lines that do not parse are kept in ``<root>/quarantine``, which each run
    writes anew, empty if all parse. ``strict`` raises when a stage lost or gained rows.
    """
    root = root or workspace.fresh(spark, "run")
    logs = logs or FileLogs(spark, root)
    made = Observation("made")
    if lines is None:
        lines = codec.to_lines(synth.records(spark, count, seed) if records is None else records)
    sent = logs.publish(lines.observe(made, F.count("*").alias("rows")), SOURCE_TOPIC, partitions)

    read = Observation("read")
    bad = F.col("reason").isNotNull()
    parsed = codec.parse_all(logs.consume(SOURCE_TOPIC)).observe(
        read,
        F.count("*").alias("consumed"),
        *compare.fingerprint_sums(F.when(~bad, F.xxhash64(codec.serialize()))),
    )
    # a parsed line can be had back from its fields
    kept = parsed.withColumn("value", F.when(bad, F.col("value")))
    path = f"{root}/consumed-{uuid.uuid4().hex}"
    try:
        consumed = segments.stage(kept, path)
        valid = consumed.filter(F.col("reason").isNull()).select(*FIELDS)
        seen = read.get
        malformed = seen["consumed"] - seen["rows"]
        rejected = consumed.filter(F.col("reason").isNotNull()).select("value", "reason")
        rejected.write.mode("overwrite").parquet(f"{root}/quarantine")
        topics = sort_topics(valid, logs)
    finally:
        workspace.drop(spark, path)
    stages = {"generated": made.get["rows"], SOURCE_TOPIC: sent, "consumed": seen["consumed"]}
    wanted = dict.fromkeys(stages, stages["generated"]) | dict.fromkeys(topics, seen["rows"])
    return Run(
        root=root,
        summary=reconcile.reconcile(spark, stages | topics, wanted, strict),
        report=verify_topics({k: logs.read(k) for k in KEYS}, expected=seen),
        malformed=malformed,
    )
