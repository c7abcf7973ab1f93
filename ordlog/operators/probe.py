"""How many values a key has, and how many rows each stage holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


LOW, HIGH = "LOW", "HIGH"
LOW_CARDINALITY = 10  # values from which on a key counts as HIGH


def _verdicts(counts: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """One row with a count for each key -> one row for each key."""
    entries = [
        F.struct(F.lit(k).alias("key"), F.col("sampled"), F.col(f"_{k}").alias("distinct_keys")) for k in keys
    ]
    verdict = F.when(F.col("distinct_keys") < threshold, F.lit(LOW)).otherwise(F.lit(HIGH))
    return counts.select(F.inline(F.array(*entries))).withColumn("verdict", verdict)


def cardinality_probe(
    df: DataFrame,
    keys: list[str],
    n: int | None = None,
    order: list[str | Column] | None = None,
    threshold: int = LOW_CARDINALITY,
) -> DataFrame:
    """Exact distinct keys of the table, or of its first n rows in ``order``; no sort but
    the one that finds these."""
    rows = df if n is None else df.orderBy(*(order or keys)).limit(n)
    counted = rows.agg(
        F.count("*").alias("sampled"), *[F.count_distinct(F.col(k)).alias(f"_{k}") for k in keys]
    )
    return _verdicts(counted, keys, threshold)


def cardinality_approx(
    df: DataFrame, keys: list[str], threshold: int = LOW_CARDINALITY, error: float = 0.02
) -> DataFrame:
    """The same verdicts over the whole table from sketches: one scan, no shuffle of keys."""
    counted = df.agg(
        F.count("*").alias("sampled"), *[F.approx_count_distinct(k, error).alias(f"_{k}") for k in keys]
    )
    return _verdicts(counted, keys, threshold)
