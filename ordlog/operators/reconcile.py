"""Row counts of the stages, side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class LostRows(Exception):
    """Stages that should hold the same number of rows do not."""


def reconcile(
    spark: SparkSession, counts: dict[str, int], expected: dict[str, int], strict: bool = True
) -> DataFrame:
    """One row for each stage: rows, rows lost, and whether none were.

    The counts are numbers the stages have already reported; nothing is scanned again.
    """
    rows = [
        (step, stage, n, expected[stage] - n, n == expected[stage])
        for step, (stage, n) in enumerate(counts.items())
    ]
    wrong = [f"{stage} has {n} rows instead of {expected[stage]}" for _, stage, n, _, ok in rows if not ok]
    if strict and wrong:
        raise LostRows("; ".join(wrong))
    return spark.createDataFrame(
        rows, "step int, stage string, rows bigint, lost bigint, matches_source boolean"
    )
