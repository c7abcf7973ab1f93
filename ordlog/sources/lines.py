"""Line files: one serialized record per line, no header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordlog import workspace
from ordlog.operators import segments


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Uncompressed by default, so that readers can split big files."""
    lines.select("value").write.mode(mode).option("compression", compression).text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines end at LF, CR or CRLF."""
    return spark.read.text(path)


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the stretch of it that they were read from. Spark reads a
    stretch in one task, from front to back."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def _blocks(spark: SparkSession, path: str, good: Column) -> DataFrame:
    """One row for each stretch: its lines, how many are good, and what lies before it."""
    counts = _scan(spark, path).groupBy("file", "block").agg(
        F.count("*").alias("lines"), F.count_if(good).alias("good"), F.min("at").alias("first")
    )
    # as many rows as there are splits
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns(
        {
            "lines_before": F.coalesce(F.sum("lines").over(in_file), F.lit(0)),
            "good_before": F.coalesce(F.sum("good").over(before), F.lit(0)),
        }
    )
    out = workspace.fresh(spark, "blocks")
    return segments.stage(counts, out)


def _numbered(spark: SparkSession, path: str, blocks: DataFrame) -> DataFrame:
    """Lines of these stretches with their numbers, from 1 in each file."""
    names = {"file": "_file", "block": "_block"}
    known = blocks.select(*[F.col(c).alias(n) for c, n in names.items()], "first", "lines", "lines_before")
    small = known.count() <= segments.BROADCAST_SEGMENTS
    mine = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    rows = _scan(spark, path).join(F.broadcast(known) if small else known, mine)
    place = F.col("at") - F.col("first")
    # the files, or how Spark splits them, must not change between the two scans
    changed = F.raise_error(F.concat(F.lit("read otherwise than counted: "), F.col("file"))).cast("bigint")
    line = F.when((place >= 0) & (place < F.col("lines")), F.col("lines_before") + place + 1).otherwise(changed)
    return rows.select("file", line.alias("line"), "value")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a file, or of the files of a folder, with its file and its number there.

    Two scans and no shuffle of lines: the first counts the lines of each split, the second
    numbers them from there. No task reads more than its splits."""
    return _numbered(spark, path, _blocks(spark, path, F.lit(True)))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file: its lines, and those of the files before it by name."""
    blocks = _blocks(spark, path, F.lit(True))
    return blocks.groupBy("file").agg(F.sum("lines").alias("lines"), F.min("good_before").alias("before"))


def first_lines(spark: SparkSession, path: str, n: int, good: Column | None = None) -> DataFrame:
    """The first n lines, in the files' own order (files by name), that are ``good`` (a
    condition on ``value``; by default all): file, line and value.

    The first scan also says which splits hold them; only their lines are numbered."""
    good = F.lit(True) if good is None else F.coalesce(good, F.lit(False))
    blocks = _blocks(spark, path, good)
    some = blocks.filter((F.col("good_before") < n) & (F.col("good") > 0))
    return _numbered(spark, path, some).filter(good).orderBy("file", "line").limit(n)
