"""Is a log in order? Every adjacent pair of rows is compared, over the whole log.

Done in two steps, so that the log itself is not shuffled:

1. Where the rows lie. Each Arrow batch is cut into runs of consecutive offsets; a run
   shrinks to one row with its first and last key and what was found inside it. A stored
   log is read in offset order, so a batch is mostly one run.
2. Between runs. The runs are ordered by window, but never a whole log partition in one
   task: neighbouring runs are cut into pieces of ``width`` offsets, each piece shrinks to
   one row again, and the pieces are treated the same way until one row is left.

The result does not depend on how the rows arrive: in the worst case each is a run of its
own. Offsets may have gaps; a missing key counts as the smallest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordlog import workspace
from ordlog.operators.compare import QUARTER_BITS, QUARTERS
from ordlog.operators.segments import stage
from ordlog.schema import REPORTED_VIOLATIONS

BY = ("topic", "partition")
WIDTH = 100_000
REPORT = ["rows", "violations", "gapless"]


def _shrink(by: list[str], report: int) -> Callable[[Iterator], Iterator]:
    """Batch of (by, offset, key, hash) -> its runs. Needs nothing but Arrow on the workers."""
    quarters, bits = QUARTERS, QUARTER_BITS

    def cut(batch, pc, np):
        offset = np.asarray(batch.column("offset"))
        joined = np.ones(max(len(offset) - 1, 0), dtype=bool)
        for c in by:
            column = batch.column(c)
            joined &= np.asarray(pc.equal(column[1:], column[:-1]).fill_null(False))
        joined &= offset[1:] == offset[:-1] + 1
        return offset, joined

    def inverted(key, pa, pc, np):
        """True where a key is followed by a smaller one."""
        before, after = key[:-1], key[1:]
        down = np.asarray(pc.greater(before, after).fill_null(False))
        known = np.asarray(pc.is_valid(key))
        if pa.types.is_floating(key.type):
            # NaN is the largest number
            nan = np.asarray(pc.is_nan(key).fill_null(False))
            down = down | (nan[:-1] & known[1:] & ~nan[1:])
        return down | (known[:-1] & ~known[1:])

    def shrink(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            if batch.num_rows == 0:
                continue
            offset, joined = cut(batch, pc, np)
            if not joined.all():
                wanted = [(c, "ascending") for c in (*by, "offset")]
                batch = batch.take(pc.sort_indices(batch, sort_keys=wanted))
                offset, joined = cut(batch, pc, np)
            key = batch.column("key")
            down = inverted(key, pa, pc, np) & joined
            starts = np.concatenate([[0], np.flatnonzero(~joined) + 1])
            ends = np.concatenate([starts[1:], [len(offset)]]) - 1
            hashes = np.asarray(batch.column("hash")).view(np.uint64)
            counted = np.concatenate([down, [False]]).astype(np.int64)
            columns = {c: batch.column(c).take(pa.array(starts)) for c in by}
            columns |= {
                "rows": ends - starts + 1,
                "violations": np.add.reduceat(counted, starts),
                "repeats": np.zeros(len(starts), dtype=np.int64),
                "first": key.take(pa.array(starts)),
                "last": key.take(pa.array(ends)),
                "begin": offset[starts],
                "end": offset[ends],
            }
            for i, name in enumerate(quarters):
                quarter = hashes >> np.uint64(bits * i) & np.uint64((1 << bits) - 1)
                columns[name] = np.add.reduceat(quarter.astype(np.int64), starts)
            if report:
                at = np.flatnonzero(down)
                run = np.searchsorted(starts, at, side="right") - 1
                nth = np.arange(len(at)) - np.searchsorted(run, run, side="left")
                kept = at[nth < report]
                run = run[nth < report]
                found = pa.StructArray.from_arrays(
                    [pa.array(offset[kept + 1]), key.take(pa.array(kept)), key.take(pa.array(kept + 1))],
                    ["offset", "before", "key"],
                )
                bounds = np.searchsorted(run, np.arange(len(starts) + 1)).astype(np.int32)
                columns["found"] = pa.ListArray.from_arrays(pa.array(bounds), found)
            yield pa.RecordBatch.from_pydict(columns)

    return shrink


def _runs(
    log: DataFrame, key: Column | str, by: list[str], line: Column | None = None, report: int = 0
) -> DataFrame:
    line_hash = F.xxhash64(line) if line is not None else F.lit(0).cast("bigint")
    key = F.col(key) if isinstance(key, str) else key
    rows = log.select(*by, F.col("offset").cast("bigint"), key.alias("key"), line_hash.alias("hash"))
    key_type = rows.schema["key"].dataType
    schema = T.StructType([rows.schema[c] for c in by])
    for name in ("rows", "violations", "repeats"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("first", key_type).add("last", key_type)
    for name in ("begin", "end", *QUARTERS):
        schema = schema.add(name, T.LongType())
    if report:
        pair = T.StructType().add("offset", T.LongType()).add("before", key_type).add("key", key_type)
        schema = schema.add("found", T.ArrayType(pair))
    return rows.mapInArrow(_shrink(by, report), schema)


def _greater(left: str, right: str) -> Column:
    """Compared as rows, where a missing value has a place: before all others."""
    return F.struct(F.col(left).alias("k")) > F.struct(F.col(right).alias("k"))


def _levels(by: list[str], width: int) -> list[tuple[list[str], int]]:
    """Groups in which neighbours are compared, and the width of their pieces."""
    return [([*by, "piece"], width), ([*by, "piece"], width * width), (by, 0)]


def _neighbours(level: DataFrame, group: list[str], width: int) -> DataFrame:
    window = Window.partitionBy(*group).orderBy("begin")
    pieces = level.withColumn("piece", F.expr(f"begin div {width}L")) if width else level
    return pieces.withColumns(
        {"last_before": F.lag("last").over(window), "end_before": F.lag("end").over(window)}
    )


def order_report(
    log: DataFrame,
    key: Column | str,
    by: tuple[str, ...] = BY,
    line: Column | None = None,
    chain: str | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """One row for each log partition: rows, violations, whether offsets are gapless and unique.

    ``chain`` names the column of ``by`` along which one log goes on: its partitions, say,
    if they follow one another. The report is then on the whole, with their number.

    ``line`` is an expression whose fingerprint is taken in the same scan, for comparing the
    log's rows as a multiset with another table's.
    """
    by = list(by)
    level = _runs(log, key, by, line)
    seam = F.col("end_before").isNotNull()
    for group, piece_width in _levels(by, width):
        level = (
            _neighbours(level, group, piece_width)
            .groupBy(*group)
            .agg(
                F.sum("rows").alias("rows"),
                (F.sum("violations") + F.count_if(seam & _greater("last_before", "first"))).alias("violations"),
                (F.sum("repeats") + F.count_if(F.col("end_before") >= F.col("begin"))).alias("repeats"),
                F.min_by("first", "begin").alias("first"),
                F.max_by("last", "begin").alias("last"),
                F.min("begin").alias("begin"),
                F.max("end").alias("end"),
                *[F.sum(q).alias(q) for q in QUARTERS],
            )
            .drop("piece")
        )
    dense = (F.col("end") - F.col("begin") + 1 == F.col("rows")) & (F.col("repeats") == 0)
    level = level.withColumn("gapless", dense)
    if chain:
        rest = [c for c in by if c != chain]
        window = Window.partitionBy(*rest).orderBy(chain)
        seam = F.col("chain_before").isNotNull() & _greater("last_before", "first")
        level = (
            level.withColumns(
                {"last_before": F.lag("last").over(window), "chain_before": F.lag(chain).over(window)}
            )
            .groupBy(*rest)
            .agg(
                F.count("*").alias(f"{chain}s"),
                F.sum("rows").alias("rows"),
                (F.sum("violations") + F.count_if(seam)).alias("violations"),
                F.bool_and("gapless").alias("gapless"),
                *[F.sum(q).alias(q) for q in QUARTERS],
            )
        )
        by = [*rest, f"{chain}s"]
    return level.select(*by, *REPORT, *(QUARTERS if line is not None else []))


def first_violations(
    log: DataFrame,
    key: Column | str,
    n: int = REPORTED_VIOLATIONS,
    by: tuple[str, ...] = BY,
    width: int = WIDTH,
) -> DataFrame:
    """The first n rows of each partition whose key is smaller than the one before, numbered.

    A run reports its first n; what lies between runs is added, and the first n of all stay.
    The runs, a small part of the log, are written down first, so that the log is read once.
    """
    by = list(by)
    level = stage(_runs(log, key, by, report=n), workspace.fresh(log.sparkSession, "runs"))
    inside = level.select(*by, F.inline("found"))
    found = [inside]
    for group, piece_width in _levels(by, width):
        pairs = _neighbours(level, group, piece_width)
        broken = pairs.filter(F.col("end_before").isNotNull() & _greater("last_before", "first"))
        found.append(
            broken.select(
                *by,
                F.col("begin").alias("offset"),
                F.col("last_before").alias("before"),
                F.col("first").alias("key"),
            )
        )
        level = (
            pairs.groupBy(*group)
            .agg(
                F.min_by("first", "begin").alias("first"),
                F.max_by("last", "begin").alias("last"),
                F.min("begin").alias("begin"),
                F.max("end").alias("end"),
            )
            .drop("piece")
        )
    window = Window.partitionBy(*by).orderBy("offset")
    ranked = reduce(DataFrame.unionByName, found).withColumn("nth", F.row_number().over(window))
    return ranked.filter(F.col("nth") <= n)
