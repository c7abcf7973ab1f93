"""Row positions without a single-task window.

A task numbers its own rows while it writes them, so a table becomes segments (one for
each task and group) whose rows carry ``shard`` and ``pos``. The segment table, one row
for each segment, holds where each begins. Then

    offset = segment start + pos - segment's first pos

and no step moves the data through one task. The segment table grows with the number of
tasks, not of rows. It is written as a table of its own, so its real size is known: it is
broadcast below ``spark.sql.autoBroadcastJoinThreshold``, or when it is known to have no
more than ``BROADCAST_SEGMENTS`` rows; beyond that Spark joins by shuffling on the segment.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordlog import workspace

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number here
TASK = "_task"
SHARD_BYTES = 256 << 20  # of the files that a sort reads
_UNKNOWN_SIZE = 1 << 60  # Spark says more than this where it knows nothing
HEAD = 128  # characters of a text that the bounds of shards may have
OFTEN_SHARE = 64
OFTEN_BYTES = 16 << 20
HEAD_SHARDS = 1000  # that a scan is told to keep to
BROADCAST_SEGMENTS = 2_000_000  # some 100 MB in memory


def task_position() -> Column:
    """Number of the row within its task."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))


def refuse(df: DataFrame, *reserved: str) -> None:
    """Columns that are about to be added must not be there yet."""
    taken = sorted({c.lower() for c in df.columns} & set(reserved))
    if taken:
        raise ValueError(f"the table already has {', '.join(taken)}; rename before ordering it")


def number(df: DataFrame) -> DataFrame:
    return df.select("*", F.spark_partition_id().alias("shard"), task_position().alias("pos"))


def scan_bytes(df: DataFrame) -> int:
    """Bytes of what the table's plan reads, as far as Spark knows it; runs nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < _UNKNOWN_SIZE)


def shards_for(spark: SparkSession, size: int) -> int | None:
    """How many shards a sort of this many bytes needs, or None where the session's own
    number of shuffle partitions is enough and adaptive execution may lower it."""
    wanted = -(-size // SHARD_BYTES)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def range_sorted(
    df: DataFrame,
    order: list,
    ties: list[str] | None = None,
    shards: int | None = None,
    longest: dict[str, int] | None = None,
) -> DataFrame:
    """Sort the whole table: task i holds rows that come before those of task i+1.

    ``ties`` (by default every column) make the order total, for any number of shards. Spark
    samples the bounds of the shards on the driver, so they are short: ``short_keys`` of the
    order's columns, whole only inside a shard. The last range column is the number of the
    task the row came from: it spreads even a huge group of identical rows over shards, and
    being a property of the input split it is the same when a lost task runs again.
    ``longest``: ``longest_texts`` of the table, where the caller knows it.
    """
    keys = total_order(df, order, ties)
    shards = shards or shards_for(df.sparkSession, scan_bytes(df))
    tagged = df.withColumn(TASK, F.spark_partition_id())
    size = [shards] if shards else []
    ranged = tagged.repartitionByRange(*size, *short_keys(df, order, ties, longest)).drop(TASK)
    return ranged.sortWithinPartitions(*keys)


def short_keys(
    df: DataFrame, order: list, ties: list[str] | None = None, longest: dict[str, int] | None = None
) -> list[Column]:
    """Columns that order rows as the whole order does, or leave them equal, of which none is
    longer than a text's first ``HEAD`` characters. Expressions of the caller's stay whole,
    and so do texts of which none is longer.

    Once a text has been cut, columns behind it say nothing of the order, and the rows are
    equal, unless the text is one that very many rows have: such are found beforehand and
    known as a whole (``often``), so that a large group of copies is parted by what follows."""
    named = [c for c in order if isinstance(c, str)]
    rest = [c for c in (df.columns if ties is None else ties) if c not in named]
    texts = _texts(df, [*named, *rest])
    sizes = longest_texts(df, texts) if longest is None else longest
    texts = [c for c in texts if sizes[c] > HEAD]
    copies = often(df, texts)
    out, whole = [], None
    held = lambda c: c if whole is None else F.when(whole, c)
    for c in [*order, *rest]:
        if not isinstance(c, str):
            out.append(c)
        elif c not in texts:
            out.append(held(_comparable(df, c)))
        else:
            head, long = head_of(c)
            place = long.cast("int")  # a whole text comes before those that go on
            if copies[c]:
                heads = sorted({v[:HEAD] for v in copies[c]})
                above = [(F.col(c) >= F.lit(v)).cast("int") + (F.col(c) > F.lit(v)).cast("int") for v in copies[c]]
                place = F.when(long & head.isin(heads), reduce(Column.__add__, above, F.lit(1))).otherwise(place)
            out += [held(head), held(place)]
            ends = ~long | F.col(c).isin(copies[c]) if copies[c] else ~long
            whole = ends if whole is None else whole & ends
    return [*out, held(F.col(TASK))]


def _texts(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType))]


def longest_texts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """The most bytes that a value of each text column has: one scan of lengths."""
    texts = _texts(df, columns)
    if not texts:
        return {}
    return {c: n or 0 for c, n in zip(texts, df.agg(*[F.max(F.octet_length(c)) for c in texts]).first())}


def head_of(c: str) -> tuple[Column, Column]:
    """A text's beginning, and whether there is more of it."""
    head = F.substring(c, 1, HEAD)
    return head, F.coalesce(F.octet_length(F.col(c)) > F.octet_length(head), F.lit(False))


def often(df: DataFrame, texts: list[str]) -> dict[str, list]:
    """The long values of text columns that one of ``OFTEN_SHARE`` rows or more has, by
    Spark's sketch of frequent items over hashes; of them those of up to ``OFTEN_BYTES``. The
    rest is as good as rare: what is sorted does not depend on it, only how evenly."""
    if not texts:
        return {}
    hashes = [F.when(head_of(c)[1], F.xxhash64(c)).alias(f"_{i}") for i, c in enumerate(texts)]
    sketch = "approx_top_k({0}, {1}) as {0}"
    seen = df.select(*hashes).selectExpr(
        "count(*) as rows",
        *[f"count(_{i}) as n{i}" for i in range(len(texts))],
        *[sketch.format(f"_{i}", OFTEN_SHARE) for i in range(len(texts))],
    ).first()
    out: dict[str, list] = {}
    for i, c in enumerate(texts):
        found = [t for t in seen[f"_{i}"] or [] if t["item"] is not None and t["count"] * OFTEN_SHARE >= seen["rows"]]
        out[c] = []
        if found and seen[f"n{i}"]:
            mine = df.filter(F.xxhash64(c).isin([t["item"] for t in found]) & (F.octet_length(c) <= OFTEN_BYTES // OFTEN_SHARE))
            values = mine.groupBy(F.xxhash64(c)).agg(F.first(c)).collect()
            out[c] = sorted(r[1] for r in values)
    return out


def total_order(df: DataFrame, order: list, ties: list[str] | None = None) -> list[Column]:
    """The order's columns and after them what breaks its ties, by default every column."""
    # a named key is already ordered; an expression's own columns still break its ties
    named = [c for c in order if isinstance(c, str)]
    rest = [c for c in (df.columns if ties is None else ties) if c not in named]
    return [F.col(c) if isinstance(c, str) else c for c in order] + [_comparable(df, c) for c in rest]


def _comparable(df: DataFrame, column: str) -> Column:
    """The column, or of what has no order of its own something that has."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.MapType):
        entries = F.map_entries(column)
        return F.sort_array(entries) if not _unordered(kind.valueType) else F.to_json(column)
    return F.to_json(F.struct(F.col(column))) if _unordered(kind) else F.col(column)


def _unordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def running_starts(counts: DataFrame, group: list[str]) -> DataFrame:
    """Where each segment begins in its group: the rows of the shards before it."""
    before = Window.partitionBy(*group).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("bigint"))


def starts(data: DataFrame, group: list[str]) -> DataFrame:
    """The segment table of numbered data: rows, first pos and start of each segment.

    Without groups a segment is all of a task, so it begins at 0 and pos is not read.
    """
    first = F.min("pos") if group else F.lit(0).cast("bigint")
    counts = data.groupBy(*group, "shard").agg(F.count("*").alias("rows"), first.alias("first"))
    return running_starts(counts, group)


def place(
    data: DataFrame,
    table: DataFrame,
    group: list[str],
    missing_groups: bool = False,
    known_rows: int | None = None,
) -> DataFrame:
    """Give numbered data its ``offset`` from the segment table.

    ``missing_groups``: NULL is a group too, at the price of a costlier comparison.
    ``known_rows``: the size of the segment table, where the caller has counted it."""
    start = table.select(
        *[F.col(g).alias(f"_{g}") for g in group],
        F.col("shard").alias("_shard"),
        (F.col("start") - F.col("first")).alias("_shift"),
    )
    mine = F.col("shard") == F.col("_shard")
    for g in group:
        pair = F.col(g), F.col(f"_{g}")
        mine = mine & (pair[0].eqNullSafe(pair[1]) if missing_groups else pair[0] == pair[1])
    small = known_rows is not None and known_rows <= BROADCAST_SEGMENTS
    placed = data.join(F.broadcast(start) if small else start, mine)
    return placed.withColumn("offset", F.col("_shift") + F.col("pos")).drop(*start.columns, "shard", "pos")


def place_head(
    data: DataFrame, table: DataFrame, group: list[str], n: int, missing_groups: bool = False
) -> DataFrame:
    """The first n rows of each group.

    The segment table tells which segments reach below n: rows of others are not joined, and
    files whose statistics have none of their shards are not read.
    """
    reached = table.filter(F.col("start") < n)
    shards = [r[0] for r in reached.select("shard").distinct().limit(HEAD_SHARDS + 1).collect()]
    near = data.filter(F.col("shard").isin(shards)) if len(shards) <= HEAD_SHARDS else data
    return place(near, reached, group, missing_groups).filter(F.col("offset") < n)


def stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table once and read it back; the plan behind it does not run again."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_table(table: DataFrame, path: str) -> DataFrame:
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


@dataclass(frozen=True)
class Positioned:
    """A sorted table as it was written, with its segment table. ``keys``: the columns it is
    sorted by, ascending, the ties after the order's own; None if there are others."""

    data: DataFrame
    table: DataFrame
    group: list[str]
    columns: list[str]
    keys: list[str] | None = None

    def _shaped(self, placed: DataFrame) -> DataFrame:
        return placed.select(*self.group, "offset", *[c for c in self.columns if c not in self.group])

    def rows(self) -> DataFrame:
        return self._shaped(place(self.data, self.table, self.group, missing_groups=True))

    def head(self, n: int) -> DataFrame:
        """The first n rows (of each group), without reading the rest."""
        return self._shaped(place_head(self.data, self.table, self.group, n, missing_groups=True))


def write_positioned(
    df: DataFrame,
    order: list,
    ties: list[str] | None = None,
    within: list[str] | None = None,
    shards: int | None = None,
) -> Positioned:
    """Sort the table and give each row its position in the given order.

    ``within`` restarts the offsets for each value of those columns, however the rows are
    spread over them. The sorted table is written once to the shared work folder: range
    bounds come from a sample, so the sort must not be evaluated twice.
    """
    refuse(df, "offset", "shard", "pos", TASK)
    group = list(within or [])
    path = workspace.fresh(df.sparkSession, "sorted")
    data = stage(number(range_sorted(df, [*group, *order], ties, shards)), f"{path}/data")
    table = stage_table(starts(data, group), f"{path}/segments")
    named = all(isinstance(c, str) for c in order)
    keys = [*order, *[c for c in (df.columns if ties is None else ties) if c not in order]] if named else None
    return Positioned(data, table, group, df.columns, keys)


def positioned(
    df: DataFrame,
    order: list,
    ties: list[str] | None = None,
    within: list[str] | None = None,
    shards: int | None = None,
) -> DataFrame:
    """``write_positioned`` as a table: the columns and ``offset``."""
    return write_positioned(df, order, ties, within, shards).rows()
