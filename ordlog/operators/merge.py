"""Merging sorted tables by what is known of their order.

A sorted table's shards follow one another, so the first row of each says which stretch of
the order it covers. Shards that no other table reaches into are taken over where they lie;
only where tables overlap are rows sorted again, cluster by cluster. Tables that follow one
another whole are merged without moving a row. What the driver sees is one short row for
each shard.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordlog import workspace
from ordlog.operators import segments
from ordlog.operators.segments import Positioned

_END = ((2,),)  # behind all that begins alike


@dataclass(frozen=True)
class _Stretch:
    low: tuple
    high: tuple
    table: int
    shard: int
    rows: int


def _element(value) -> tuple:
    """Compares as Spark orders ascending: nulls first, NaN last, texts by bytes."""
    if value is None:
        return (0,)
    if isinstance(value, str):
        return 1, value.encode()
    if isinstance(value, float) and value != value:
        return 1, float("inf"), 1
    return (1, value, 0) if isinstance(value, float) else (1, value)


def _bounds(table: Positioned, number: int) -> list[_Stretch]:
    """The shards of a table with the stretches they cover, by cut texts."""
    heads, cut = [], F.lit(False)
    for c in table.keys:
        if table.data.schema[c].dataType.typeName() in ("string", "binary"):
            head, long = segments.head_of(c)
            heads.append(F.when(~cut, F.struct(head.alias("v"), long.alias("long"))))
            cut = cut | long
        else:
            heads.append(F.when(~cut, F.struct(F.col(c).alias("v"), F.lit(False).alias("long"))))
    names = [f"k{i}" for i in range(len(heads))]
    sizes = {r.shard: r["rows"] for r in table.table.select("shard", "rows").collect()}
    if not sizes:
        return []
    last = max(sizes)
    # files and pages whose statistics have no such row are not read
    wanted = (F.col("pos") == 0) | (F.col("shard") == last) & (F.col("pos") == sizes[last] - 1)
    edges = table.data.filter(wanted).select("shard", "pos", *[h.alias(n) for h, n in zip(heads, names)]).collect()

    def low(row) -> tuple:
        return tuple(_element(bytes(p.v) if isinstance(p.v, bytearray) else p.v) for p in (row[n] for n in names) if p is not None)

    def high(row) -> tuple:
        return low(row) + (_END if any(row[n] is not None and row[n].long for n in names) else ())

    first = {r.shard: r for r in edges if r.pos == 0}
    order = sorted(sizes)
    ends = [first[s] for s in order[1:]] + [next(r for r in edges if r.shard == last and r.pos == sizes[last] - 1)]
    # no shard ends behind a later one, or begins before an earlier one
    highs = list(accumulate(map(high, reversed(ends)), min))[::-1]
    lows = accumulate((low(first[s]) for s in order), max)
    return [_Stretch(a, b, number, s, sizes[s]) for s, a, b in zip(order, lows, highs)]


def _clusters(stretches: list[_Stretch]) -> list[list[_Stretch]]:
    """Stretches in order, those together that overlap with another table's.

    Bounds of cut texts may overlap within a table; there the shards' own order holds."""
    out: list[list[_Stretch]] = []
    reach: list[dict[int, tuple]] = []  # how far each table reaches in each cluster
    for s in sorted(stretches, key=lambda s: (s.low, s.high, s.table, s.shard)):
        cluster, ends = [s], {s.table: s.high}
        while out and any(s.low < high for table, high in reach[-1].items() if table != s.table):
            cluster = out.pop() + cluster
            for table, high in reach.pop().items():
                ends[table] = max(ends.get(table, high), high)
        out.append(cluster)
        reach.append(ends)
    return out


def merge(tables: list[Positioned], shards: int | None = None) -> DataFrame:
    """The rows of all tables, which are sorted alike, with ``offset`` in one order."""
    first = tables[0]
    if any(t.group or t.keys is None or t.keys != first.keys for t in tables):
        raise ValueError("the tables are not sorted by the same columns")
    spark = first.data.sparkSession
    clusters = _clusters([s for i, t in enumerate(tables) for s in _bounds(t, i)])
    kept: dict[int, list] = {i: [] for i in range(len(tables))}
    mixed: dict[int, list] = {i: [] for i in range(len(tables))}
    begins, start = [], 0
    for n, cluster in enumerate(clusters):
        if len(cluster) == 1:
            kept[cluster[0].table].append((cluster[0].shard, start, 0, cluster[0].rows))
        else:
            begins.append((n, start))
            for s in cluster:
                mixed[s.table].append((s.shard, n))
        start += sum(s.rows for s in cluster)
    out = [_taken(t, kept[i]) for i, t in enumerate(tables) if kept[i]]
    if begins:
        parts = []
        for i, t in enumerate(tables):
            if mixed[i]:
                at = spark.createDataFrame(mixed[i], "_shard int, _cluster bigint")
                near = _only(t.data, [s for s, _ in mixed[i]])
                parts.append(near.join(F.broadcast(at), F.col("shard") == F.col("_shard")).select(*first.columns, "_cluster"))
        every = reduce(DataFrame.unionByName, parts)
        path = workspace.fresh(spark, "merged")
        ordered = segments.range_sorted(every, ["_cluster", *first.keys], ties=[], shards=shards)
        data = segments.stage(segments.number(ordered), f"{path}/data")
        starts = segments.starts(data, ["_cluster"])
        base = spark.createDataFrame(begins, "_cluster bigint, _base bigint")
        based = starts.join(F.broadcast(base), "_cluster").withColumn("start", F.col("start") + F.col("_base"))
        table = segments.stage_table(based.drop("_base"), f"{path}/segments")
        out.append(segments.place(data, table, ["_cluster"]).select("offset", *first.columns))
    return reduce(DataFrame.unionByName, out) if out else _taken(first, [])


def _only(data: DataFrame, shards: list[int]) -> DataFrame:
    """Rows of these shards; a scan is told of them unless they are very many."""
    return data.filter(F.col("shard").isin(shards)) if len(shards) <= segments.HEAD_SHARDS else data


def _taken(table: Positioned, places: list[tuple]) -> DataFrame:
    """Shards as they lie, at their new places."""
    schema = "shard int, start bigint, first bigint, rows bigint"
    at = table.data.sparkSession.createDataFrame(places, schema)
    near = _only(table.data, [p[0] for p in places])
    return segments.place(near, at, [], known_rows=len(places)).select("offset", *table.columns)
