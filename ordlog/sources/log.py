"""Logs kept as Parquet: lines in the order they came in, and records in the order of a key.

Layout below a root folder::

    data/topic=<t>/run=<n>/       lines: partition, shard, pos, key, value
    ordered/run=<n>/              records of one or more ordered topics: topic, shard, pos, value
    segments/topic=<t>/run=<n>/   one row for each segment: which run holds it, where it begins
    sketches/topic=<t>/run=<n>/   sketches of the keys' values, where a publish made them

Every publish is a run. Its rows are numbered by the tasks that write them and become visible
when its segments are recorded, so a publish that dies half-way is never read. The segments
also say with which run the topic begins: a publish that replaces a topic names itself, so
until its commit the old rows are read and from then on the new ones. Only then do the old
runs go. A topic may therefore be published to itself. One publisher at a time writes to a
topic, and one at a time publishes ordered topics below a root.

Several orders of the same records are one publish: one job sorts them beside each other and
one commit shows them. A topic that is appended to stays ordered: its segments' first rows
part its keys into ranges, and only the segments that the new rows fall into are written anew.
The others are carried over by naming the run that holds them. ``compact`` makes one run of
many.

A partition of an unordered topic is a column, not a folder: writing folders would cost each
task a sort, and readers take a topic whole. The same rows come from a Kafka topic through
``ordlog.sources.kafka``.
"""

from __future__ import annotations

import bisect
import re
import sys
import time
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordlog import workspace
from ordlog.functions.codec import drop_empty, key_column, normalize_lines, parse_all, serialize
from ordlog.operators import segments
from ordlog.operators.order import bucket_rank
from ordlog.operators.probe import HIGH, LOW, LOW_CARDINALITY
from ordlog.schema import FIELDS, LOG, SOURCE_PARTITIONS

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package

_LEGAL_TOPIC = re.compile(r"[a-zA-Z0-9._-]{1,249}")
_BEFORE = -1  # shard of the empty segment that each run has of each partition, at its end so far

STORED = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("shard", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("run", T.LongType()),
    ]
)
ORDERED = "topic string, shard bigint, pos bigint, value string, run bigint"
# at: the run that holds the rows; ordered: where that run lies; low: the first line of a
# segment that does not begin its task's rows; since: the first run that counts
SEGMENTS = """partition int, shard bigint, rows bigint, first bigint, start bigint, since bigint, at bigint,
    ordered boolean, low string, run bigint"""
SORTED = "ordered"
SKETCHES = "key string, parsed bigint, sketch binary"


def _checked(topic: str) -> str:
    if not _LEGAL_TOPIC.fullmatch(topic) or topic in (".", ".."):
        raise ValueError(f"illegal topic name {topic!r}")
    return topic


def data_path(root: str, topic: str) -> str:
    return f"{root}/data/topic={_checked(topic)}"


def _sketch_path(root: str, topic: str) -> str:
    return f"{root}/sketches/topic={_checked(topic)}"


def _segments_path(root: str, topic: str) -> str:
    return f"{root}/segments/topic={_checked(topic)}"


@dataclass(frozen=True)
class State:
    """What a topic is at one moment, which is what a bounded read covers."""

    runs: list[int]  # publishes whose segments count
    places: list[tuple[bool, int]]  # the runs that hold rows, and whether they are ordered ones
    size: int  # segments


def segment_table(
    spark: SparkSession, root: str, topic: str, runs: Iterable[int] | None = None
) -> DataFrame:
    """The topic's segments, of all runs that count by now or of the given ones; ``run`` is
    the run that holds the rows.

    Given runs are read by their own folders: Spark takes two scans of one folder for the
    same table, though files were added between them.
    """
    path = _segments_path(root, topic)
    runs = state(spark, root, topic).runs if runs is None else runs
    paths = [f"{path}/run={r}" for r in runs]
    reader = spark.read.schema(SEGMENTS).option("basePath", path)
    rows = reader.parquet(*paths) if paths else spark.createDataFrame([], SEGMENTS)
    return rows.drop("run").withColumnRenamed("at", "run")


def state(spark: SparkSession, root: str, topic: str) -> State:
    """What the topic is at this moment: one row for each publish, and run that holds rows."""
    table = spark.read.schema(SEGMENTS).parquet(_segments_path(root, topic))
    count = F.count_if(F.col("shard") != _BEFORE).alias("n")
    rows = table.groupBy("run", "at", "ordered").agg(count, F.max("since").alias("since")).collect()
    last = max((r.run for r in rows), default=0)
    begin = max((r.since for r in rows if r.run == last), default=0)
    live = [r for r in rows if r.run >= begin]
    places = sorted({(r.ordered, r["at"]) for r in live if r.n})
    return State(sorted({r.run for r in live}), places, sum(r.n for r in live))


def recorded_runs(spark: SparkSession, root: str, topic: str) -> list[int]:
    """The publishes that count at this moment."""
    return state(spark, root, topic).runs


def create_log(spark: SparkSession, root: str, topic: str, partitions: int = 1) -> None:
    """Make the topic, empty, with this many partitions; an older one goes."""
    _commit(spark.createDataFrame([], STORED).drop("run"), root, topic, partitions)


def _known_runs(spark: SparkSession, root: str, topic: str) -> list[int]:
    """Every run that left a folder that may be the topic's, recorded or not."""
    paths = data_path(root, topic), f"{root}/{SORTED}", _segments_path(root, topic)
    return [run for path in paths for run in _runs_in(spark, path)]


def _next_run(known: Iterable[int]) -> int:
    """A run is named by the time, so that one that died is never taken for a later one."""
    return max(time.time_ns() // 1_000_000, max(known, default=_BEFORE) + 1)


def _drop_runs(spark: SparkSession, root: str, topic: str, keep: int) -> None:
    """Delete what the topic's publishes before this one left, unless it is still in use."""
    used = set(state(spark, root, topic).places)
    paths = [(f"{_segments_path(root, topic)}/run={r}", r) for r in _runs_in(spark, _segments_path(root, topic))]
    paths += [(f"{_sketch_path(root, topic)}/run={r}", r) for r in _runs_in(spark, _sketch_path(root, topic))]
    paths += [(f"{data_path(root, topic)}/run={r}", r) for r in _runs_in(spark, data_path(root, topic)) if (False, r) not in used]
    for path, run in paths:
        if run < keep:
            workspace.drop(spark, path)


def _runs_in(spark: SparkSession, path: str) -> list[int]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []
    return [int(n.removeprefix("run=")) for n in names if n.startswith("run=")]


def _drop_orders(spark: SparkSession, root: str, before: int) -> None:
    """Delete ordered runs that no topic reads any more."""
    path = f"{root}/segments"
    table = spark.read.schema(f"topic string, {SEGMENTS}").parquet(path).filter("ordered")
    used = {r["at"] for r in table.select("at").distinct().collect()}
    for run in _runs_in(spark, f"{root}/{SORTED}"):
        if run < before and run not in used:
            workspace.drop(spark, f"{root}/{SORTED}/run={run}")


def _commit(
    rows: DataFrame, root: str, topic: str, partitions: int | None = None, parts_of_tasks: bool = False
) -> int:
    """Write numbered lines as a run, then record its segments; returns its rows.

    With ``partitions`` the run replaces the topic, which then has so many; without it comes
    after the runs there are. ``parts_of_tasks``: segments are stretches of their task's
    rows, not all of them.
    """
    spark = rows.sparkSession
    run = _next_run(_known_runs(spark, root, topic))
    if partitions is None:
        table = segment_table(spark, root, topic)
        # what the partitions held so far, and with which run they begin
        before = table.groupBy("partition").agg(
            F.max(F.col("start") + F.col("rows")).alias("rows"), F.max("since").alias("since")
        )
    else:
        before = spark.range(0, partitions, 1, 1).select(
            F.col("id").cast("int").alias("partition"),
            F.lit(0).cast("bigint").alias("rows"),
            F.lit(run).cast("bigint").alias("since"),
        )
    rows.write.mode("overwrite").parquet(f"{data_path(root, topic)}/run={run}")

    first = F.min("pos") if parts_of_tasks else F.lit(0).cast("bigint")
    counts = (
        _read_places(spark, root, topic, [(False, run)])
        .groupBy("partition", "shard")
        .agg(F.count("*").alias("rows"), first.alias("first"), F.lit(None).cast("bigint").alias("since"))
    )
    begin = before.select(
        "partition", F.lit(_BEFORE).cast("bigint").alias("shard"), "rows", F.lit(0).alias("first"), "since"
    )
    table = _recorded(segments.running_starts(counts.unionByName(begin), ["partition"]), run, ordered=False)
    written = Observation("written")
    counted = table.coalesce(1).observe(written, F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    counted.write.mode("overwrite").parquet(f"{_segments_path(root, topic)}/run={run}")
    sent = written.get["rows"]
    if partitions is not None:
        _drop_runs(spark, root, topic, run)
    return sent


def _recorded(started: DataFrame, run: int, ordered: bool, *more: str) -> DataFrame:
    """Segments as they are recorded, the empty ones ahead of each partition included."""
    ahead = F.col("shard") == _BEFORE
    return started.select(
        *more,
        "partition",
        "shard",
        F.when(ahead, 0).otherwise(F.col("rows")).cast("bigint").alias("rows"),
        F.col("first").cast("bigint").alias("first"),
        F.when(ahead, F.col("rows")).otherwise(F.col("start")).alias("start"),
        "since",
        F.lit(run).cast("bigint").alias("at"),
        F.lit(ordered).alias("ordered"),
        F.lit(None).cast("string").alias("low"),
    )


def _width(mode: str, partitions: int) -> int | None:
    """Partitions of a topic that is made anew, None for one that goes on."""
    return None if mode == "append" else partitions


def _task() -> Column:
    return F.spark_partition_id().cast("bigint")


def publish(
    lines: DataFrame,
    root: str,
    topic: str,
    partitions: int = SOURCE_PARTITIONS,
    mode: str = "overwrite",
    sketched: Iterable[str] = (),
) -> int:
    """Write every line, outer blanks off, to the topic's partitions in turn; returns rows sent.

    No shuffle: each task deals its rows out to the partitions, tasks beginning at different
    ones, and numbers them. With mode ``append`` the topic and its partitions must exist.
    ``sketched``: keys whose values are sketched on the way, for ``cardinality``.
    """
    spark = lines.sparkSession
    new = _width(mode, partitions)
    if mode == "append":
        partitions = segment_table(spark, root, topic).select("partition").distinct().count()
    key = F.col("key") if "key" in lines.columns else F.lit(None).cast("string")
    nth = F.col("_nth")
    numbered = normalize_lines(lines.select(key.alias("key"), "value")).select(
        "*", _task().alias("shard"), segments.task_position().alias("_nth")
    )
    rows = numbered.select(
        F.pmod(nth + F.col("shard"), F.lit(partitions)).cast("int").alias("partition"),
        "shard",
        F.expr(f"_nth div {partitions}").alias("pos"),
        "key",
        "value",
    )
    keys = list(sketched)
    if not keys:
        return _commit(rows, root, topic, new)
    seen = Observation("sketches")
    parsed = parse_all(rows).observe(
        seen,
        F.count("id").alias("parsed"),
        *[F.hll_sketch_agg(F.when(F.col("reason").isNull(), key_column(k).cast("string"))).alias(k) for k in keys],
    )
    sent = _commit(parsed.select(*rows.columns), root, topic, new)
    found = [(k, seen.get["parsed"], seen.get[k]) for k in keys]
    run = max(state(spark, root, topic).runs)
    table = spark.createDataFrame(found, SKETCHES).coalesce(1)
    table.write.mode("overwrite").parquet(f"{_sketch_path(root, topic)}/run={run}")
    return sent


def cardinality(spark: SparkSession, root: str, topic: str, threshold: int = LOW_CARDINALITY) -> DataFrame:
    """Whether each sketched key of the topic has few or many values, over all publishes that
    count, by their sketches alone: key, sampled (lines that parse), distinct_keys (an
    estimate) and verdict."""
    have = set(_runs_in(spark, _sketch_path(root, topic)))
    lacking = [r for r in state(spark, root, topic).runs if r not in have]
    if lacking:
        raise ValueError(f"{topic} was published without sketches in runs {lacking}")
    paths = [f"{_sketch_path(root, topic)}/run={r}" for r in state(spark, root, topic).runs]
    merged = spark.read.schema(SKETCHES).parquet(*paths).groupBy("key").agg(
        F.sum("parsed").alias("sampled"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_keys")
    )
    verdict = F.when(F.col("distinct_keys") < threshold, F.lit(LOW)).otherwise(F.lit(HIGH))
    return merged.withColumn("verdict", verdict)


def publish_orders(
    records: DataFrame, root: str, orders: dict[str, str], shards: int | None = None
) -> dict[str, int]:
    """Write records as one ordered topic for each key of ``orders`` (topic: key); returns
    the rows of each.

    A topic has one partition, whose offset order is the order of its key, all fields
    breaking ties. It is written by as many tasks as the sort has shards; only the offsets,
    not the tasks, are in one sequence. All topics are written by one job, whose sorts run
    beside each other, and become visible in one commit.
    """
    spark = records.sparkSession
    topics = list(orders)
    for key in orders.values():
        key_column(key)
    run = _next_run(r for t in topics for r in _known_runs(spark, root, t))
    fields = records.select(*FIELDS)
    longest = segments.longest_texts(fields, list(FIELDS))
    each = [
        segments.range_sorted(fields, [k], shards=shards, longest=longest).select(
            F.lit(t).alias("topic"), serialize().alias("value")
        )
        for t, k in orders.items()
    ]
    # numbered after they are put together: shards of different topics have different numbers
    rows = reduce(DataFrame.unionAll, each).select(
        "topic", _task().alias("shard"), segments.task_position().alias("pos"), "value"
    )
    path = f"{root}/{SORTED}/run={run}"
    rows.write.mode("overwrite").parquet(path)

    written = spark.read.schema(ORDERED).parquet(path)
    counts = written.groupBy("topic", "shard").agg(F.count("*").alias("rows"), F.min("pos").alias("first"))
    ahead = spark.createDataFrame([(t,) for t in topics], "topic string").select(
        "topic", F.lit(_BEFORE).cast("bigint").alias("shard"), F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("first")
    )
    every = counts.unionByName(ahead).withColumn("partition", F.lit(0)).withColumn("since", F.lit(run).cast("bigint"))
    table = _recorded(segments.running_starts(every, ["topic"]), run, True, "topic").withColumn("run", F.lit(run).cast("bigint"))
    seen = [F.sum(F.when(F.col("topic") == t, F.col("rows")).otherwise(0)).alias(f"rows_{i}") for i, t in enumerate(topics)]
    sent = Observation("sent")
    table.coalesce(1).observe(sent, *seen).write.mode("append").partitionBy("topic", "run").parquet(f"{root}/segments")
    out = {t: sent.get[f"rows_{i}"] for i, t in enumerate(topics)}
    for t in topics:
        _drop_runs(spark, root, t, run)
    _drop_orders(spark, root, run)
    return out


def publish_sorted(
    records: DataFrame, root: str, topic: str, key: str, mode: str = "overwrite", shards: int | None = None
) -> int:
    """One ordered topic, by ``publish_orders``; with mode ``append`` the records come to
    their places in the ordered topic that is there, which must have the same key."""
    if mode == "append":
        return _insert(records, root, topic, key, shards)
    return publish_orders(records, root, {topic: key}, shards)[topic]


def _sort_tuple(key: str, values: list) -> tuple:
    """Compares as lines are sorted: by the key, then by all fields; a missing id comes first,
    a missing text is an empty one, texts go by bytes."""
    number, *texts = values
    parts = dict(zip(FIELDS, [(number is not None, number or 0), *[(t or "").encode() for t in texts]]))
    return parts[key], *parts.values()


def _segment_of(key: str, bounds):
    """Adds to records the number of the segment they fall into."""

    def run(batches: Iterable) -> Iterable:
        import pyarrow as pa

        for batch in batches:
            rows = zip(*[batch.column(f).to_pylist() for f in FIELDS])
            at = [bisect.bisect_right(bounds.value, _sort_tuple(key, row)) for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=[*FIELDS, "_no"])

    return run


def _insert(records: DataFrame, root: str, topic: str, key: str, shards: int | None) -> int:
    """Write anew the segments that the records fall into, with them; carry the others over."""
    key_column(key)
    spark = records.sparkSession
    now = state(spark, root, topic)
    if not now.places:
        return publish_sorted(records, root, topic, key, shards=shards)
    if not all(ordered for ordered, _ in now.places):
        raise ValueError(f"{topic} is not an ordered topic, or was not published in the order of a key")
    # one row for each segment
    table = sorted(segment_table(spark, root, topic, now.runs).filter(F.col("shard") != _BEFORE).collect(), key=lambda r: r.start)
    stored = _read_places(spark, root, topic, now.places)
    heads = stored.filter("pos = 0").select("run", "shard", "value").collect()
    first_lines = {(r.run, r.shard): r.value for r in heads}
    low = [r.low if r.low is not None else first_lines.get((r.run, r.shard)) if r.first == 0 else None for r in table]
    known = spark.createDataFrame(list(enumerate(low[1:], 1)), "no int, value string")
    parsed = {r.no: _sort_tuple(key, [r[f] for f in FIELDS]) for r in parse_all(known).collect()}
    bounds = [parsed[i] for i in range(1, len(table))]
    if bounds != sorted(bounds):
        raise ValueError(f"{topic} is not in the order of {key}")
    shared = spark.sparkContext.broadcast(bounds)

    path = workspace.fresh(spark, "appended")
    fields = records.select(*FIELDS)
    new = segments.stage(fields.mapInArrow(_segment_of(key, shared), T.StructType([*fields.schema.fields, T.StructField("_no", T.LongType())])), path)
    touched = sorted(r[0] for r in new.select("_no").distinct().collect())
    if not touched:
        return 0
    places = [(table[i].run, table[i].shard, table[i].first, table[i].first + table[i].rows, i) for i in touched]
    at = spark.createDataFrame(places, "_run bigint, _shard bigint, _first bigint, _end bigint, _no bigint")
    mine = (F.col("run") == F.col("_run")) & (F.col("shard") == F.col("_shard"))
    mine = mine & (F.col("pos") >= F.col("_first")) & (F.col("pos") < F.col("_end"))
    near = _read_places(spark, root, topic, [p for p in now.places if p[1] in {x[0] for x in places}])
    near = near.filter(F.col("shard").isin([x[1] for x in places]))
    old = parse_all(near.join(F.broadcast(at), mine).select("value", "_no")).select(*FIELDS, "_no")
    ordered = segments.range_sorted(old.unionByName(new), ["_no", key], ties=list(FIELDS), shards=shards)
    run = _next_run(_known_runs(spark, root, topic))
    rows = ordered.select(
        F.lit(topic).alias("topic"),
        (F.shiftleft("_no", 32) + _task()).alias("shard"),
        segments.task_position().alias("pos"),
        serialize().alias("value"),
    )
    to = f"{root}/{SORTED}/run={run}"
    rows.write.mode("overwrite").parquet(to)
    sizes = spark.read.schema(ORDERED).parquet(to).groupBy("shard").agg(F.count("*").alias("rows"), F.min("pos").alias("first"))
    made: dict[int, list] = {}
    for r in sorted(sizes.collect(), key=lambda r: r.shard):
        made.setdefault(r.shard >> 32, []).append(r)
    start, out = 0, [(0, _BEFORE, 0, 0, 0, run, run, True, None)]
    for i, r in enumerate(table):
        parts = [(m.shard, m.rows, m.first, run, low[i] if m.first else None) for m in made.get(i, [])]
        for shard, size, first, where, line in parts or [(r.shard, r.rows, r.first, r.run, low[i] if r.first else None)]:
            out.append((0, shard, size, first, start, run, where, True, line))
            start += size
    recorded = spark.createDataFrame(out, SEGMENTS.rpartition(",")[0])
    recorded.coalesce(1).write.mode("overwrite").parquet(f"{_segments_path(root, topic)}/run={run}")
    added = start - sum(r.rows for r in table)
    workspace.drop(spark, path)
    _drop_runs(spark, root, topic, run)
    _drop_orders(spark, root, run)
    return added


def compact(spark: SparkSession, root: str, topic: str) -> None:
    """Make one run of all runs of an unordered topic; offsets stay as they are, and so do
    verdicts on its keys."""
    now = state(spark, root, topic)
    sketches = None
    if set(now.runs) <= set(_runs_in(spark, _sketch_path(root, topic))):
        held = spark.read.schema(SKETCHES).parquet(*[f"{_sketch_path(root, topic)}/run={r}" for r in now.runs])
        merged = held.groupBy("key").agg(F.sum("parsed"), F.hll_union_agg("sketch"))
        sketches = [tuple(r) for r in merged.collect()]  # a row for each key
    partitions = segment_table(spark, root, topic, now.runs).select("partition").distinct().count()
    rows = _place_rows(_read_places(spark, root, topic, now.places), root, topic, now)
    ordered = segments.range_sorted(rows, ["partition", "offset"], ties=[])
    shard = F.shiftleft(F.col("partition").cast("bigint"), 32) + _task()
    numbered = ordered.select("partition", shard.alias("shard"), segments.task_position().alias("pos"), "key", "value")
    _commit(numbered, root, topic, partitions, parts_of_tasks=True)
    if sketches is not None:
        run = max(state(spark, root, topic).runs)
        table = spark.createDataFrame(sketches, SKETCHES).coalesce(1)
        table.write.mode("overwrite").parquet(f"{_sketch_path(root, topic)}/run={run}")


def publish_buckets(
    records: DataFrame, root: str, topic: str, key: str, max_buckets: int, mode: str = "overwrite"
) -> int:
    """A one-partition topic that runs through the key's values in order, without a shuffle.

    Tasks group their rows by bucket. A segment is one bucket of one task, and segments
    are numbered bucket first. Rows of one bucket are in no particular order, which is why
    ``publish_sorted`` is the rule. A key of more than ``max_buckets`` values is an error, and
    so is appending: another publish's buckets would come behind the last one.
    """
    key_column(key)
    if mode == "append":
        raise ValueError("a topic of buckets can only be replaced")
    rank = bucket_rank(records, key, max_buckets)
    grouped = records.withColumn("_bucket", rank).sortWithinPartitions("_bucket")
    shard = F.shiftleft("_bucket", 32) + _task()
    rows = grouped.select(
        F.lit(0).alias("partition"),
        shard.alias("shard"),
        segments.task_position().alias("pos"),
        F.lit(None).cast("string").alias("key"),
        serialize().alias("value"),
    )
    return _commit(rows, root, topic, 1, parts_of_tasks=True)


def _read_places(spark: SparkSession, root: str, topic: str, places: Iterable[tuple[bool, int]]) -> DataFrame:
    """Stored rows of the topic in these runs."""
    out = []
    plain = [f"{data_path(root, topic)}/run={r}" for ordered, r in places if not ordered]
    if plain:
        out.append(spark.read.schema(STORED).option("basePath", data_path(root, topic)).parquet(*plain))
    sorted_ = [f"{root}/{SORTED}/run={r}" for ordered, r in places if ordered]
    if sorted_:
        rows = spark.read.schema(ORDERED).option("basePath", f"{root}/{SORTED}").parquet(*sorted_)
        none = F.lit(None).cast("string").alias("key")
        # the rows of a topic stand together, so files and row groups of others are passed over
        out.append(rows.filter(F.col("topic") == topic).select(F.lit(0).alias("partition"), "shard", "pos", none, "value", "run"))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], STORED)


def read_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """Every row of the topic from the beginning to its present end, with offsets."""
    now = state(spark, root, topic)
    return place_rows(_read_places(spark, root, topic, now.places), root, topic, now)


def place_rows(stored: DataFrame, root: str, topic: str, now: State) -> DataFrame:
    """Stored rows of the topic as rows of the log."""
    return as_log(_place_rows(stored, root, topic, now), topic)


def _place_rows(stored: DataFrame, root: str, topic: str, now: State) -> DataFrame:
    table = segment_table(stored.sparkSession, root, topic, now.runs)
    return segments.place(stored, table, ["run", "partition"], known_rows=now.size)


def read_head(spark: SparkSession, root: str, topic: str, n: int) -> DataFrame:
    """The first n rows of each partition; runs and segments beyond are not read."""
    now = state(spark, root, topic)
    table = segment_table(spark, root, topic, now.runs).filter(F.col("shard") != _BEFORE)
    runs = {r.run for r in table.filter(F.col("start") < n).select("run").distinct().collect()}
    stored = _read_places(spark, root, topic, [p for p in now.places if p[1] in runs])
    return as_log(segments.place_head(stored, table, ["run", "partition"], n), topic)


def as_log(placed: DataFrame, topic: str) -> DataFrame:
    return placed.select(F.lit(topic).alias("topic"), *LOG.fieldNames()[1:])


def read_log(spark: SparkSession, root: str, *topics: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [read_topic(spark, root, t) for t in topics])


def consume(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The non-empty values from the beginning to the present end, in no order."""
    stored = _read_places(spark, root, topic, state(spark, root, topic).places)
    return drop_empty(stored.select("value"))


def stored_end_offsets(spark: SparkSession, root: str, *topics: str) -> DataFrame:
    """Rows of each topic by its segment tables alone; the data is not read."""
    each = [segment_table(spark, root, t).select(F.lit(t).alias("topic"), "rows") for t in topics]
    tables = reduce(DataFrame.unionByName, each)
    return tables.groupBy("topic").agg(F.sum("rows").alias("rows"))


def end_offsets(log: DataFrame) -> DataFrame:
    """Expected rows of each topic from its partitions' first and last offsets."""
    span = (F.max("offset") + 1 - F.min("offset")).alias("span")
    return log.groupBy("topic", "partition").agg(span).groupBy("topic").agg(F.sum("span").alias("expected"))


def topic_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("topic").agg(F.count("*").alias("rows"))


def progress(log: DataFrame, consumed: DataFrame) -> DataFrame:
    """How far a reader has come in each partition, and whether it has reached the end."""
    by = ["topic", "partition"]
    ends = log.groupBy(*by).agg(
        F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset")
    )
    read = consumed.groupBy(*by).agg((F.max("offset") + 1).alias("position"))
    position = F.coalesce("position", "begin_offset")
    return ends.join(read, by, "left").select(
        *by,
        "end_offset",
        position.alias("position"),
        (F.col("end_offset") - position).alias("lag"),
        (position >= F.col("end_offset")).alias("complete"),
    )
