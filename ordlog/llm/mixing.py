"""Mix sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source's documents stand in a queue in shuffled order (by a hash of their id), once,
and all of them a second time behind that. A copy's virtual finish time is the number of
words of its source up to its own end, divided by the source's weight. All copies are
range-sorted by finish time and taken from the front until the budget is spent. So each
source gets words in proportion to its weight until its queue is empty, and what it can't
use goes to the others by their weights.

No step gathers a source in one task. The words before a document are those of the slices
of its source before it, plus those before it in its slice; a source of n documents has
about sqrt(n) slices of about sqrt(n) documents. The cut through the sorted copies is found
in the same way: by shards, then by blocks of one shard, then by rows of one block.

Whether a copy is taken depends on its place in its source's queue alone, so the result of
the sort comes down to one place for each source and pass: the last one taken. Documents
find their fate by comparing with it.

A place is a hash of id and size. Rows alike in id, size and source (null ids are alike) are
numbered, and each further one gets a place of its own, so however many there are, the mix
may take some and leave others. They are numbered where they lie, by tasks, and only they are
written down for it.

Null texts and texts of white space have size 0 and are taken 0 times; a null source is a
source of its own. Very long texts are counted where they lie. Ties in finish time go by
source, pass and place. Other columns stay as they are, whatever their names. An empty table
gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordlog import workspace
from ordlog.llm.shared import BROADCAST_ROWS, stage
from ordlog.operators import segments

WEIGHTS = (3, 1, 2)  # of the sources by code point, repeating
BUDGET = (3, 2)  # of all sizes
PASSES = 2
BLOCK = 4096  # rows of a shard summed at once
SHARD_ROWS = 1_000_000
SEED = "mix-1"


def size_of(text: str) -> Column:
    """Number of runs of anything but ASCII white space; null has none."""
    # each word, with the white space around it, becomes one character
    gone = F.regexp_replace(text, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    spaces_only = F.translate(F.col(text), "\t\n\x0b\x0c\r ", "") == ""
    return F.coalesce(F.when(spaces_only, 0).otherwise(F.length(gone)), F.lit(0)).cast("bigint")


def _place(doc_id: Column, size: Column) -> Column:
    """A document's place in the shuffle of its source."""
    name = F.concat_ws(":", F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"))
    return F.md5(name.cast("binary"))


def _further(place: Column, nth: Column) -> Column:
    """The place of the n-th of rows alike, from 0."""
    return F.when(nth == 0, place).otherwise(F.md5(F.concat_ws(":", place, nth.cast("string")).cast("binary")))


def _weight(rank: Column, weights: tuple[int, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))


def _sources(sized: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """One row for each source: sid (its rank by code point), weight, size and documents."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ranked = segments.positioned(sums, [F.col("source").asc_nulls_last()], ties=[])
    return stage(
        ranked.select(
            F.col("offset").alias("sid"),
            "source",
            "source_size",
            "docs",
            _weight(F.col("offset"), weights).cast("bigint").alias("weight"),
        ),
        "mix-sources",
    )


def _level(sources: DataFrame, budget: tuple[int, int]) -> tuple[int, int, int]:
    """The words to share among sources that don't run dry, doubled by the budget's
    denominator; the weights of these sources; all sizes.

    A source runs dry if its share is at least PASSES times its size. Taking out the dry
    ones raises the shares of the others, until no more run dry."""
    up, down = budget
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share, weights = None, None
    while True:
        # an exact comparison: PASSES * size * down * weights <= weight * share
        dry = F.lit(False)
        if share is not None:
            most = F.col("source_size").cast("decimal(38,0)") * F.lit(PASSES * down * weights).cast("decimal(38,0)")
            dry = most <= F.col("weight").cast("decimal(38,0)") * F.lit(share).cast("decimal(38,0)")
        row = sources.agg(
            F.coalesce(F.sum(F.when(dry, F.col("source_size"))), F.lit(0)).alias("spent"),
            F.coalesce(F.sum(F.when(~dry, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()
        now = up * total - PASSES * down * row.spent, row.weights
        if now == (share, weights) or not row.weights:
            return now[0], now[1], total
        share, weights = now


def _with_targets(sources: DataFrame, budget: tuple[int, int]) -> tuple[DataFrame, int]:
    share, weights, total = _level(sources, budget)
    most = F.col("source_size") * PASSES
    part = (F.col("weight") * F.lit(share).cast("bigint")).cast("double") / F.lit(float(max(1, weights) * budget[1]))
    target = F.least(part, most.cast("double")) if weights else most.cast("double")
    return sources.withColumn("target", target), total


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


_ALIKE = ["source", "place", "size"]


def _numbered(rows: DataFrame, alike: DataFrame, n_alike: int) -> DataFrame:
    """Rows of source, place and size with their own place among rows alike.

    ``alike``: the few (or many) that several rows have. Their rows are numbered by the tasks
    that write them, within each group, so a group of any size is in no one task."""
    if not n_alike:
        return rows
    of = alike.select(*[F.col(c).alias(f"_{c}") for c in _ALIKE])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _ALIKE]
    some = rows.join(_small(of, n_alike), same, "left_semi")
    path = workspace.fresh(rows.sparkSession, "mix-alike")
    data = segments.stage(segments.number(some.sortWithinPartitions(*_ALIKE)), f"{path}/data")
    table = segments.stage_table(segments.starts(data, _ALIKE), f"{path}/segments")
    placed = segments.place(data, table, _ALIKE, missing_groups=True)
    placed = placed.withColumn("place", _further(F.col("place"), F.col("offset"))).drop("offset")
    return rows.join(_small(of, n_alike), same, "left_anti").unionByName(placed.select(*rows.columns))


def _queue(sized: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """Every document of at least a word, PASSES times, with its finish time."""
    of = sources.select("sid", F.col("source").alias("_source"), "weight", "docs", "source_size")
    # rows alike in source, id and size travel as one, and then stand in the queue each
    items = sized.filter("size > 0").groupBy(*_ALIKE).agg(F.count("*").alias("rows"))
    nth = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1))
    each = items.withColumn("nth", nth).withColumn("place", _further(F.col("place"), F.col("nth")))
    queued = each.join(_small(of, n_sources), F.col("source").eqNullSafe(F.col("_source")))
    share = F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)
    sliced = queued.select(
        "sid",
        "weight",
        "source_size",
        "place",
        F.col("size").alias("words"),
        F.floor(share * F.ceil(F.sqrt("docs"))).alias("slice"),
    )
    before = Window.partitionBy("sid").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy("sid", "slice").agg(F.sum("words").alias("in_slice")).select(
        F.col("sid").alias("_sid"),
        F.col("slice").alias("_slice"),
        F.coalesce(F.sum("in_slice").over(before), F.lit(0)).alias("start"),
    )
    inside = Window.partitionBy("sid", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    placed = sliced.join(starts, (F.col("sid") == F.col("_sid")) & (F.col("slice") == F.col("_slice")))
    ended = placed.withColumn("end", F.col("start") + F.sum("words").over(inside))
    copies = ended.withColumn("pass", F.explode(F.array(*map(F.lit, range(PASSES)))))
    reached = (F.col("end") + F.col("source_size") * F.col("pass")).cast("double")
    return copies.select((reached / F.col("weight")).alias("finish"), "sid", "pass", "place", "words")


_ORDER = ["finish", "sid", "pass", "place"]


def _first_beyond(ranged: DataFrame, budget: tuple[int, int], total: int) -> tuple | None:
    """The first copy, in order, that the budget has no room for; None if all are taken.

    Looked for among the shards' sums, then those of one shard's blocks, then in a block."""
    up, down = budget
    spent, part = 0, ranged
    for level in ("shard", "block"):
        running = Window.orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
        sums = part.groupBy(level).agg(F.sum("words").alias("words"))
        reach = sums.withColumn("reach", F.sum("words").over(running) + F.lit(spent))
        beyond = reach.filter(F.col("reach") * down > up * total).orderBy(level).first()
        if beyond is None:
            return None
        spent = beyond["reach"] - beyond["words"]
        part = part.filter(F.col(level) == beyond[level])
    running = Window.orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    rows = part.withColumn("reach", F.sum("words").over(running) + F.lit(spent))
    found = rows.filter(F.col("reach") * down > up * total).orderBy(*_ORDER).first()
    return tuple(found[k] for k in _ORDER)


def _sorted(queue: DataFrame) -> DataFrame:
    queue = stage(queue, "mix-queue")
    rows = queue.count()
    shards = max(-(-rows // SHARD_ROWS), int(queue.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = queue.repartitionByRange(shards, *_ORDER).sortWithinPartitions(*_ORDER)
    block = F.floor(segments.task_position() / BLOCK).alias("block")
    return stage(ranged.select("*", F.spark_partition_id().alias("shard"), block), "mix-sorted")


def _sized(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    """Size and place of each row of the table, under names that can't clash."""
    rows = docs.select(
        F.col(doc_id).alias("id"), F.col(source).alias("source"), size_of(text).alias("size")
    )
    return rows.withColumn("place", _place(F.col("id"), F.col("size")))


def _alike(sized: DataFrame) -> tuple[DataFrame, int]:
    """What several rows have in common, and how many such groups there are."""
    found = sized.filter("size > 0").groupBy(*_ALIKE).agg(F.count("*").alias("rows")).filter("rows > 1")
    found = stage(found.select(*_ALIKE), "mix-groups")
    return found, found.count()


def plan(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    budget: tuple[int, int] = BUDGET,
) -> tuple[DataFrame, DataFrame]:
    """The rows with their size and place, and what the mix takes of each source: its
    weight, size, target, and for each pass the last place taken (null: none)."""
    sized = stage(_sized(docs, doc_id, source, text), "mix-sized")
    sources = _sources(sized, weights)
    n = sources.count()
    aimed, total = _with_targets(sources, budget)
    ranged = _sorted(_queue(sized, sources, n))
    beyond = _first_beyond(ranged, budget, total)
    if beyond is not None:
        key = F.struct(*_ORDER)
        ranged = ranged.filter(key < F.struct(*[F.lit(v).alias(k) for k, v in zip(_ORDER, beyond)]))
    last = ranged.groupBy(F.col("sid").alias("_sid")).agg(
        *[F.max(F.when(F.col("pass") == p, F.col("place"))).alias(f"last_{p}") for p in range(PASSES)]
    )
    mixed = aimed.join(_small(last, n), F.col("sid") == F.col("_sid"), "left")
    return sized, stage(mixed.drop("_sid"), "mix-plan")


def _times(place: Column) -> Column:
    """How often the mix takes a document."""
    passes = [F.coalesce((place <= F.col(f"last_{p}")).cast("int"), F.lit(0)) for p in range(PASSES)]
    return sum(passes[1:], passes[0])


def report(docs: DataFrame, **options) -> DataFrame:
    """For each document: doc_id, size, source_size, target and the words taken of it."""
    sized, mix = plan(docs, **options)
    mix = mix.withColumnRenamed("source", "_source")
    own = _numbered(sized, *_alike(sized))
    rows = own.join(_small(mix, mix.count()), F.col("source").eqNullSafe(F.col("_source")))
    return rows.select(
        F.col("id").alias(options.get("doc_id", "doc_id")),
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.col("size") * _times(F.col("place"))).otherwise(0).alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken (0 to PASSES)."""
    sized, mix = plan(docs, **options)
    mix = mix.select(F.col("source").alias("_source"), *[f"last_{p}" for p in range(PASSES)])
    doc_id, source, text = (options.get(k, k) for k in ("doc_id", "source", "text"))
    # a row travels as one struct, so no name of its columns is in the way; taken from an
    # array, the size is counted once for each row, not wherever it is used
    held = docs.select(
        F.struct("*").alias("row"), F.col(source).alias("source"), F.col(doc_id).alias("id"), F.explode(F.array(size_of(text))).alias("size")
    )
    placed = held.select("row", "source", "size", _place(F.col("id"), F.col("size")).alias("place")).filter("size > 0")
    own = _numbered(placed, *_alike(sized))
    rows = own.join(_small(mix, mix.count()), F.col("source").eqNullSafe(F.col("_source")))
    repeated = rows.select("row", _times(F.col("place")).alias("times")).filter("times > 0")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
