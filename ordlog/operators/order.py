"""Sorted tables and what is read off them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordlog import workspace
from ordlog.functions.codec import key_column
from ordlog.operators import merge, segments
from ordlog.operators.segments import Positioned

CHECKED_ROWS = 1000


def sort_records(records: DataFrame, key: str, shards: int | None = None) -> DataFrame:
    """Records in ascending order of one key, the other fields breaking ties.

    Ids order as numbers, texts by their bytes (upper case before lower, a prefix before
    what it begins).
    """
    key_column(key)
    return segments.positioned(records, [key], shards=shards)


def sort_by(
    df: DataFrame, *order: str | Column, ties: list[str] | None = None, shards: int | None = None
) -> DataFrame:
    """Any order on the row: columns or expressions, asc/desc, nulls first/last."""
    return segments.positioned(df, list(order), ties=ties, shards=shards)


def sorted_table(df: DataFrame, *order: str | Column, ties: list[str] | None = None, shards: int | None = None) -> Positioned:
    """A table sorted and written down, that can be read whole, from its head, or merged."""
    return segments.write_positioned(df, list(order), ties, shards=shards)


def merge_sorted(*tables: DataFrame | Positioned, order: list[str | Column], shards: int | None = None) -> DataFrame:
    """One ordered table from several; their own offsets, if any, are left behind.

    Tables that ``sorted_table`` has sorted by the same names keep their order: only rows of
    shards that overlap with another table's are sorted again. Others are sorted whole."""
    if all(isinstance(t, Positioned) for t in tables) and all(
        t.keys == tables[0].keys and t.keys is not None and t.keys[: len(order)] == order and t.columns == tables[0].columns
        for t in tables
    ):
        return merge.merge(list(tables), shards)
    frames = [t.rows() if isinstance(t, Positioned) else t for t in tables]
    merged = reduce(DataFrame.unionByName, [t.drop("offset") for t in frames])
    return segments.positioned(merged, order, shards=shards)


def first_rows(df: DataFrame, *order: str | Column, n: int = CHECKED_ROWS) -> DataFrame:
    """The first n rows in order; each task keeps n rows, nothing is sorted whole."""
    return df.orderBy(*order).limit(n)


def sorted_head(
    df: DataFrame, *order: str | Column, n: int = CHECKED_ROWS, ties: list[str] | None = None
) -> DataFrame:
    """The first n rows with their places. Each task keeps n rows; only these are sorted
    together and numbered, so n is what one task can hold."""
    segments.refuse(df, "offset")
    keys = segments.total_order(df, list(order), ties)
    place = F.row_number().over(Window.orderBy(*keys)) - 1
    return df.orderBy(*keys).limit(n).withColumn("offset", place.cast("bigint"))


def bucket_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("rows"))


class TooManyBuckets(ValueError):
    """The key has more values than the caller said."""


def bucket_rank(df: DataFrame, key: str, max_buckets: int) -> Column:
    """Each row's place among the key's values, of which there are ``max_buckets`` at most.

    A value that was not among them when they were counted fails the job."""
    counts = bucket_counts(df, key).orderBy(F.col(key).asc_nulls_first()).limit(max_buckets + 1)
    keys = [r[0] for r in counts.collect()]  # at most one more than max_buckets
    if len(keys) > max_buckets:
        raise TooManyBuckets(f"{key} has more than {max_buckets} values; sort by it instead")
    unknown = F.raise_error(F.concat(F.lit(f"a value of {key} that was not counted: "), F.col(key).cast("string")))
    known = [(k, i) for i, k in enumerate(keys) if k is not None]
    places = F.create_map(*[F.lit(x) for pair in known for x in pair]) if known else F.lit(None).cast("map<string,int>")
    place = F.try_element_at(places, F.col(key).cast(df.schema[key].dataType if known else "string"))
    rank = F.when(F.col(key).isNull(), 0).otherwise(F.coalesce(place, unknown.cast("int"))).cast("bigint")
    return rank


def bucketed(df: DataFrame, key: str, shards: int | None = None) -> DataFrame:
    """Order by a key and give each row its bucket: ``bucket`` (the key's rank),
    ``bucket_first``, ``bucket_last`` and ``offset``. All columns break ties, so the order is
    the same for any key, split and number of shards."""
    segments.refuse(df, "bucket", "bucket_first", "bucket_last", "offset", "shard", "pos")
    ordered = segments.positioned(df, [key], shards=shards)
    edges = ordered.groupBy(key).agg(
        F.min("offset").alias("bucket_first"), F.max("offset").alias("bucket_last")
    )
    ranked = segments.positioned(edges, [key]).withColumnRenamed("offset", "bucket")
    ranked = ranked.withColumnRenamed(key, "_key")
    return ordered.join(ranked, F.col(key).eqNullSafe(F.col("_key"))).select(
        *df.columns, "bucket", "bucket_first", "bucket_last", "offset"
    )


def grouped_buckets(df: DataFrame, key: str, max_buckets: int) -> DataFrame:
    """The buckets of a key with few values strung together in key order, without a shuffle.

    The same columns as ``bucketed``, but rows of one bucket are in no particular order:
    each task groups its own rows and writes them to that bucket's folder. Raises
    ``TooManyBuckets`` if the key has more than ``max_buckets`` values."""
    segments.refuse(df, "bucket", "bucket_first", "bucket_last", "offset", "shard", "pos")
    rank = bucket_rank(df, key, max_buckets)
    path = workspace.fresh(df.sparkSession, "buckets")
    grouped = segments.number(df.withColumn("bucket", rank).sortWithinPartitions("bucket"))
    data = segments.stage(grouped, f"{path}/data", partition_by=["bucket"])
    parts = segments.starts(data, ["bucket"])
    table = segments.stage_table(parts, f"{path}/segments")
    sizes = table.groupBy("bucket").agg(F.sum("rows").alias("rows"))
    # one row for each of the few buckets
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = sizes.select(
        "bucket",
        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("bucket_first"),
        F.col("rows").alias("_rows"),
    )
    placed = segments.place(data, table, ["bucket"]).join(F.broadcast(edges), "bucket")
    return placed.select(
        *df.columns,
        "bucket",
        "bucket_first",
        (F.col("bucket_first") + F.col("_rows") - 1).alias("bucket_last"),
        (F.col("bucket_first") + F.col("offset")).alias("offset"),
    )
