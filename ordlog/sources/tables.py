"""Parquet tables of a folder, shaped into records, lines and logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordlog.functions import codec
from ordlog.operators import segments


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _int_id(column: str) -> Column:
    """The key as an id; null where it outgrows an int32. Lines of such records have no id
    and go to quarantine, where they are counted; no two records come to share an id."""
    return F.col(column).try_cast("int").alias("id")


def _located(spark: SparkSession, folder: str, who: str, nation_key: str) -> DataFrame:
    """A table with its rows' nations and regions."""
    # both are tiny by their files' size, which is what Spark goes by
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, folder, who).join(nations, F.col(nation_key) == F.col("n_nationkey"))


def records(spark: SparkSession, folder: str) -> DataFrame:
    return _located(spark, folder, "customer", "c_nationkey").select(
        _int_id("c_custkey"),
        F.col("c_name").alias("name"),
        F.concat_ws(" ", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("address"),
        F.col("r_name").alias("continent"),
    )


def supplier_records(spark: SparkSession, folder: str) -> DataFrame:
    return _located(spark, folder, "supplier", "s_nationkey").select(
        _int_id("s_suppkey"),
        F.col("s_name").alias("name"),
        F.concat_ws(" ", F.col("s_nationkey").cast("string"), "n_name").alias("address"),
        F.col("r_name").alias("continent"),
    )


def order_records(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    places = _located(spark, folder, "customer", "c_nationkey").select("c_custkey", "r_name")
    return orders.join(places, F.col("o_custkey") == F.col("c_custkey")).select(
        _int_id("o_orderkey"),
        F.concat(F.lit("Order#"), F.col("o_custkey").cast("string")).alias("name"),
        F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("address"),
        F.col("r_name").alias("continent"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Valid lines and every kind of malformed one, from six tables."""
    t = lambda name: table(spark, folder, name)
    parts = [
        codec.to_lines(records(spark, folder)),
        t("documents").selectExpr("concat(doc_id, ',', lang, ',', source, ',', text) value"),
        t("nation").selectExpr("concat('+00', n_nationkey, ',', n_name, ',,') value"),
        t("labels").selectExpr("concat(doc_id, ',', quality, ',', toxic) value"),
        t("region").selectExpr("concat('x', r_regionkey, ',', r_name, ',a,b') value"),
        t("supplier").selectExpr("concat(2147483648 + s_suppkey, ',', s_name, ',a,b') value"),
        t("nation").selectExpr("concat(' ', n_nationkey, ',', n_name, ',a,b ') value"),
        t("region").selectExpr("'' value"),
    ]
    return reduce(DataFrame.unionByName, parts)


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a log of three partitions in id order; ``amount`` is the event's value."""
    events = table(spark, folder, "events").select(
        F.pmod("user_id", F.lit(3)).cast("int").alias("partition"),
        "event_id",
        F.concat_ws(",", F.col("event_id").cast("string"), "event_type", "props").alias("line"),
        F.col("value").alias("amount"),
    )
    placed = segments.positioned(events, ["event_id"], ties=[], within=["partition"])
    return placed.select(
        F.lit("events").alias("topic"),
        "partition",
        "offset",
        F.lit(None).cast("string").alias("key"),
        F.col("line").alias("value"),
        "amount",
    )
