"""What must hold of the plans for them to work at scale."""

import re

import pytest
from pyspark.sql import functions as F

from ordlog.functions import codec, rules
from ordlog.operators import compare, order, order_check, probe, segments
from ordlog.schema import CONTINENTS
from ordlog.sources import log, synth, tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (\w+)", plan(df).replace("BroadcastExchange ", ""))


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    log.publish(codec.to_lines(synth.records(spark, 1000, tasks=4)), root, "source")
    return root


def test_generating_needs_no_shuffle_and_no_python(spark):
    made = codec.to_lines(synth.records(spark, 100))
    assert exchanges(made) == [] and "Python" not in plan(made)


def test_consuming_reads_one_column_and_does_not_join(spark, topic):
    values = log.consume(spark, topic, "source")
    assert "ReadSchema: struct<value:string>" in plan(values)
    assert "Join" not in plan(values) and exchanges(values) == []
    assert "PushedFilters: [IsNotNull(value)" in plan(values)


def test_parsing_stays_in_the_jvm(spark, topic):
    parsed = codec.parse(log.consume(spark, topic, "source"))
    assert exchanges(parsed) == [] and "Python" not in plan(parsed) and "Arrow" not in plan(parsed)


def test_a_sort_is_one_range_shuffle(spark):
    records = synth.records(spark, 1000).drop("row_id")
    assert exchanges(segments.number(segments.range_sorted(records, ["name"]))) == ["rangepartitioning"]


@pytest.mark.parametrize("limit, join", [(2_000_000, "BroadcastHashJoin"), (11, "SortMergeJoin")])
def test_segments_are_broadcast_up_to_a_size(spark, topic, monkeypatch, limit, join):
    """The topic has twelve segments: four tasks, three partitions."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(segments, "BROADCAST_SEGMENTS", limit)
    try:
        read = log.read_topic(spark, topic, "source")
        assert join in plan(read)
        report = order_check.order_report(read, F.col("offset")).collect()
        assert len(report) == 3 and all(r.gapless for r in report) and sum(r["rows"] for r in report) == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_the_log_is_compared_where_it_lies(spark, topic):
    report = order_check.order_report(log.read_topic(spark, topic, "source"), F.col("offset"))
    below = plan(report).split("MapInArrow")[1]
    assert not re.search(r"(?<!Broadcast)Exchange", below)
    assert len(exchanges(report)) == 3


def test_one_scan_serves_all_rules(spark, topic):
    report = rules.rule_report(log.consume(spark, topic, "source"))
    assert plan(report).count("FileScan") == 1 and exchanges(report) == ["SinglePartition"]


def test_fingerprints_and_sketches_shuffle_one_row_a_task(spark, topic):
    values = log.consume(spark, topic, "source")
    assert exchanges(compare.fingerprint(values)) == ["SinglePartition"]
    assert exchanges(probe.cardinality_approx(values, ["value"])) == ["SinglePartition"]


def test_heads_and_probes_do_not_sort_the_table(spark):
    records = synth.records(spark, 100).drop("row_id")
    head = order.sorted_head(records, "name", n=5)
    assert "TakeOrderedAndProject" in plan(head) and "rangepartitioning" not in plan(head)
    assert "rangepartitioning" not in plan(probe.cardinality_probe(records, ["id", "name"]))


def test_first_rows_are_kept_by_each_task(spark):
    first = order.first_rows(synth.records(spark, 100), "name", n=5)
    assert "TakeOrderedAndProject" in plan(first) and exchanges(first) == []


def test_scans_read_the_columns_they_need(spark):
    counts = order.bucket_counts(tables.table(spark, FOLDER, "orders"), "o_orderpriority")
    assert "ReadSchema: struct<o_orderpriority:string>" in plan(counts)


@pytest.mark.parametrize(
    "publish",
    [
        lambda *a: log.publish_sorted(*a, shards=16),
        lambda *a: log.publish_buckets(*a, max_buckets=len(CONTINENTS)),
    ],
)
def test_a_hot_key_is_spread_over_segments(spark, tmp_path, publish):
    """Half of the rows share one continent, a third are one and the same row."""
    some = synth.records(spark, 6000, tasks=8).drop("row_id")
    hot = spark.range(0, 6000, 1, 8).selectExpr("7 id", "'same' name", "'row' address", "'Asia' continent")
    data = some.union(some).union(hot)
    assert publish(data, str(tmp_path), "continent", "continent") == 18_000
    sizes = [r["rows"] for r in log.segment_table(spark, str(tmp_path), "continent").filter("shard >= 0").collect()]
    assert len(sizes) >= 16 and max(sizes) < 4 * 18_000 / 16
