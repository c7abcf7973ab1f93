import os
import re

import pytest
from pyspark.sql import functions as F

from ordlog import workspace
from ordlog.functions import codec
from ordlog.operators import compare, order
from ordlog.plans import catalog, end_to_end, oracle
from ordlog.schema import KEYS
from ordlog.sources import kafka, log, synth
from ordlog.sources.logs import FileLogs, KafkaLogs


def test_whole_job_on_generated_records(spark, root):
    done = end_to_end.run(spark, count=4000, root=root)
    summary = {r.stage: (r["rows"], r.lost, r.matches_source) for r in done.summary.collect()}
    assert summary == {s: (4000, 0, True) for s in ("generated", "source", "consumed", *KEYS)}
    report = done.report.collect()
    assert {r.topic for r in report} == set(KEYS)
    assert all(r.verdict == "PASS" and r.same_rows and r["rows"] == 4000 for r in report)
    assert done.malformed == 0


def test_same_seed_same_logs(spark, tmp_path):
    rows = []
    for d in ("a", "b"):
        r = end_to_end.run(spark, count=300, seed=7, root=str(tmp_path / d)).root
        rows.append(sorted(map(tuple, log.read_log(spark, r, "id", "name").collect()), key=str))
    assert rows[0] == rows[1]


def test_same_logs_for_any_number_of_shuffle_partitions(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in ("1", "3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        done = end_to_end.run(spark, count=400, root=str(tmp_path / n))
        rows = log.read_log(spark, done.root, "id", "name").collect()
        seen.append((sorted(map(tuple, rows), key=str), sorted(map(tuple, done.report.collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]


def test_a_second_run_replaces_the_first(spark, root):
    end_to_end.run(spark, count=50, root=root)
    end_to_end.run(spark, count=20, root=root)
    assert log.read_log(spark, root, "source", *KEYS).count() == 80


def test_no_records(spark, root):
    done = end_to_end.run(spark, count=0, root=root)
    assert all(r["rows"] == 0 and r.matches_source for r in done.summary.collect())
    assert done.report.count() == 0


def test_malformed_lines_are_set_aside_and_nothing_is_doubled(spark, root, record_df):
    """Bad lines at the head of the input; their neighbours must come out exactly once."""
    records = record_df([(None, "bad", "a", "x"), (None, "bad2", "a", "x")]).union(synth.records(spark, 100).drop("row_id"))
    done = end_to_end.run(spark, records, root=root)
    assert done.malformed == 2
    assert spark.read.parquet(f"{root}/quarantine").filter("reason = 'bad_id'").count() == 2
    assert {r.stage: r["rows"] for r in done.summary.collect()} == {
        "generated": 102, "source": 102, "consumed": 102, "id": 100, "name": 100, "continent": 100,
    }
    assert all(r.verdict == "PASS" for r in done.report.collect())


def test_verdicts_fail_when_they_should(spark, root):
    records = synth.records(spark, 500).drop("row_id")
    end_to_end.sort_topics(records, FileLogs(spark, root))
    topic = log.read_topic(spark, root, "id")

    def verdict(topic, expected=None):
        wanted = compare.fingerprint(codec.to_lines(expected), "value").first().asDict() if expected is not None else None
        return end_to_end.verify_topics({"id": topic}, wanted).collect()

    assert verdict(topic, records)[0].verdict == "PASS"
    swapped = topic.withColumn("offset", F.when(F.col("offset") == 9, 10).when(F.col("offset") == 10, 9).otherwise(F.col("offset")))
    assert verdict(swapped)[0].verdict == "FAIL"
    assert verdict(topic.filter("offset <> 250"))[0].verdict == "FAIL"
    assert verdict(topic, records.filter("id % 2 = 0"))[0].verdict == "FAIL"
    late = topic.withColumn("offset", F.when(F.col("offset") == 0, 500).otherwise(F.col("offset")))
    assert verdict(late)[0].violations == 1


def test_what_a_run_stages_goes_and_quarantine_is_its_own(spark, root, record_df):
    bad = record_df([(None, "bad", "a", "x")]).union(synth.records(spark, 50).drop("row_id"))
    end_to_end.run(spark, bad, root=root)
    assert spark.read.parquet(f"{root}/quarantine").count() == 1
    end_to_end.run(spark, count=100, root=root)
    assert spark.read.parquet(f"{root}/quarantine").count() == 0
    assert not [p for p in os.listdir(root) if p.startswith("consumed")]


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)
    assert not [q for q in catalog.QUERIES if q == "pipeline" or re.match(r"op\d+_", q)]


def test_work_folder_is_the_clusters(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert workspace.fresh(spark, "x").startswith(shared)
    assert workspace.fresh(spark, "x") != workspace.fresh(spark, "x")


def test_staged_tables_can_be_dropped(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "base", lambda _: str(tmp_path))
    (tmp_path / "other").mkdir()
    df = order.sort_records(synth.records(spark, 20).drop("row_id"), "id")
    assert df.count() == 20 and list((tmp_path / "ordlog").iterdir())
    workspace.drop_staged(spark)
    assert not list((tmp_path / "ordlog").iterdir()) and (tmp_path / "other").exists()


class _Cluster:
    """A session of which only the settings are asked."""

    def __init__(self, master, shared, given=None):
        self.conf = {"spark.checkpoint.dir": shared}
        self.sparkContext = type("C", (), {"master": master, "applicationId": "app", "getCheckpointDir": staticmethod(lambda: given)})


def test_no_local_folder_on_a_cluster():
    assert workspace.base(_Cluster("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.base(_Cluster("yarn", None))
    assert workspace.base(_Cluster("yarn", None, "hdfs://x/set/0f3a")) == "hdfs://x/set"
    assert workspace.base(_Cluster("local[2]", None))


def test_lines_of_any_text_survive_the_log(spark, root, line_df):
    lines = line_df(["1,a\nb,c,d", "2,é,漢字,𝒳", "3,,,x" + "y" * 100_000])
    log.publish(lines, root, "t", 2)
    assert sorted(r.id for r in codec.parse(log.consume(spark, root, "t")).collect()) == [1, 2, 3]
    assert sorted(r.value for r in log.consume(spark, root, "t").collect()) == sorted(r.value for r in lines.collect())


def test_whole_job_on_a_broker(spark, root, tmp_path, monkeypatch):
    """Kafka itself is not here: a stand-in that keeps topics as files takes its place."""
    from tests.broker import Broker

    monkeypatch.setattr(kafka, "FORMAT", "broker")
    spark.dataSource.register(Broker)

    class Logs(KafkaLogs):
        def publish_ordered(self, *args):
            # a source written in Python is only found by threads that have an active session
            spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)
            return super().publish_ordered(*args)

    logs = Logs(spark, str(tmp_path / "broker"), ordered_partitions=4)
    done = end_to_end.run(spark, count=3000, root=root, logs=logs)
    assert {r["rows"] for r in done.summary.collect()} == {3000}
    report = done.report.collect()
    assert {r.topic for r in report} == set(KEYS)
    assert all(r.verdict == "PASS" and r.same_rows and r.partitions == 4 for r in report)
    ordered = sorted(logs.read("id").collect(), key=lambda r: (r.partition, r.offset))
    ids = [int(r.value.split(",")[0]) for r in ordered]
    assert ids == sorted(ids)


def test_partitions_of_a_topic_must_follow_one_another(spark):
    rows = [(0, 0, "1,a,b,c"), (0, 1, "5,a,b,c"), (1, 0, "4,a,b,c"), (1, 1, "9,a,b,c")]
    topic = spark.createDataFrame(rows, "partition int, offset bigint, value string")
    report = end_to_end.verify_topics({"id": topic}).first()
    assert (report.partitions, report["rows"], report.violations, report.verdict) == (2, 4, 1, "FAIL")
    good = topic.filter("not (partition = 1 and offset = 0)")
    report = end_to_end.verify_topics({"id": good}).first()
    assert (report.partitions, report["rows"], report.violations, report.verdict) == (2, 3, 0, "PASS")


def test_a_file_of_lines_is_sorted_and_checked_from_the_shell(spark, root, tmp_path, capsys):
    from ordlog.__main__ import main

    (tmp_path / "in.txt").write_text("7,b,x,Asia\nbad\n-2,c,y,Europe\n7,a,z,Asia\n")
    main(["--lines", str(tmp_path / "in.txt"), "--root", root])
    shown = capsys.readouterr().out
    assert shown.count("PASS") == 3 and "FAIL" not in shown
    assert [r.value for r in log.read_topic(spark, root, "id").orderBy("offset").collect()] == [
        "-2,c,y,Europe",
        "7,a,z,Asia",
        "7,b,x,Asia",
    ]
    assert spark.read.parquet(f"{root}/quarantine").first().value == "bad"
    main(["--verify", "--root", root])
    assert capsys.readouterr().out.count("PASS") == 3
    log.publish(log.read_topic(spark, root, "id").orderBy(F.desc("offset")).coalesce(1), root, "id", 1)
    main(["--verify", "--root", root])
    assert "FAIL" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["--verify"])


def test_keys_that_outgrow_an_id_are_set_aside(spark, tmp_path):
    from ordlog.sources import tables

    folder = "/root/testdata/sf0.001"
    big = spark.read.parquet(f"{folder}/supplier.parquet").withColumn("s_suppkey", F.col("s_suppkey") + 2**31 - 5)
    big.write.parquet(str(tmp_path / "supplier.parquet"))
    for t in ("nation", "region"):
        spark.read.parquet(f"{folder}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    records = tables.supplier_records(spark, str(tmp_path))
    fit = big.filter(f"s_suppkey < {2**31}").count()
    assert 0 < fit < records.count() == big.count()
    done = end_to_end.run(spark, records, root=str(tmp_path / "root"))
    assert done.malformed == big.count() - fit
    assert {r["rows"] for r in done.summary.filter("step > 2").collect()} == {fit}
