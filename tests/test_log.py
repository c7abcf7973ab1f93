import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ordlog.functions import codec
from ordlog.operators import order_check
from ordlog.schema import CONTINENTS, LOG
from ordlog.sources import kafka, lines, log, synth
from ordlog.streaming import consume


def _values(df):
    return sorted(r.value for r in df.collect())


def by_buckets(records, root, topic, key):
    return log.publish_buckets(records, root, topic, key, max_buckets=3000)


def test_publish_and_consume(spark, root, line_df):
    sent = ["b", " a\t", "", "__END__", "  ", "x,y", "b"]
    assert log.publish(line_df(sent).repartition(3), root, "source", 3) == 7
    assert _values(log.consume(spark, root, "source")) == ["__END__", "a", "b", "b", "x,y"]
    stored = log.read_log(spark, root, "source")
    assert stored.columns == LOG.fieldNames()
    assert stored.count() == 7 and {r.key for r in stored.collect()} == {None}


@pytest.mark.parametrize("partitions", [1, 3, 5])
def test_rows_are_spread_evenly_with_gapless_offsets(spark, root, partitions):
    data = spark.range(0, 1000, 1, 4).selectExpr("cast(id as string) value")
    log.publish(data, root, "t", partitions)
    report = order_check.order_report(log.read_log(spark, root, "t"), F.col("offset")).collect()
    assert len(report) == partitions and all(r.gapless and r.violations == 0 for r in report)
    assert max(r["rows"] for r in report) - min(r["rows"] for r in report) <= 4


@pytest.mark.parametrize("replacing", ["static", "dynamic"])
def test_append_goes_on_and_overwrite_starts_anew(spark, root, line_df, replacing):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", replacing)
    log.publish(line_df(["a", "b", "c"]).coalesce(1), root, "t", 2)
    log.publish(line_df(["d", "e"]).coalesce(1), root, "t", mode="append")
    rows = {(r.partition, r.offset, r.value) for r in log.read_log(spark, root, "t").collect()}
    assert rows == {(0, 0, "a"), (1, 0, "b"), (0, 1, "c"), (0, 2, "d"), (1, 1, "e")}
    assert log.stored_end_offsets(spark, root, "t").first()["rows"] == 5
    log.publish(line_df(["z"]), root, "t", 1)
    assert [(r.partition, r.offset, r.value) for r in log.read_log(spark, root, "t").collect()] == [(0, 0, "z")]
    assert [r.value for r in spark.read.parquet(log.data_path(root, "t")).collect()] == ["z"]
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_heads_of_topics(spark, root):
    data = spark.range(0, 100, 1, 4).selectExpr("cast(id as string) value")
    log.publish(data, root, "t", 3)
    log.publish(data, root, "t", mode="append")
    head = sorted((r.partition, r.offset) for r in log.read_head(spark, root, "t", 40).collect())
    assert head == [(p, o) for p in range(3) for o in range(40)]
    whole = {(r.partition, r.offset, r.value) for r in log.read_log(spark, root, "t").collect()}
    assert {(r.partition, r.offset, r.value) for r in log.read_head(spark, root, "t", 40).collect()} <= whole
    for publish in (log.publish_sorted, by_buckets):
        publish(synth.records(spark, 300, tasks=3), root, "continent", "continent")
        head = log.read_head(spark, root, "continent", 5).collect()
        assert sorted(r.offset for r in head) == list(range(5))
        assert {r.value.rsplit(",", 1)[1] for r in head} == {"Africa"}


def test_a_read_ends_where_the_log_ended_when_it_was_asked_for(spark, root, line_df):
    log.publish(line_df(["a"]), root, "t", 1)
    before, values = log.read_log(spark, root, "t"), log.consume(spark, root, "t")
    log.publish(line_df(["b"]), root, "t", mode="append")
    after = log.read_log(spark, root, "t")
    both = before.withColumn("at", F.lit("before")).unionByName(after.withColumn("at", F.lit("after")))
    assert sorted((r["at"], r.value) for r in both.collect()) == [("after", "a"), ("after", "b"), ("before", "a")]
    assert _values(values) == ["a"]


def _torn_publish(spark, root, value):
    """What a job leaves that died before recording its segments."""
    rows = spark.read.parquet(log.data_path(root, "t")).limit(1).withColumn("value", F.lit(value)).drop("run")
    rows.write.parquet(f"{log.data_path(root, 't')}/run=17")


def test_a_publish_without_segments_is_not_read(spark, root, line_df):
    log.publish(line_df(["a"]), root, "t", 1)
    _torn_publish(spark, root, "torn")
    assert _values(log.consume(spark, root, "t")) == ["a"]
    assert _values(log.read_log(spark, root, "t")) == ["a"]
    log.publish(line_df(["b"]), root, "t", mode="append")
    assert _values(log.read_log(spark, root, "t")) == ["a", "b"]


def test_a_publish_without_segments_has_no_part_in_what_a_stream_consumed(spark, root, line_df):
    log.publish(line_df(["a"]), root, "t", 1)
    _torn_publish(spark, root, "torn")
    assert consume.consume_new(spark, root, "t", "g") == 2
    log.publish(line_df(["b"]), root, "t", mode="append")
    assert consume.consume_new(spark, root, "t", "g") == 1
    got = sorted((r.offset, r.value) for r in consume.consumed(spark, root, "t", "g").collect())
    assert got == [(0, "a"), (1, "b")]


def test_partitions_stay_even_over_many_small_tasks(spark, root):
    log.publish(spark.range(0, 60, 1, 60).selectExpr("cast(id as string) value"), root, "t", 3)
    sizes = [r["count"] for r in log.read_log(spark, root, "t").groupBy("partition").count().collect()]
    assert sizes == [20, 20, 20]


def test_empty_topics(spark, root, line_df):
    log.create_log(spark, root, "t", 3)
    assert log.read_log(spark, root, "t").count() == 0 and log.consume(spark, root, "t").count() == 0
    assert log.stored_end_offsets(spark, root, "t").first()["rows"] == 0
    assert log.publish(line_df([]), root, "t", mode="append") == 0
    assert log.publish(line_df(["a"]), root, "t", mode="append") == 1
    assert _values(log.read_log(spark, root, "t")) == ["a"]


@pytest.mark.parametrize("topic", ["", "a b", "a/b", "..", "é", "x" * 250])
def test_illegal_topic_names(spark, root, topic):
    with pytest.raises(ValueError, match="illegal topic"):
        log.create_log(spark, root, topic)


@pytest.mark.parametrize("publish", [log.publish_sorted, by_buckets])
@pytest.mark.parametrize("key", ["continent", "id"])
def test_ordered_topics(spark, root, publish, key):
    records = synth.records(spark, 3000, tasks=6)
    assert publish(records, root, key, key) == 3000
    out = sorted(log.read_log(spark, root, key).collect(), key=lambda r: r.offset)
    assert [r.offset for r in out] == list(range(3000))
    assert {r.partition for r in out} == {0}
    at = ["id", "name", "address", "continent"].index(key)
    keys = [r.value.split(",")[at] for r in out]
    assert keys == sorted(keys, key=int if key == "id" else str)
    assert sorted(r.value for r in out) == _values(codec.to_lines(records))


def ordered_lines(spark, root, topic):
    rows = sorted(log.read_topic(spark, root, topic).collect(), key=lambda r: r.offset)
    assert [r.offset for r in rows] == list(range(len(rows)))
    return [r.value for r in rows]


ODD = [(None, "n", "a", "x"), (5, "", "", ""), (-7, "é", "z" * 300, "Asia"), (5, "", "", ""), (2147483647, "Zz", "b", "Africa")]


@pytest.mark.parametrize("key", ["id", "name", "continent"])
def test_appends_to_an_ordered_topic_come_to_their_places(spark, root, record_df, key):
    parts = [synth.records(spark, n, seed=n, tasks=3).drop("row_id") for n in (900, 40, 300)]
    parts[1] = parts[1].union(record_df(ODD))
    assert log.publish_sorted(parts[0], root, "t", key, shards=6) == 900
    assert log.publish_sorted(parts[1], root, "t", key, mode="append") == 45
    assert log.publish_sorted(parts[2], root, "t", key, mode="append", shards=4) == 300
    assert log.publish_sorted(parts[2].limit(0), root, "t", key, mode="append") == 0
    every = parts[0].union(parts[1]).union(parts[2])
    log.publish_sorted(every, root, "once", key, shards=3)
    assert ordered_lines(spark, root, "t") == ordered_lines(spark, root, "once")
    assert log.stored_end_offsets(spark, root, "t").first()["rows"] == 1245
    head = sorted((r.offset, r.value) for r in log.read_head(spark, root, "t", 7).collect())
    assert head == list(enumerate(ordered_lines(spark, root, "once")[:7]))


def test_an_append_writes_only_the_segments_it_falls_into(spark, root, record_df):
    log.publish_sorted(spark.range(0, 8000, 1, 4).selectExpr("cast(id * 10 as int) id", "'n' name", "'a' address", "'x' continent"), root, "t", "id", shards=8)
    first = log.state(spark, root, "t")
    assert log.publish_sorted(record_df([(12345, "new", "b", "y"), (12345, "more", "b", "y")]), root, "t", "id", mode="append") == 2
    after = log.segment_table(spark, root, "t").filter("shard >= 0").collect()
    old, new = [r for r in after if r.run == first.places[0][1]], [r for r in after if r.run != first.places[0][1]]
    assert len(old) == 7 and sum(r["rows"] for r in new) < 1400
    ids = [int(v.split(",")[0]) for v in ordered_lines(spark, root, "t")]
    assert ids == sorted(ids) and len(ids) == 8002
    # and again, at both ends and within what was written anew
    log.publish_sorted(record_df([(-1, "a", "b", "c"), (12345, "new", "b", "y"), (10**6, "z", "b", "c")]), root, "t", "id", mode="append")
    ids = [int(v.split(",")[0]) for v in ordered_lines(spark, root, "t")]
    assert ids == sorted(ids) and len(ids) == 8005 and ids[0] == -1


def test_what_can_not_be_appended_to(spark, root, line_df, record_df):
    rows = record_df([(i, f"n{9 - i}", "a", "x") for i in range(9)])
    log.publish(line_df(["a"]), root, "lines", 1)
    with pytest.raises(ValueError, match="not an ordered topic"):
        log.publish_sorted(rows, root, "lines", "id", mode="append")
    log.publish_sorted(rows.repartition(3), root, "t", "id", shards=3)
    with pytest.raises(ValueError, match="not in the order"):
        log.publish_sorted(rows, root, "t", "name", mode="append")
    with pytest.raises(ValueError, match="only be replaced"):
        log.publish_buckets(rows, root, "t", "name", 20, mode="append")
    log.create_log(spark, root, "empty")
    assert log.publish_sorted(rows, root, "empty", "name", mode="append") == 9


def test_orders_come_from_one_job_and_replace_each_other(spark, root, record_df):
    records = synth.records(spark, 700, tasks=3).drop("row_id").union(record_df(ODD))
    keys = {"by_id": "id", "by_name": "name", "continent": "continent"}
    assert log.publish_orders(records, root, keys, shards=4) == dict.fromkeys(keys, 705)
    for topic, key in keys.items():
        log.publish_sorted(records, f"{root}/alone", topic, key)
        assert ordered_lines(spark, root, topic) == ordered_lines(spark, f"{root}/alone", topic)
    old = log.state(spark, root, "by_id").places
    assert log.publish_orders(records.limit(3), root, {"by_id": "id"}) == {"by_id": 3}
    assert len(ordered_lines(spark, root, "by_id")) == 3 and len(ordered_lines(spark, root, "by_name")) == 705
    assert log.publish_orders(records.limit(0), root, {"by_name": "name", "continent": "continent"}) == {"by_name": 0, "continent": 0}
    assert ordered_lines(spark, root, "by_name") == [] and old not in (log.state(spark, root, t).places for t in keys)
    runs = spark.read.schema(log.ORDERED).parquet(f"{root}/ordered").select("run").distinct().count()
    assert runs == 1  # what no topic reads any more is gone


def test_several_orders_are_one_job_of_one_exchange_each(spark, root, monkeypatch):
    plans = []
    real = log.segments.range_sorted
    monkeypatch.setattr(log.segments, "range_sorted", lambda *a, **k: plans.append(real(*a, **k)) or plans[-1])
    log.publish_orders(synth.records(spark, 200), root, {k: k for k in ("id", "name", "continent")})
    assert [p._jdf.queryExecution().executedPlan().toString().count("Exchange") for p in plans] == [1, 1, 1]
    assert len(log._runs_in(spark, f"{root}/ordered")) == 1


def test_verdicts_of_a_growing_topic_read_sketches_only(spark, root, line_df, monkeypatch):
    some = lambda first, n: line_df([f"{i},n{i % 9},a,c{i % (3 + first)}" for i in range(first, first + n)] + ["bad", "x,a,b,c"])
    log.publish(some(0, 50), root, "t", 2, sketched=["id", "name", "continent"])
    found = lambda: {r.key: (r.sampled, r.distinct_keys, r.verdict) for r in log.cardinality(spark, root, "t").collect()}
    assert found() == {"id": (50, 50, "HIGH"), "name": (50, 9, "LOW"), "continent": (50, 3, "LOW")}
    log.publish(some(10, 50), root, "t", mode="append", sketched=["id", "name", "continent"])
    real = log._read_places
    monkeypatch.setattr(log, "_read_places", lambda *a: pytest.fail("the data was read"))
    assert found() == {"id": (100, 60, "HIGH"), "name": (100, 9, "LOW"), "continent": (100, 13, "HIGH")}
    monkeypatch.setattr(log, "_read_places", real)
    before = found()
    log.compact(spark, root, "t")
    assert found() == before and len(log.recorded_runs(spark, root, "t")) == 1
    log.publish(some(0, 5), root, "t", 1, sketched=["name"])  # replaces the topic
    assert found() == {"name": (5, 5, "LOW")}
    log.publish(some(0, 5), root, "t", mode="append")
    with pytest.raises(ValueError, match="without sketches"):
        log.cardinality(spark, root, "t")


def test_compaction_keeps_offsets(spark, root, line_df):
    log.publish(line_df([f"a{i}" for i in range(20)]).repartition(3), root, "t", 3)
    for k in range(3):
        log.publish(line_df([f"b{k}{i}" for i in range(k)]), root, "t", mode="append")
    before = sorted(map(tuple, log.read_topic(spark, root, "t").collect()), key=str)
    log.compact(spark, root, "t")
    assert sorted(map(tuple, log.read_topic(spark, root, "t").collect()), key=str) == before
    assert len(log.recorded_runs(spark, root, "t")) == 1
    log.publish(line_df(["c"]), root, "t", mode="append")
    assert log.read_topic(spark, root, "t").count() == len(before) + 1


def test_bucket_topic_has_each_bucket_in_many_segments(spark, root):
    by_buckets(synth.records(spark, 600, tasks=5), root, "continent", "continent")
    table = log.segment_table(spark, root, "continent").filter("shard >= 0")
    assert table.count() == 5 * len(CONTINENTS)


def test_end_offsets_and_counts(spark):
    rows = [("a", 0, 5), ("a", 0, 6), ("a", 1, 0), ("b", 0, 9)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint")
    assert {tuple(r) for r in log.end_offsets(df).collect()} == {("a", 3), ("b", 1)}
    assert {tuple(r) for r in log.topic_counts(df).collect()} == {("a", 3), ("b", 1)}


def test_progress(spark):
    rows = [("a", 0, o) for o in range(4, 10)] + [("a", 1, 0), ("a", 2, 3)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint")
    read = df.filter("partition = 1 or (partition = 0 and offset < 6)")
    got = {r.partition: (r.end_offset, r.position, r.lag, r.complete) for r in log.progress(df, read).collect()}
    assert got == {0: (10, 6, 4, False), 1: (1, 1, 0, True), 2: (4, 3, 1, False)}


def test_line_files(spark, tmp_path, line_df):
    path = str(tmp_path / "lines")
    lines.write_lines(line_df(["1,a,b,c", "2,,,"]), path)
    assert _values(lines.read_lines(spark, path)) == ["1,a,b,c", "2,,,"]
    (tmp_path / "ends.txt").write_bytes(b"a\nb\rc\r\nd")
    assert _values(lines.read_lines(spark, str(tmp_path / "ends.txt"))) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_lines_have_their_numbers_for_any_split(spark, tmp_path, line_df, split):
    files = {"a.txt": [f"{i} {'x' * (i % 50)}" for i in range(300)], "b.txt": [], "c.txt": ["é" * 40, "", "last without end"], "d.txt": [f"d{i}" for i in range(90)]}
    for name, some in files.items():
        (tmp_path / name).write_text("\n".join(some) + ("" if name == "c.txt" or not some else "\n"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "8")
    try:
        got = sorted((r.file.rsplit("/", 1)[1], r.line, r.value) for r in lines.numbered_lines(spark, str(tmp_path)).collect())
        assert got == [(f, i, v) for f, some in files.items() for i, v in enumerate(some, 1)]
        every = [(f, i, v) for f, some in files.items() for i, v in enumerate(some, 1)]
        for n, good, test in ((0, None, lambda v: True), (7, None, lambda v: True), (310, "value not like '%x%'", lambda v: "x" not in v), (999, "value like 'd%'", lambda v: v.startswith("d"))):
            first = lines.first_lines(spark, str(tmp_path), n, F.expr(good) if good else None).collect()
            assert [(r.file.rsplit("/", 1)[1], r.line, r.value) for r in first] == [x for x in every if test(x[2])][:n]
        assert {(r.lines, r.before) for r in lines.file_sizes(spark, str(tmp_path)).collect()} == {(300, 0), (3, 300), (90, 303)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_batches_of_a_checkpoint(spark, root, line_df):
    log.publish(spark.range(0, 90, 1, 9).selectExpr("cast(id as string) value"), root, "t", 1)
    consume.consume_new(spark, root, "t", "g", max_files_per_trigger=2)
    log.publish(line_df(["a", ""]).coalesce(1), root, "t", mode="append")
    consume.consume_new(spark, root, "t", "g")
    consume.consume_new(spark, root, "t", "g")
    got = [tuple(r) for r in consume.group_progress(spark, root, "t", "g").orderBy("batch").collect()]
    assert got == [(b, b, True, 20) for b in range(4)] + [(4, 4, True, 10), (5, 5, True, 2)]


def test_many_batches_of_a_checkpoint(spark, root):
    """Spark compacts the logs of its sources after ten batches."""
    log.publish(spark.range(0, 24, 1, 12).selectExpr("cast(id as string) value"), root, "t", 1)
    consume.consume_new(spark, root, "t", "g", max_files_per_trigger=1)
    got = [tuple(r) for r in consume.group_progress(spark, root, "t", "g").orderBy("batch").collect()]
    assert got == [(b, b, True, 2) for b in range(12)]


def test_stream_resumes_where_it_stopped(spark, root, line_df):
    log.publish(line_df(["a", "", "b"]).repartition(2), root, "t", 2)
    assert consume.consume_new(spark, root, "t", "g") == 2
    assert _values(consume.consumed(spark, root, "t", "g")) == ["a", "b"]
    log.publish(line_df(["c"]), root, "t", mode="append")
    assert consume.consume_new(spark, root, "t", "g", max_files_per_trigger=1) == 1
    assert consume.consume_new(spark, root, "t", "g") == 0
    got = consume.consumed(spark, root, "t", "g")
    assert _values(got) == ["a", "b", "c"]
    stored = log.read_log(spark, root, "t").filter("value <> ''")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, stored.collect()), key=str)
    assert consume.consume_new(spark, root, "t", "another") == 3


def test_batches_of_a_stream(spark, root, tmp_path, line_df):
    log.publish(line_df(["a", "b", "c", "d"]).repartition(2), root, "t", 1)
    stream = consume.stream_log(spark, root, "t", max_files_per_trigger=1)
    progress = consume.drain(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    batches = consume.batch_report(spark, progress).orderBy("batch").collect()
    assert sum(r["rows"] for r in batches) == 4 and [r.batch for r in batches] == [0, 1]
    assert batches[1].start_offset == batches[0].end_offset


def test_counts_do_not_depend_on_how_many_batches_spark_remembers(spark, root, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        log.publish(spark.range(0, 900, 1, 9).selectExpr("cast(id as string) value"), root, "t", 1)
        assert consume.consume_new(spark, root, "t", "g", max_files_per_trigger=1) == 900
        stream = consume.stream_log(spark, root, "t", max_files_per_trigger=1)
        progress = consume.drain(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        batches = consume.batch_report(spark, progress).collect()
        assert len(batches) == 9 and sum(r["rows"] for r in batches) == 900
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_a_publish_that_fails_leaves_the_topic_as_it_was(spark, root, line_df):
    log.publish(line_df(["a", "b"]), root, "t", 2)
    broken = line_df(["x"]).select(F.raise_error(F.lit("lost")).cast("string").alias("value"))
    with pytest.raises(Exception, match="lost"):
        log.publish(broken, root, "t", 1)
    assert _values(log.consume(spark, root, "t")) == ["a", "b"]
    log.publish(line_df(["c"]), root, "t", mode="append")
    assert _values(log.read_log(spark, root, "t")) == ["a", "b", "c"]
    log.publish(line_df(["d"]), root, "t", 1)
    assert _values(log.consume(spark, root, "t")) == ["d"]


def test_a_topic_can_be_published_to_itself(spark, root):
    log.publish(spark.range(0, 2000, 1, 4).selectExpr("cast(id as string) value"), root, "t", 3)
    assert log.publish(log.consume(spark, root, "t"), root, "t", 2) == 2000
    out = log.read_log(spark, root, "t")
    assert out.select("value").distinct().count() == 2000 and out.select("partition").distinct().count() == 2
    assert len(log.recorded_runs(spark, root, "t")) == 1


def test_old_runs_that_could_not_be_deleted_do_not_count(spark, root, line_df, monkeypatch):
    log.publish(line_df(["a", "b"]), root, "t", 2)
    monkeypatch.setattr(log, "_drop_runs", lambda *_: None)
    log.publish(line_df(["c"]), root, "t", 1)
    log.publish(line_df(["d"]), root, "t", mode="append")
    assert [(r.offset, r.value) for r in log.read_log(spark, root, "t").orderBy("offset").collect()] == [(0, "c"), (1, "d")]
    assert log.stored_end_offsets(spark, root, "t").first()["rows"] == 2


def test_stream_that_does_not_end_in_time_is_an_error(spark, root, tmp_path, line_df):
    log.publish(line_df(["a"]), root, "t", 1)
    with pytest.raises(consume.NotDrained):
        stream = consume.stream_log(spark, root, "t")
        consume.drain(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), timeout=0.001)


def test_kafka_options():
    read = kafka.read_options("h:1", "a", "b", maxOffsetsPerTrigger="5")
    assert read["subscribe"] == "a,b" and read["startingOffsets"] == "earliest" and read["maxOffsetsPerTrigger"] == "5"
    plain, ordered = kafka.write_options("h:1", "t"), kafka.write_options("h:1", "t", ordered=True)
    assert plain == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    assert ordered["kafka.acks"] == "all" and ordered["topic"] == "t"
    own = kafka.write_options("h:1", "t", ordered=True, **{"kafka.linger.ms": "5", "kafka.acks": "1"})
    assert own["kafka.linger.ms"] == "5" and own["kafka.acks"] == "1"


def test_kafka_rows_of_an_ordered_topic(spark):
    out = kafka.sorted_rows(synth.records(spark, 2000, tasks=3), "id", 4).withColumn("task", F.spark_partition_id())
    parts = {}
    for r in out.collect():
        parts.setdefault(r.partition, []).append(int(r.value.split(",")[0]))
    assert sorted(parts) == [0, 1, 2, 3]
    joined = [i for p in sorted(parts) for i in parts[p]]
    assert joined == sorted(joined) and len(joined) == 2000


def test_kafka_rows_take_the_shape_of_a_log(spark):
    raw = spark.createDataFrame(
        [("t", 0, 1, bytearray(b"k"), bytearray(b"v"), 0)],
        "topic string, partition int, offset bigint, key binary, value binary, timestampType int",
    )
    assert kafka.as_log(raw).schema.simpleString() == LOG.simpleString()


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka.read_log(spark, "localhost:9", "t")
