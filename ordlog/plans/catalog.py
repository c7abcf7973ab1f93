"""The named queries: each operator over the tables of a folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordlog import workspace
from ordlog.functions import codec, rules
from ordlog.operators import compare, order, order_check, probe, segments
from ordlog.plans import end_to_end
from ordlog.schema import KEYS, PREVIEW_ROWS, SOURCE_TOPIC
from ordlog.sources import lines, log, synth, tables
from ordlog.sources.logs import FileLogs
from ordlog.streaming import consume

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

QUERIES = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


# --- records and lines ---------------------------------------------------------------


def _generated(spark: SparkSession, folder: str) -> DataFrame:
    """One generated record for each order."""
    return synth.records_for(tables.table(spark, folder, "orders"), "o_orderkey")


@query
def synth_records(spark: SparkSession, folder: str) -> DataFrame:
    return _generated(spark, folder)


@query
def synth_rule_report(spark: SparkSession, folder: str) -> DataFrame:
    expected = tables.table(spark, folder, "orders").count()
    return rules.rule_report(codec.to_lines(_generated(spark, folder)), expected)


@query
def records_rule_report(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_report(tables.lines(spark, folder), domain=REGIONS)


@query
def serialize_lines(spark: SparkSession, folder: str) -> DataFrame:
    return codec.to_lines(tables.records(spark, folder))


@query
def text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = workspace.fresh(spark, "lines")
    lines.write_lines(codec.to_lines(tables.records(spark, folder)), path)
    return codec.parse(lines.read_lines(spark, path))


def _line_file(spark: SparkSession, folder: str) -> str:
    """A folder of text files with two lines for each order, in text order: its record, and
    one of too few fields."""
    orders = codec.to_lines(tables.order_records(spark, folder))
    short = tables.table(spark, folder, "orders").selectExpr("concat(o_orderkey, ',', o_orderstatus) as value")
    path = workspace.fresh(spark, "line-file")
    lines.write_lines(segments.range_sorted(orders.unionByName(short), ["value"]), path)
    return path


@query
def head_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The first 1,000 lines of the files that parse, with their numbers from the beginning."""
    path = _line_file(spark, folder)
    good = codec.has_fields(F.col("value")) & codec.strict_int(F.substring_index("value", ",", 1)).isNotNull()
    first = lines.first_lines(spark, path, order.CHECKED_ROWS, good)
    # numbers within a file become numbers in all of them
    ahead = lines.file_sizes(spark, path).select(F.col("file").alias("_file"), "before")
    return first.join(F.broadcast(ahead), F.col("file") == F.col("_file")).select((F.col("before") + F.col("line")).alias("number"), "value")


@query
def line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of the files with its number from the beginning of all."""
    path = _line_file(spark, folder)
    ahead = lines.file_sizes(spark, path).select(F.col("file").alias("_file"), "before")
    every = lines.numbered_lines(spark, path).join(F.broadcast(ahead), F.col("file") == F.col("_file"))
    return every.select((F.col("before") + F.col("line")).alias("number"), "value")


@query
def parse_lines(spark: SparkSession, folder: str) -> DataFrame:
    return codec.parse(tables.lines(spark, folder))


@query
def quarantine_lines(spark: SparkSession, folder: str) -> DataFrame:
    return codec.quarantine(tables.lines(spark, folder))


@query
def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    return codec.quarantine_counts(tables.lines(spark, folder))


@query
def normalize_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Blanks off, empty lines out, then parsed: the padded lines become valid."""
    return codec.parse(codec.drop_empty(codec.normalize_lines(tables.lines(spark, folder))))


@query
def project_fields(spark: SparkSession, folder: str) -> DataFrame:
    return codec.positional(tables.lines(spark, folder))


@query
def project_keys(spark: SparkSession, folder: str) -> DataFrame:
    return codec.parse(tables.lines(spark, folder)).select(
        *[codec.key_text(k).alias(f"{k}_key") for k in KEYS]
    )


# --- order ---------------------------------------------------------------------------


@query
def sort_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return order.sort_records(tables.records(spark, folder), "id")


@query
def sort_by_name(spark: SparkSession, folder: str) -> DataFrame:
    return order.sort_records(tables.records(spark, folder), "name")


@query
def sort_by_continent(spark: SparkSession, folder: str) -> DataFrame:
    return order.sort_records(tables.records(spark, folder), "continent")


@query
def sort_custom(spark: SparkSession, folder: str) -> DataFrame:
    """Descending with nulls last, then by an expression, then by a distance."""
    orders = tables.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    return order.sort_by(
        orders,
        F.nullif(F.col("o_orderstatus"), F.lit("P")).desc_nulls_last(),
        F.substring("o_orderpriority", 3, 100),
        F.abs(F.col("o_totalprice") - 100000),
        ties=["o_orderkey"],
    )


@query
def sort_lineitem_shipdate(spark: SparkSession, folder: str) -> DataFrame:
    items = tables.table(spark, folder, "lineitem").select(
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return order.sort_by(items, "l_shipdate")


@query
def sort_documents_by_lang(spark: SparkSession, folder: str) -> DataFrame:
    """Few keys, whole texts as ties: texts that begin alike are still in order."""
    documents = tables.table(spark, folder, "documents").select("lang", "text", "doc_id")
    return order.sort_by(documents, "lang", ties=["text", "doc_id"]).drop("text")


@query
def bucket_counts(spark: SparkSession, folder: str) -> DataFrame:
    return order.bucket_counts(tables.table(spark, folder, "orders"), "o_orderpriority")


@query
def bucket_ordered(spark: SparkSession, folder: str) -> DataFrame:
    """Each row with its own place and that of its bucket."""
    return order.bucketed(tables.order_records(spark, folder), "continent")


@query
def bucket_grouped(spark: SparkSession, folder: str) -> DataFrame:
    """Buckets without a shuffle: a row's own place in its bucket is free, each is taken once."""
    placed = order.grouped_buckets(tables.order_records(spark, folder), "continent", max_buckets=5)
    places = F.count_distinct("offset").alias("places")
    ends = [F.min("offset").alias("first_place"), F.max("offset").alias("last_place"), F.count("*").alias("rows")]
    return placed.groupBy("continent", "bucket", "bucket_first", "bucket_last").agg(places, *ends)


@query
def bucket_order_check(spark: SparkSession, folder: str) -> DataFrame:
    """The buckets strung together are one gapless log in key order."""
    placed = order.bucketed(tables.order_records(spark, folder), "continent")
    one = placed.select(
        F.lit("continent").alias("topic"), F.lit(0).alias("partition"), "offset", "continent"
    )
    return order_check.order_report(one, "continent")


@query
def merge_sorted(spark: SparkSession, folder: str) -> DataFrame:
    """Two sorted tables; only shards that overlap with the other's are sorted again."""
    customers = order.sorted_table(tables.records(spark, folder), "name")
    suppliers = order.sorted_table(tables.supplier_records(spark, folder), "name")
    return order.merge_sorted(customers, suppliers, order=["name"])


@query
def merge_overlapping(spark: SparkSession, folder: str) -> DataFrame:
    """The same where most shards overlap: ids of both run from 1."""
    customers = order.sorted_table(tables.records(spark, folder), "id")
    suppliers = order.sorted_table(tables.supplier_records(spark, folder), "id")
    return order.merge_sorted(customers, suppliers, order=["id"])


@query
def head_sorted(spark: SparkSession, folder: str) -> DataFrame:
    """The first 1,000 orders by name, with their places."""
    return order.sorted_head(tables.order_records(spark, folder), "name")


@query
def first_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """The same first 1,000 without sorting the rest."""
    return order.first_rows(tables.order_records(spark, folder), "name", "id", "address", "continent")


@query
def cardinality_probe(spark: SparkSession, folder: str) -> DataFrame:
    return probe.cardinality_probe(tables.order_records(spark, folder), list(KEYS))


@query
def cardinality_of_head(spark: SparkSession, folder: str) -> DataFrame:
    """The same of the first 1,000 orders by id only, as a caller may ask."""
    records = tables.order_records(spark, folder)
    return probe.cardinality_probe(records, list(KEYS), n=1000, order=["id"])


@query
def cardinality_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts only: the sketches' counts are estimates."""
    keys = ["l_returnflag", "l_linenumber", "l_suppkey", "l_orderkey"]
    return probe.cardinality_approx(tables.table(spark, folder, "lineitem"), keys).drop("distinct_keys")


@query
def topic_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on a topic after two publishes, by the sketches these left."""
    root = workspace.fresh(spark, "topics")
    log.publish(codec.to_lines(tables.order_records(spark, folder)), root, SOURCE_TOPIC, sketched=KEYS)
    log.publish(tables.lines(spark, folder), root, SOURCE_TOPIC, mode="append", sketched=KEYS)
    return log.cardinality(spark, root, SOURCE_TOPIC).drop("distinct_keys")


# --- logs ----------------------------------------------------------------------------


def _sorted_topics(spark: SparkSession, folder: str, source: bool = False) -> str:
    """A root with the records as three ordered topics and, if wanted, as source."""
    root = workspace.fresh(spark, "topics")
    records = tables.records(spark, folder)
    if source:
        log.publish(codec.to_lines(records), root, SOURCE_TOPIC)
    end_to_end.sort_topics(records, FileLogs(spark, root))
    return root


@query
def publish_consume(spark: SparkSession, folder: str) -> DataFrame:
    """All lines through a three-partition log; padded ones come back trimmed, empty ones do not."""
    root = workspace.fresh(spark, "topics")
    log.publish(tables.lines(spark, folder), root, SOURCE_TOPIC, partitions=3)
    return log.consume(spark, root, SOURCE_TOPIC)


@query
def published_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Two publishes to one topic: offsets go on where they ended, without gap or repeat."""
    root = workspace.fresh(spark, "topics")
    log.publish(tables.lines(spark, folder), root, SOURCE_TOPIC, partitions=3)
    log.publish(codec.to_lines(tables.order_records(spark, folder)), root, SOURCE_TOPIC, mode="append")
    report = order_check.order_report(log.read_log(spark, root, SOURCE_TOPIC), F.col("offset"))
    return report.groupBy("topic").agg(
        F.count("*").alias("partitions"),
        F.sum("rows").alias("rows"),
        F.sum("violations").alias("violations"),
        F.bool_and("gapless").alias("gapless"),
    )


@query
def ordered_topics(spark: SparkSession, folder: str) -> DataFrame:
    return log.read_log(spark, _sorted_topics(spark, folder), *KEYS)


@query
def preview_topics(spark: SparkSession, folder: str) -> DataFrame:
    root = _sorted_topics(spark, folder)
    return reduce(DataFrame.unionByName, [log.read_head(spark, root, k, PREVIEW_ROWS) for k in KEYS])


@query
def head_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the first 1,000 rows of an ordered topic."""
    root = workspace.fresh(spark, "topics")
    log.publish_sorted(tables.order_records(spark, folder), root, "name", "name")
    return codec.parse(log.read_head(spark, root, "name", order.CHECKED_ROWS), keep=("offset",))


@query
def topic_counts(spark: SparkSession, folder: str) -> DataFrame:
    root = _sorted_topics(spark, folder, source=True)
    counted = log.topic_counts(log.read_log(spark, root, SOURCE_TOPIC, *KEYS))
    stored = log.stored_end_offsets(spark, root, SOURCE_TOPIC, *KEYS)
    return counted.join(stored.withColumnRenamed("rows", "recorded"), "topic")


@query
def recorded_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each topic by the segment tables alone."""
    return log.stored_end_offsets(spark, _sorted_topics(spark, folder, source=True), SOURCE_TOPIC, *KEYS)


@query
def log_end_offsets(spark: SparkSession, folder: str) -> DataFrame:
    return log.end_offsets(tables.event_log(spark, folder))


@query
def log_progress(spark: SparkSession, folder: str) -> DataFrame:
    """A reader that has taken the first 3,000 rows of each partition."""
    events = tables.event_log(spark, folder)
    return log.progress(events, events.filter("offset < 3000"))


@query
def event_log_rows(spark: SparkSession, folder: str) -> DataFrame:
    return tables.event_log(spark, folder).drop("key", "amount")


# --- checks --------------------------------------------------------------------------


@query
def order_check_sorted(spark: SparkSession, folder: str) -> DataFrame:
    root = _sorted_topics(spark, folder)
    return end_to_end.verify_topics({k: log.read_topic(spark, root, k) for k in KEYS})


@query
def order_check_damaged(spark: SparkSession, folder: str) -> DataFrame:
    """Topics that are not what they say: read as another key's, and with rows missing."""
    root = _sorted_topics(spark, folder)
    wrong = {key: log.read_topic(spark, root, other) for key, other in (("id", "name"), ("continent", "id"))}
    holes = log.read_topic(spark, root, "name").filter("offset % 10 <> 3")
    return end_to_end.verify_topics(wrong | {"name": holes})


@query
def order_check_unsorted(spark: SparkSession, folder: str) -> DataFrame:
    return order_check.order_report(tables.event_log(spark, folder), "amount")


@query
def first_violations(spark: SparkSession, folder: str) -> DataFrame:
    return order_check.first_violations(tables.event_log(spark, folder), "amount")


@query
def fingerprint_match(spark: SparkSession, folder: str) -> DataFrame:
    """The records and their sorted table: equal. All but one region's: not."""
    records = tables.records(spark, folder)
    ordered = order.sort_records(records, "name").drop("offset")
    whole = compare.same_rows(records, ordered).withColumn("case", F.lit("sorted"))
    part = compare.same_rows(records, ordered.filter("continent <> 'ASIA'"))
    return whole.unionByName(part.withColumn("case", F.lit("without ASIA")))


@query
def multiset_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Customers by the number of their orders, less one each."""
    orders = tables.table(spark, folder, "orders").selectExpr("o_custkey key")
    customers = tables.table(spark, folder, "customer").selectExpr("c_custkey key")
    return compare.multiset_diff(orders, customers)


@query
def lost_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Which rows a damaged topic lacks, and which it has twice: by a sketch, no row shuffled."""
    records = tables.records(spark, folder)
    ordered = order.sort_records(records, "name")
    damaged = ordered.filter("offset % 100 <> 3").unionByName(ordered.filter("offset % 250 = 0")).drop("offset")
    return compare.lost_rows(records, damaged)


@query
def observed_domain(spark: SparkSession, folder: str) -> DataFrame:
    return compare.observed_domain(tables.records(spark, folder), "continent")


@query
def domain_equality(spark: SparkSession, folder: str) -> DataFrame:
    """Continents seen on valid lines against the regions' names."""
    seen = codec.parse(tables.lines(spark, folder))
    return compare.domain_diff(seen, "continent", tables.table(spark, folder, "region").select("r_name"))


# --- streams -------------------------------------------------------------------------


@query
def stream_consume(spark: SparkSession, folder: str) -> DataFrame:
    root = workspace.fresh(spark, "topics")
    log.publish(tables.lines(spark, folder), root, SOURCE_TOPIC, partitions=3)
    consume.consume_new(spark, root, SOURCE_TOPIC, "sorter")
    return consume.consumed(spark, root, SOURCE_TOPIC, "sorter").select("value")


@query
def stream_resume(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, then customers, then nothing: each read takes only what is new."""
    root = workspace.fresh(spark, "topics")
    steps = []
    for step, source in enumerate([tables.order_records, tables.records, None]):
        if source:
            lines_ = codec.to_lines(source(spark, folder))
            log.publish(lines_, root, SOURCE_TOPIC, mode="append" if step else "overwrite")
        read = consume.consume_new(spark, root, SOURCE_TOPIC, "sorter")
        done = log.progress(
            log.read_log(spark, root, SOURCE_TOPIC), consume.consumed(spark, root, SOURCE_TOPIC, "sorter")
        )
        steps.append(
            done.agg(
                F.lit(step).alias("step"),
                F.lit(read).cast("bigint").alias("rows_read"),
                F.sum("position").alias("rows_held"),
                F.bool_and("complete").alias("complete"),
            )
        )
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


@query
def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """What Spark's checkpoint says of two drains of a growing topic, and of a third that
    found nothing new."""
    root = workspace.fresh(spark, "topics")
    for mode, source in (("overwrite", tables.order_records), ("append", tables.records), (None, None)):
        if source:
            log.publish(codec.to_lines(source(spark, folder)), root, SOURCE_TOPIC, mode=mode)
        consume.consume_new(spark, root, SOURCE_TOPIC, "sorter")
    return consume.group_progress(spark, root, SOURCE_TOPIC, "sorter")


# --- the whole job -------------------------------------------------------------------


@query
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return end_to_end.run(spark, tables.records(spark, folder)).summary


@query
def run_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """What the job sets aside: records whose id is missing."""
    broken = F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id"))
    done = end_to_end.run(spark, tables.records(spark, folder).withColumn("id", broken))
    return spark.read.parquet(f"{done.root}/quarantine")


@query
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job on one generated record for each order."""
    return end_to_end.run(spark, _generated(spark, folder)).report
