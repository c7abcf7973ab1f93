"""Times the headline queries and the job's four steps; prints one JSON line.

BENCH_SF_DIR   folder of the tables          (default /root/testdata/sf0.1)
BENCH_CPUS     cores                         (default 8)
BENCH_ROWS     rows of the four-step job     (default 5,000,000; 0 skips it)
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from ordlog import workspace
from ordlog.functions import codec
from ordlog.operators import segments
from ordlog.plans import catalog, end_to_end
from ordlog.schema import KEYS, SOURCE_TOPIC
from ordlog.sources import log, synth
from ordlog.sources.logs import FileLogs

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROWS = int(os.environ.get("BENCH_ROWS", "5000000"))
REPEATS = 2

BASELINE = {"generate": 50e6 / 24, "publish": 50e6 / 108, "consume": 50e6 / 82, "sort_and_publish": 150e6 / 478}

HEADLINE = [
    "synth_records",
    "parse_lines",
    "quarantine_lines",
    "normalize_lines",
    "sort_by_id",
    "sort_custom",
    "sort_lineitem_shipdate",
    "bucket_ordered",
    "merge_sorted",
    "head_sorted",
    "cardinality_probe",
    "cardinality_approx",
    "publish_consume",
    "ordered_topics",
    "order_check_sorted",
    "order_check_unsorted",
    "first_violations",
    "fingerprint_match",
    "stream_consume",
    "run_summary",
    "run_report",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def steps(spark: SparkSession, rows: int) -> dict[str, float]:
    """Seconds of each step on generated records."""
    root = workspace.fresh(spark, "bench")
    took = {}
    text = f"{root}/text"
    took["generate"] = timed(lambda: synth.write_lines(spark, rows, text))
    took["publish"] = timed(lambda: log.publish(spark.read.text(text), root, SOURCE_TOPIC))
    staged = f"{root}/consumed"
    parsed = codec.parse(log.consume(spark, root, SOURCE_TOPIC))
    took["consume"] = timed(lambda: segments.stage(parsed, staged))
    records = spark.read.schema(parsed.schema).parquet(staged)
    took["sort_and_publish"] = timed(
        lambda: end_to_end.sort_topics(records, FileLogs(spark, root))
    )
    topics = {k: log.read_topic(spark, root, k) for k in KEYS}
    took["verify"] = timed(lambda: end_to_end.verify_topics(topics).collect())
    return took


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ordlog-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config(map=workspace.SHORT_KEYS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {}
    for name in HEADLINE:
        query = catalog.QUERIES[name]
        queries[name] = min(timed(lambda: run(query(spark, FOLDER))) for _ in range(REPEATS))
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    result = {
        "metric": "total of headline queries",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(scale.group(1)) if scale else None,
    }
    if ROWS:
        steps(spark, ROWS // 20)  # compiles the code the timed run then uses
        took = steps(spark, ROWS)
        made = dict.fromkeys(took, ROWS) | {"sort_and_publish": 3 * ROWS, "verify": 3 * ROWS}
        result["steps"] = took
        result["steps_rows"] = ROWS
        speed = {k: made[k] / s for k, s in took.items()}
        result["steps_rows_per_sec"] = {k: round(v) for k, v in speed.items()}
        result["steps_times_baseline"] = {k: round(speed[k] / v, 2) for k, v in BASELINE.items()}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
