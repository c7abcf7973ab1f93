"""The whole job from a shell, on generated or given lines, or the checks alone."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ordlog import workspace
from ordlog.plans import end_to_end
from ordlog.schema import KEYS, PREVIEW_ROWS, SOURCE_PARTITIONS
from ordlog.sources import lines, log
from ordlog.sources.logs import FileLogs, KafkaLogs


def _arguments(given: list[str] | None) -> argparse.Namespace:
    args = argparse.ArgumentParser(prog="ordlog", description=__doc__)
    what = args.add_mutually_exclusive_group()
    what.add_argument("--count", type=int, default=50_000_000, help="records to generate")
    what.add_argument("--lines", help="a file or folder of lines to sort instead")
    what.add_argument("--verify", action="store_true", help="only check the ordered topics that are there")
    args.add_argument("--seed", type=int, default=42)
    args.add_argument("--root", help="folder of the logs; a fresh one if not given")
    args.add_argument("--bootstrap", help="Kafka servers; without it the logs are kept below the root")
    args.add_argument("--partitions", type=int, default=SOURCE_PARTITIONS, help="of the source topic")
    args.add_argument("--ordered-partitions", type=int, default=32, help="of each ordered Kafka topic")
    parsed = args.parse_args(given)
    if parsed.verify and not (parsed.root or parsed.bootstrap):
        args.error("--verify needs the --root or --bootstrap of the topics")
    return parsed


def main(arguments: list[str] | None = None) -> None:
    given = _arguments(arguments)
    spark = SparkSession.builder.appName("ordlog").config(map=workspace.SHORT_KEYS).getOrCreate()
    root = given.root or workspace.fresh(spark, "run")
    kafka = KafkaLogs(spark, given.bootstrap, given.ordered_partitions) if given.bootstrap else None
    if given.verify:
        logs = kafka or FileLogs(spark, root)
        end_to_end.verify_topics({k: logs.read(k) for k in KEYS}).show(truncate=False)
        return
    taken = lines.read_lines(spark, given.lines) if given.lines else None
    done = end_to_end.run(
        spark, lines=taken, count=given.count, seed=given.seed, root=root, logs=kafka, partitions=given.partitions
    )
    done.summary.orderBy("step").show(truncate=False)
    done.report.show(truncate=False)
    if not given.bootstrap:
        for key in KEYS:
            log.read_head(spark, root, key, PREVIEW_ROWS).orderBy("offset").show(truncate=False)


if __name__ == "__main__":
    main()
