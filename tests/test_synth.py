import re

import pytest
from pyspark.sql import functions as F

from ordlog.functions import codec, rules
from ordlog.schema import ADDRESS_CHARS, CONTINENTS, LETTERS
from ordlog.sources import synth


@pytest.fixture(scope="module")
def thousand(spark):
    return synth.records(spark, 1000).collect()


def test_count_is_exact_and_zero_gives_none(spark, thousand):
    assert len(thousand) == 1000
    assert synth.records(spark, 0).count() == 0


def test_field_domains(thousand):
    for r in thousand:
        assert 0 <= r.id < 2147483647
        assert re.fullmatch(r"[a-zA-Z]{10,15}", r.name)
        assert re.fullmatch(r"[0-9] [a-zA-Z0-9 ]{13,18}", r.address)
        assert r.continent in CONTINENTS
    assert {r.continent for r in thousand} == set(CONTINENTS)
    assert {len(r.name) for r in thousand} == set(range(10, 16))
    assert {len(r.address) for r in thousand} == set(range(15, 21))
    addresses = "".join(r.address for r in thousand)
    assert any(c.isdigit() for c in addresses) and any(c.isalpha() for c in addresses) and " " in addresses


def test_every_line_has_four_fields(spark):
    assert codec.parse(codec.to_lines(synth.records(spark, 500))).count() == 500


def test_same_rows_for_any_partitioning(spark):
    one, many = synth.records(spark, 2000, tasks=1), synth.records(spark, 2000, tasks=7)
    assert sorted(one.collect()) == sorted(many.collect())


@pytest.mark.parametrize("count", [0, 1, 7, synth.BLOCK, synth.BLOCK + 1, 3 * synth.BLOCK + 5])
def test_written_lines_are_those_of_the_records(spark, tmp_path, count):
    synth.write_lines(spark, count, f"{tmp_path}/lines", seed=3)
    got = sorted(r.value for r in spark.read.text(f"{tmp_path}/lines").collect())
    want = sorted(r.value for r in codec.to_lines(synth.records(spark, count, seed=3)).collect())
    assert got == want and len(got) == count


def test_ids_of_every_width_are_written_in_full():
    import numpy as np

    drawn = np.array([0, 7, 10, 99, 12345, 10**8, 999_999_999, 10**9, 2147483646], np.int32)
    real = synth._drawn
    try:
        synth._drawn = lambda rows, *more: (drawn[: len(rows)], *real(rows, *more)[1:])
        lines = synth._block(0, len(drawn), 42, synth._tables()).decode().split("\n")
    finally:
        synth._drawn = real
    assert [int(x.split(",")[0]) for x in lines] == drawn.tolist()
    assert [x.split(",")[0] for x in lines] == [str(x) for x in drawn.tolist()]


def test_draws_are_those_of_the_published_generator():
    """The first numbers of SplitMix64 for the seed 1234567."""
    import numpy as np

    steps = (np.arange(1, 4, dtype=np.uint64) * np.uint64(synth.GAMMA) + np.uint64(1234567)).astype(np.uint64)
    assert synth._mixed(steps).tolist() == [6457827717110365317, 3203168211198807973, 9817491932198370423]


def test_rows_without_an_id_have_no_record(spark):
    ids = spark.createDataFrame([(1,), (None,), (-5,), (2**62,)], "k long")
    assert sorted(r.row_id for r in synth.records_for(ids, "k").collect()) == [-5, 1, 2**62]


def test_seeds_differ_and_rows_differ(spark):
    a, b = synth.records(spark, 500, seed=1), synth.records(spark, 500, seed=2)
    assert not {r.name for r in a.collect()} & {r.name for r in b.collect()}
    assert synth.records(spark, 200_000).select("id", "name").distinct().count() == 200_000


def test_far_row_ids_do_not_repeat(spark):
    ids = spark.range(1000).select(F.explode(F.array("id", F.col("id") + 2147483647)).alias("row_id"))
    assert synth.records_for(ids).select("name").distinct().count() == 2000


@pytest.mark.parametrize("column, chars, skip", [("name", LETTERS, 0), ("address", ADDRESS_CHARS, 2)])
def test_characters_are_uniform(spark, column, chars, skip):
    n = 50_000
    texts = [r[0][skip:] for r in synth.records(spark, n).select(column).collect()]
    for place in (0, 1, 5, 9):
        seen = dict.fromkeys(chars, 0)
        for t in texts:
            seen[t[place]] += 1
        expected = n / len(chars)
        chi2 = sum((k - expected) ** 2 / expected for k in seen.values())
        assert chi2 < 2 * len(chars), (place, chi2)


def test_continents_and_lengths_are_uniform(spark):
    n = 60_000
    rows = synth.records(spark, n).groupBy("continent", F.length("name").alias("k")).count().collect()
    assert len(rows) == 36
    assert all(abs(r["count"] - n / 36) < 0.12 * n / 36 for r in rows)


def test_generated_records_pass_the_rules(spark):
    report = rules.rule_report(codec.to_lines(synth.records(spark, 1000)), 1000).collect()
    assert all(r.passed for r in report), report
    assert len(report) == 17


def test_rules_find_what_is_wrong(line_df):
    good = "5,abcdefghij,1 abcdefghijklmn,Asia"
    lines = line_df([good, "-5,abcdefghij,1 abcdefghijklmn,Asia", "5,abc,1 abcdefghijklmn,Asia", "5,abcdefghi9,1 a,Mars", "bad"])
    report = {r.rule: (r.checked, r.violations, r.passed) for r in rules.rule_report(lines, 7).collect()}
    assert report["parses"] == (5, 1, False)
    assert report["id_range"] == (4, 1, False)
    assert report["name_length"] == (4, 1, False)
    assert report["name_letters"] == (4, 1, False)
    assert report["address_length"] == (4, 1, False)
    assert report["address_chars"] == (4, 0, True)
    assert report["continent_valid"] == (4, 1, False)
    assert report["continent_present:Asia"] == (4, 0, True)
    assert report["continent_present:Europe"] == (4, 1, False)
    assert report["row_count"] == (5, 2, False)


def test_a_newline_does_not_slip_through_a_whole_match(line_df):
    lines = line_df(["5,abcdefghij\n,1 abcdefghijklmn,Asia"])
    report = {r.rule: r.violations for r in rules.rule_report(lines).collect()}
    assert report["name_letters"] == 1


def test_rules_on_no_rows(line_df):
    report = {r.rule: r for r in rules.rule_report(line_df([]), 0).collect()}
    assert report["row_count"].passed and report["parses"].checked == 0
    assert not report["continent_present:Asia"].passed


WITHOUT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from ordlog.operators import order_check
from ordlog.sources import log, synth
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
synth.write_lines(spark, 100, "lines")
rows = synth.records(spark, 100).drop("row_id")
log.publish_sorted(rows, "root", "t", "id")
log.publish_sorted(rows, "root", "t", "id", mode="append")
report = order_check.order_report(log.read_topic(spark, "root", "t"), "offset").first()
print("lines", spark.read.text("lines").count(), "rows", report["rows"], report.violations)
"""


def test_workers_need_not_have_the_package(tmp_path):
    """A driver that has it on its own path only, in another folder."""
    import os
    import pathlib
    import subprocess
    import sys

    repo = str(pathlib.Path(__file__).resolve().parents[1])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", WITHOUT.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "lines 100 rows 200 0" in done.stdout, done.stderr[-3000:]
