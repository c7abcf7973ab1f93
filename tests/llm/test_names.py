"""Columns of any name pass through what hands whole rows on, and the session stays as it is."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ordlog.llm import decontamination, language, mixing, ngram_join, packing, vector_codes
from tests.llm.conftest import small

NAMES = (
    "found _found _held_found held_out lang_pred score familiar size place _times last_0 last_1 _copy _kept _own _rows "
    "_same same row n _n a _a b _b d1 d2 _d1 _d2 component large id _source source_size target sid shard pos offset nth "
    "times rows label node hash cls sig ids hits items start length"
).split()


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(small("benchmark"))


def kept_by(items):
    return {
        "recognised": language.recognised,
        "deduplicated": ngram_join.deduplicated,
        "decontaminate": lambda d: decontamination.decontaminate(d, items),
        "decontaminate in blocks": lambda d: decontamination.decontaminate(d, items, block_words=300),
        "mixed": mixing.mixed,
    }


@pytest.mark.parametrize("step", list(kept_by(None)))
def test_every_name_comes_through(spark, real, items, step):
    run = kept_by(items)[step]
    more = real.filter("doc_id < 60").unionByName(real.filter("doc_id in (3, 4)"))  # repeated ids too
    more = more.unionByName(real.filter("doc_id in (5, 6)").withColumn("doc_id", F.lit(None).cast("bigint")))
    clashing = more.select("*", *[F.concat(F.lit(f"{n}-"), F.crc32("text")).alias(n) for n in NAMES])
    got, plain = run(clashing), run(more)
    assert got.columns == clashing.columns
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    assert key(got.select(*more.columns).collect()) == key(plain.collect())
    before = {r.crc for r in more.select(F.crc32("text").alias("crc")).collect()}
    for r in got.collect():
        values = {r[n].removeprefix(f"{n}-") for n in NAMES}
        assert len(values) == 1 and int(values.pop()) in before


def test_reports_read_what_they_are_told_to(real, items):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    some = real.filter("doc_id < 40")
    other = some.select(*[F.lit(0).cast("bigint").alias(n) for n in NAMES if n not in ("n", "text")], F.col("doc_id").alias("n"), F.lit("x").alias("other"), "text", "source", "lang")
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    for run in (
        lambda d, **k: language.report(d, **k),
        lambda d, **k: mixing.report(d, **k),
        lambda d, **k: decontamination.report(d, items, **k),
        lambda d, **k: ngram_join.report(d, **k),
        lambda d, **k: packing.report(d, tokenizer, spaced=True, **k),
    ):
        assert [x[:3] for x in key(run(other, doc_id="n"))] == [x[:3] for x in key(run(some))]


def test_the_session_stays_as_it_is(spark, real, items):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.unset(name)
    try:
        default = spark.conf.get(name)
        some = real.filter("doc_id < 20")
        language.report(some).collect()
        decontamination.report(some, items).collect()
        ngram_join.report(some).collect()
        vector_codes.report(spark.read.parquet(small("embeddings")).limit(20)).collect()
        assert spark.conf.get(name) == default
    finally:
        spark.conf.set(name, before)
