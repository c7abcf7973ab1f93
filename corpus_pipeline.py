"""A corpus made ready for training: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ordlog.llm import decontamination, language, mixing, ngram_join, token_files
from ordlog.llm.shared import small_batches, stage, table


def step(run: Callable) -> Callable:
    """The pipeline owns its session: texts reach Python in small batches."""

    @wraps(run)
    def prepared(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        small_batches(spark)
        return run(spark, docs, folder)

    return prepared


@step
def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without letters go, and those unlike all that was learned of any language."""
    return language.recognised(docs)


@step
def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id stays."""
    return ngram_join.deduplicated(docs)


@step
def clear_of_benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages of test items are cut out; documents that mostly are one go."""
    return decontamination.decontaminate(docs, table(spark, folder, "benchmark"))


@step
def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents are left out or repeated so that sources meet their target weights."""
    return mixing.mixed(docs)


@step
def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The files' documents: doc_id, start, n_tokens and ids_crc32."""
    return token_files.report(docs, public_tokenizers.path("word_bpe_49k.json"), spaced=True, special=True)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", clear_of_benchmarks),
    ("mixing", mixed_sources),
    ("token_files", token_ids),
]

# regression on kernels and a trained tokenizer are beyond SQL: tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, folder), name)
    return docs
