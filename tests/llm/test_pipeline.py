"""The pipeline, stage by stage: each works on what the one before it kept."""

import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from ordlog.llm import mixing
from tests.llm.test_ngram_join import brute
from tests.llm.test_scans import brute as scanned
from tests.llm.test_scans import windows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into each stage and what comes out, as tables that were written."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, FOLDER).write.parquet(f"{root}/{name}")
        after = spark.read.parquet(f"{root}/{name}")
        out[name] = docs, after
        docs = after
    return out


def test_stages_pass_documents_on(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "mixing", "token_files"]
    for name in names[:-1]:
        before, after = stages[name]
        assert after.columns == before.columns


def test_texts_of_no_language_go(stages):
    before, after = (t.collect() for t in stages["language"])
    kept = {r.doc_id for r in after}
    assert kept <= {r.doc_id for r in before} and len(kept) >= 0.98 * len(before)


def test_one_of_each_group_stays(stages):
    before, after = (t.collect() for t in stages["near_duplicates"])
    want = {d for d, _, c in brute([(r.doc_id, r.text) for r in before]) if d == c}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_no_passage_is_left_and_clean_texts_stay(spark, stages):
    before, after = (t.collect() for t in stages["decontamination"])
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    table = windows([(r.item_id, r.text) for r in items], 10)
    now = {r.doc_id: r.text for r in after}
    for r in before:
        n_words, n_hit, *_ = scanned(r.text, table)
        if not n_hit:
            assert now[r.doc_id] == r.text
        elif n_hit > 0.5 * n_words:
            assert r.doc_id not in now
        else:
            assert scanned(now[r.doc_id], table)[1] < n_hit


def test_documents_are_mixed(stages):
    before, after = stages["mixing"]
    want = {r.doc_id: r.taken // r["size"] for r in mixing.report(before).collect() if r.taken}
    assert {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()} == want


def test_tokens_are_those_of_the_mix(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before, after = (t.collect() for t in stages["token_files"])
    want, start = [], 0
    for r in sorted(before, key=lambda r: r.doc_id):
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, after)) == want


def test_run_is_the_stages_one_after_the_other(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["token_files"][1].collect()))


def test_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, FOLDER)
    assert docs.count() == 0
