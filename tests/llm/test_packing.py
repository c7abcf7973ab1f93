"""Packing: pieces of powers of two that cover every document."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ordlog.llm import packing
from tests.llm.test_queries import FOLDER

PATH = public_tokenizers.path("word_bpe_49k.json")
OPTIONS = dict(spaced=True, special=True)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 4095, 4096, 4097, 12_345])
def test_lengths(n):
    got = packing.lengths(n)
    assert sum(got) == n and got == sorted(got, reverse=True)
    assert all(x & (x - 1) == 0 and 0 < x <= 4096 for x in got)
    assert max(Counter(x for x in got if x < 4096).values(), default=0) <= 1


def check(rows, docs, tokenizer):
    """Every id of every document in one piece, each piece a sequence of its own."""
    want = Counter()
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        start = 0
        for size in packing.lengths(len(ids)):
            piece = np.array(ids[start : start + size], "<u4").tobytes()
            want[doc_id, start, size, len(ids), zlib.crc32(piece)] += 1
            start += size
    assert Counter((r.doc_id, r.start, r.length, r.doc_tokens, r.ids_crc32) for r in rows) == want
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    buckets = defaultdict(list)
    for r in rows:
        buckets[r.length].append(r.sequence_id)
        assert r.offset == 0
    begin = 0
    for length in sorted(buckets):
        assert sorted(buckets[length]) == list(range(begin, begin + len(buckets[length])))
        begin += len(buckets[length])


def test_real_documents(real, tokenizer):
    check(packing.report(real.repartition(4), PATH, **OPTIONS).collect(), [(r.doc_id, r.text) for r in real.collect()], tokenizer)


def test_nasty_documents(nasty, tokenizer):
    rows = packing.report(nasty, PATH, **OPTIONS).collect()
    check(rows, [(r.doc_id, r.text) for r in nasty.collect()], tokenizer)
    assert max(r.length for r in rows) == 4096


def test_added_tokens_and_pieces_across_batches(docs, tokenizer, monkeypatch):
    texts = ["a <|endoftext|> b", "", "word " * 9000, None, "<|startoftext|>"]
    table = docs(texts)
    check(packing.report(table, PATH, **OPTIONS).collect(), [(i, t) for i, t in enumerate(texts)], tokenizer)


def test_begins_by_a_shuffle(real, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    check(packing.report(real.repartition(3), PATH, **OPTIONS).collect(), [(r.doc_id, r.text) for r in real.collect()], tokenizer)


def test_sequences_are_written_by_length_and_read_back(spark, real, tmp_path, tokenizer):
    folder = f"{tmp_path}/packed"
    packing.write(packing.pack(real, PATH, **OPTIONS), folder)
    total = 0
    for length in [1, 8, 512, 4096]:
        rows = packing.read(spark, folder, length).collect()
        assert all(len(r.ids) == length for r in rows)
        total += len(rows)
    assert total
    ones = packing.read(spark, folder, 1).collect()
    odd = [r for r in real.collect() if len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) % 2 == 0]
    assert [list(r.ids) for r in ones] == [[2]] * len(odd)  # the end id is the last of a document


def test_other_lengths_names_and_an_empty_table(spark, nasty, none):
    clashing = nasty.selectExpr("text as ids", "doc_id as length", "7 as shard", "8 as nth", "'x' as text")
    got = packing.pack(clashing, PATH, doc_id="length", text="ids", longest=64, **OPTIONS)
    assert got.columns == "sequence_id doc_id start length doc_tokens offset ids".split()
    sizes = {r.length for r in got.collect()}
    assert max(sizes) == 64
    assert packing.report(none, PATH, **OPTIONS).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        packing.cut(nasty, PATH, longest=100)


def test_nothing_is_shuffled_but_counts(real):
    plan = packing.pack(real, PATH, **OPTIONS)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffleExchange" not in plan and "Exchange hashpartitioning" not in plan


def test_the_query(spark, tokenizer):
    from ordlog.llm import queries

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    check(queries.QUERIES["op11_packing"](spark, FOLDER).collect(), [(r.doc_id, r.text) for r in docs], tokenizer)
