import re
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ordlog.llm import token_counts
from ordlog.llm.token_counts import Rollup, deletes, inserts, revisions


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}


@pytest.fixture
def rows(spark):
    data = [("a", "en", 3, 4), ("a", "en", 5, 5), (None, "de", 7, None), ("b", None, None, 2)]
    return spark.createDataFrame(data, "source string, lang string, n int, m int")


def test_signed_changes_add_up(spark, rows, root):
    r = Rollup(spark, root)
    assert totals(r) == {}
    assert r.commit("one", inserts(rows, F.col("n"), "t1"))
    assert totals(r) == {("a", "en", "t1"): (2, 8), (None, "de", "t1"): (1, 7), ("b", None, "t1"): (1, 0)}
    assert r.commit("two", revisions(rows, F.col("n"), F.col("m"), "t1"))
    assert totals(r) == {("a", "en", "t1"): (2, 9), (None, "de", "t1"): (1, 0), ("b", None, "t1"): (1, 2)}
    assert r.commit("three", deletes(rows.filter("source is null"), F.col("m"), "t1"), inserts(rows.limit(0), F.col("n"), "t2"))
    assert totals(r) == {("a", "en", "t1"): (2, 9), ("b", None, "t1"): (1, 2)}


def test_a_batch_counts_once(spark, rows, root):
    r = Rollup(spark, root)
    change = inserts(rows, F.col("n"), "t")
    assert r.commit("b", change) and not r.commit("b", change) and not r.commit("b", change, change)
    once = totals(r)
    r.compact()
    assert not r.commit("b", change) and totals(r) == once
    assert r.commit("c", change) and totals(r)["a", "en", "t"] == (4, 16)


def test_a_commit_that_died_leaves_nothing(spark, rows, root):
    r = Rollup(spark, root)
    r.commit("b", inserts(rows, F.col("n"), "t"))
    before = totals(r)
    broken = rows.withColumn("n", F.when(F.col("source") == "b", F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        r.commit("c", inserts(broken, F.col("n"), "t"))
    assert totals(r) == before and r.committed() == {"b"}
    assert r.commit("c", inserts(rows, F.col("n"), "t"))


def test_compaction_changes_nothing(spark, rows, root):
    r = Rollup(spark, root)
    for k in range(3):
        r.commit(f"b{k}", inserts(rows, F.col("n"), f"t{k}"))
    before = totals(r)
    r.compact()
    assert totals(r) == before  # the old folders are still there
    r.commit("b3", deletes(rows, F.col("n"), "t0"))
    r.compact()
    r.sweep()
    assert totals(r) == {k: v for k, v in before.items() if k[2] != "t0"}
    assert r.committed() == {"b0", "b1", "b2", "b3"}


def test_revisions_move_documents(spark, rows, root):
    r = Rollup(spark, root)
    r.commit("one", inserts(rows, F.col("n"), "t"))
    moved = rows.filter("source = 'a'")
    r.commit("two", revisions(moved, F.col("n"), F.col("m"), "t", new_source=F.lit("z"), new_lang=F.when(F.col("n") == 3, F.col("lang"))))
    assert totals(r) == {("z", "en", "t"): (1, 4), ("z", None, "t"): (1, 5), (None, "de", "t"): (1, 7), ("b", None, "t"): (1, 0)}
    r.commit("three", revisions(rows.filter("source = 'b'"), F.lit(None).cast("int"), F.col("m"), "t"))
    assert totals(r)["b", None, "t"] == (1, 2)


def test_a_batch_that_comes_while_others_are_compacted_counts_once(spark, rows, root, monkeypatch):
    r = Rollup(spark, root)
    r.commit("one", inserts(rows, F.col("n"), "t"))
    other, real, done = Rollup(spark, root), r._listed, []

    def listed():
        names = real()
        if not done:  # another writer commits after the first look at the folder
            done.append(other.commit("two", inserts(rows, F.col("m"), "t")))
        return names

    monkeypatch.setattr(r, "_listed", listed)
    r.compact()
    assert done == [True]
    want = {("a", "en", "t"): (4, 17), (None, "de", "t"): (2, 7), ("b", None, "t"): (2, 2)}
    assert totals(r) == want
    r.sweep()
    assert totals(r) == want and r.committed() == {"one", "two"}
    r.compact()
    r.sweep()
    assert totals(r) == want and r.committed() == {"one", "two"}


# --- the counts of a corpus ------------------------------------------------------------

VERSION = "word_bpe_49k"
PATH = public_tokenizers.path(f"{VERSION}.json")


def brute(rows):
    """Totals by counting what is left of the corpus in the end."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    last = lambda x: (x is None, x or "")
    filed = []
    for doc_id, text, lang, source in rows:
        words = len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or ""))
        filed.append((doc_id, text, "und" if words < 20 else lang, source, words))
    filed.sort(key=lambda r: (r[0] is None, r[0] or 0, last(r[3]), last(r[2])))
    seen, out = set(), defaultdict(lambda: [0, 0])
    for _, text, lang, source, words in filed:
        if text is not None and text in seen:
            continue
        seen.add(text)
        tokens = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        for name, n in ((VERSION, tokens), ("words", words)):
            out[source, lang, name][0] += 1
            out[source, lang, name][1] += n
    return {k: tuple(v) for k, v in out.items()}


def maintained(df, root, **columns):
    got = token_counts.maintained(df, root, PATH, VERSION, **columns).collect()
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in got}


def test_real_documents(real, root):
    assert maintained(real, root) == brute([(r.doc_id, r.text, r.lang, r.source) for r in real.collect()])


def test_nasty_documents(spark, nasty, none, root):
    tokens = ["a <|endoftext|> b " * 9, "<|startoftext|>", "x" * 500, "one two " * 40, "one two " * 40, "one two " * 40]
    more = spark.createDataFrame([(None if i > 2 else i, t, "en", None if i == 4 else "q", 0) for i, t in enumerate(tokens)], nasty.schema)
    every = nasty.unionByName(more)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in every.collect()]
    assert maintained(every, f"{root}/a") == brute(rows)
    clash = every.selectExpr("text as words", "doc_id as same", "lang as source", "source as lang", "1 as id", "2 as docs")
    assert maintained(clash, f"{root}/b", doc_id="same", text="words", source="lang", lang="source") == brute(rows)
    assert maintained(none, f"{root}/c") == {}


def test_the_query(spark):
    from ordlog.llm import queries
    from tests.llm.test_queries import FOLDER

    got = queries.QUERIES["op10_token_counts"](spark, FOLDER)
    assert got.columns == ["source", "lang", "tokenizer", "docs", "tokens"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = brute([(r.doc_id, r.text, r.lang, r.source) for r in docs])
    assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in got.collect()} == want
