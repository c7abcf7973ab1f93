"""License notices and benchmark passages against brute force."""

import hashlib
import math
import re

import pytest

from ordlog.llm import decontamination, licenses
from tests.llm.conftest import small

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(low)


def windows(items, n):
    out = {}
    for name, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            out.setdefault(tuple(w[i : i + n]), set()).add(str(name))
    return out


def brute(text, table):
    w, hit, items = words_of(text), set(), set()
    for i in range(len(w)):
        for size in {len(k) for k in table}:
            who = table.get(tuple(w[i : i + size])) if i + size <= len(w) else None
            if who:
                items |= who
                hit.update(range(i, i + size))
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


def check(spark, docs, items, **options):
    table = windows([(r.item_id, r.text) for r in items.collect()], options.get("window", 10))
    got = sorted(map(tuple, decontamination.report(docs, items, **options).collect()), key=repr)
    want = sorted(((r.doc_id, *brute(r.text, table)) for r in docs.collect()), key=repr)
    assert got == want
    return got


def test_real_documents(spark, real):
    got = check(spark, real, spark.read.parquet(small("benchmark")))
    assert any(r[5] for r in got)


@pytest.mark.parametrize("block_words", [1, 5, 1000])
def test_short_items_overlaps_and_blocks(spark, docs, block_words):
    items = spark.createDataFrame(
        [
            ("1", "a b c d"),
            ("2", "b c d e f"),
            ("3", "Q!"),
            ("4", "c d"),
            ("5", None),
            ("6", "..."),
            ("7", "a b c d"),
            ("8", "d a b a b a b"),
            (None, "x y z"),
        ],
        "item_id string, text string",
    )
    items = items.filter("item_id is not null")
    texts = ["a b c d e f g", "x b c d", "q", "A. B, c; D", "a b a b a b c d a b a", "", None, "d a b a b", "c", "e f c d q q"]
    check(spark, docs(texts), items, window=4, block_words=block_words)
    check(spark, docs(texts), items, window=3, block_words=block_words)


def test_random_sequences(spark, docs):
    import random

    rng = random.Random(3)
    line = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = spark.createDataFrame([(i, line(rng.randint(1, 9))) for i in range(12)], "item_id int, text string")
    check(spark, docs([line(rng.randint(0, 40)) for _ in range(60)]), items, window=5)


def test_nasty_rows_and_names_in_the_way(spark, nasty, none):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog today"), (None, "x")], "item_id int, text string")
    named = nasty.withColumnRenamed("n_chars", "found")
    got = decontamination.report(named, items)
    assert got.count() == nasty.count() and got.filter("contaminated").count() == 2
    assert decontamination.report(none, items).count() == 0
    assert decontamination.report(nasty, items.limit(0)).filter("n_hit > 0").count() == 0


@pytest.mark.parametrize("block_words", [1, 1000])
def test_items_with_a_null_id_are_hit_and_cut_but_not_named(spark, docs, block_words):
    long = "one two three four five six"
    items = spark.createDataFrame([(None, long), (None, "x y"), ("7", "p q r"), (None, "p q r")], "item_id string, text string")
    texts = [f"a {long} b", "a b x y c", "p q r s t u v", "a b c", "one two three"]
    got = sorted(map(tuple, decontamination.report(docs(texts), items, window=4, block_words=block_words).collect()))
    sha = lambda names: hashlib.sha256(names.encode()).hexdigest()
    assert got == [
        (0, 8, 6, 0, sha(""), True),
        (1, 5, 2, 0, sha(""), True),
        (2, 7, 3, 1, sha("7"), True),
        (3, 3, 0, 0, sha(""), False),
        (4, 3, 0, 0, sha(""), False),
    ]
    cut = decontamination.decontaminate(docs(texts), items, window=4, block_words=block_words, max_coverage=0.9)
    assert {r.doc_id: r.text for r in cut.collect()} == {0: "a  b", 1: "a b  c", 2: " s t u v", 3: "a b c", 4: texts[4]}


def test_one_automaton_at_a_time(spark, docs):
    """Each block is a pass of its own: no task runs the workers of two."""
    items = spark.createDataFrame([(i, f"item {i} has some words of its own") for i in range(6)], "item_id int, text string")
    texts = docs([f"x item {i} has some words of its own y" for i in range(5)] + ["", None, "clean"])
    for run in (decontamination.find, decontamination.decontaminate):
        plan = run(texts, items, block_words=8)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1
    many = decontamination.report(texts, items, block_words=8).collect()
    assert sorted(many) == sorted(decontamination.report(texts, items).collect())
    assert sum(r.contaminated for r in many) == 5


def test_null_ids_agree_with_the_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from ordlog.llm import queries

    # every third item has no id; the hits are those of all
    items = spark.read.parquet(small("benchmark")).selectExpr("if(item_id % 3 = 0, null, item_id) as item_id", "text")
    items.write.parquet(str(tmp_path / "benchmark"))
    items, texts = spark.read.parquet(str(tmp_path / "benchmark")), spark.read.parquet(small("documents"))
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{small('documents')}'")
    connection.execute(f"create view benchmark as select * from '{tmp_path}/benchmark/*.parquet'")
    want = connection.execute(queries.SQL["op6_decontamination"]).fetchall()
    assert sorted(map(tuple, decontamination.report(texts, items).collect()), key=repr) == sorted(want, key=repr)
    assert any(r[5] and not r[3] for r in want)


def test_cutting(spark, docs):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id int, text string")
    texts = [
        "clean text stays as it is, Ünïcode too",
        "before " * 20 + "One, two three four five six seven eight nine TEN." + " after" * 20,
        "one two three four five six seven eight nine ten",
        None,
        "",
    ]
    kept = {r.doc_id: r.text for r in decontamination.decontaminate(docs(texts), items).collect()}
    assert kept == {0: texts[0], 1: "before " * 20 + "." + " after" * 20, 3: None, 4: ""}


# --- licenses --------------------------------------------------------------------------


def scan(text, templates, phrases, threshold):
    w = words_of(text)
    places, base = [], set()
    for phrase, label in phrases.items():
        p = words_of(phrase)
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    labels, best = set(), 0.0
    lines = [set(words_of(line)) for line in (text or "").split("\n")]
    for i, have in enumerate(lines):
        for more in lines[i + 1 : i + 3]:
            if not have or not more:
                break
            have = have | more
        for label, template in templates:
            need = set(words_of(template))
            if len(have & need) >= math.ceil(threshold * len(need) - 1e-9):
                labels.add(label)
                best = max(best, len(have & need) / len(need))
    labels |= base
    return (
        len(w),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        1.0 if places else best,
    )


# Notices as their files wrap them.
WRAPPED = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction""",
    "bsd": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:""",
    "mpl-2": """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */""",
}


@pytest.mark.parametrize("label", list(WRAPPED))
@pytest.mark.parametrize("width", [None, 50, 120])
def test_wrapped_notices(docs, label, width):
    import textwrap

    text = WRAPPED[label]
    if width:
        text = textwrap.fill(" ".join(text.split()), width)
    texts = [text, f"some prose\nbefore it\n{text}\nand after it", text.replace("\n", "\r\n")]
    assert [r.labels for r in licenses.report(docs(texts)).collect()] == [label] * 3


@pytest.mark.parametrize("threshold", [0.5, 0.8, licenses.THRESHOLD])
def test_licenses_of_real_and_made_up_documents(spark, real, docs, threshold):
    made = docs(
        [
            "Licensed under the Apache License, Version 2.0.\nother",
            "apache license\nversion 2 across lines",
            "work is licensed under the GNU General Public License version 3",
            "CC BY-NC cc by nc CC-BY-NC-4.0",
            "under the MIT license under the mit license",
            "mit license the under released",
            "Permission is hereby granted free of charge to any person obtaining a copy of this",
            "",
            None,
            *WRAPPED.values(),
            "released\nunder\n\nthe\nmit\nlicense",
            "a\nreleased under\n--\nthe mit license",
            "released under\nthe mit\nlicense\n\nLicensed under\nCC BY-NC 4.0",
        ]
    )
    for table in (real, made):
        got = sorted(map(tuple, licenses.report(table, threshold=threshold).collect()), key=repr)
        want = [(r.doc_id, *scan(r.text, licenses.TEMPLATES, licenses.PHRASES, threshold)) for r in table.collect()]
        assert got == sorted(want, key=repr)


def test_licenses_of_nasty_rows(nasty, none):
    got = licenses.report(nasty.withColumnRenamed("n_chars", "found"))
    assert got.count() == nasty.count() and got.filter("labels <> ''").count() == 0
    assert licenses.report(none).count() == 0
    assert licenses.report(nasty, templates=[], phrases={}).filter("score > 0").count() == 0
