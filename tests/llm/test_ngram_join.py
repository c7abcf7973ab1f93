"""The Jaccard join against brute force, by every way it can take."""

import random
import re

import pytest

from ordlog.llm import ngram_join
from ordlog.llm.components import components
from ordlog.llm.ngram_join import Limits

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").encode().lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all different sets."""
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(shingles(text), []).append(doc_id)
    sets = {s: min((d for d in ids if d is not None), default=None) for s, ids in sets.items() if s}
    names = list(sets)
    parent = list(range(len(names)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        for j, b in enumerate(names[:i]):
            common = len(a & b)
            if 100 * common >= 75 * (len(a) + len(b) - common):
                parent[top(i)] = top(j)
    least = {}
    for i, s in enumerate(names):
        if sets[s] is not None:
            least[top(i)] = min(least.get(top(i), sets[s]), sets[s])
    of = {s: least.get(top(i)) for i, s in enumerate(names)}
    out = [(d, len(shingles(t)), of[shingles(t)] if shingles(t) else d) for d, t in rows]
    return sorted(out, key=repr)


def check(table, **limits):
    rows = [(r.doc_id, r.text) for r in table.collect()]
    got = ngram_join.report(table, limits=Limits(**limits))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    return got


def family(rng, size, words, edits):
    """Copies of a text with some words changed, each change a text of its own."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out = []
    for words, edits in ((60, 4), (200, 9), (9, 1), (30, 2)):
        out += family(rng, 25, words, edits)
    passage = " ".join(f"p{i}" for i in range(60))  # in many documents that are not alike
    out += [f"{' '.join(f'x{rng.randrange(10**6)}' for _ in range(rng.randrange(5, 90)))} {passage}" for _ in range(30)]
    out += ["one two three", "one two three", "one two three four", "a b c d e", "A b C d E", "", None, "  ", "x"]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(
    "limits",
    [
        {},
        {"frequent": 2, "few": 2, "compared": 3, "salt_rows": 4, "bucket": 50, "hot_share": 1000, "hot_least": 5},
        {"frequent": 4, "few": 5, "compared": 16, "salt_rows": 8},
        {"frequent": 10**6, "few": 3, "compared": 4},
        {"frequent": 3, "few": 10**6, "hot_share": 1, "hot_least": 10**6},
    ],
)
def test_families_passages_and_short_texts(docs, texts, limits):
    check(docs(texts), **limits)


def test_random_texts_of_few_words(docs):
    rng = random.Random(5)
    some = [" ".join(rng.choice("ab") for _ in range(rng.randrange(0, 14))) for _ in range(80)]
    check(docs(some), frequent=3, few=3, compared=8, salt_rows=16)


def test_the_threshold_is_exact(docs):
    base = [f"w{i}" for i in range(34)]  # 30 shingles
    longer = lambda n: " ".join(base + [f"z{i}" for i in range(n)])
    got = check(docs([longer(0), longer(10)]))  # 30 of 40
    assert got.select("component_id").distinct().count() == 1
    got = check(docs([longer(0), longer(11)]))  # 30 of 41
    assert got.select("component_id").distinct().count() == 2


def test_nasty_rows(nasty, none):
    clash = nasty.withColumnRenamed("n_chars", "n").withColumnRenamed("lang", "component_id")
    check(clash)
    assert ngram_join.report(none).count() == 0 and ngram_join.deduplicated(none).count() == 0
    kept = ngram_join.deduplicated(clash)
    assert kept.columns == clash.columns
    rows = kept.collect()
    texts = [r.text for r in rows if r.text and r.text.strip()]
    assert len(texts) == len(set(texts)) and {1, 2, 3, 4, 6, 8} <= {r.doc_id for r in rows}
    assert sum(r.doc_id == 7 for r in rows) == 2  # two texts under one id
    assert [r.text for r in rows if r.doc_id is None] == [None]  # the other has its like with an id


def test_one_document_of_each_group_stays(docs, texts):
    table = docs(texts)
    want = {d for d, _, c in brute([(r.doc_id, r.text) for r in table.collect()]) if d == c}
    kept = [r.doc_id for r in ngram_join.deduplicated(table).collect()]
    assert sorted(kept) == sorted(want)


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(60)]
    rng.shuffle(chain)
    star = [(1000, 1000 + i) for i in range(1, 50)] + [(1001, 1001)]
    pairs = [(2000 + rng.randrange(40), 2000 + rng.randrange(40)) for _ in range(25)]
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in chain + star + pairs + pairs[:3]]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    assert got == {x: top(x) for x in {n for a, b in edges if a != b for n in (a, b)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def looked_at(monkeypatch):
    """How many pairs of blocks the join compares."""
    seen = []
    real = ngram_join.stage

    def counted(df, label):
        out = real(df, label)
        if label == "met":
            seen.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stage", counted)
    return seen


def test_a_passage_that_many_share_costs_no_look_at_each_pair(spark, monkeypatch):
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} {' '.join(f'x{rng.randrange(10**9)}' for _ in range(13))}" for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    seen = looked_at(monkeypatch)
    got = ngram_join.report(docs).collect()
    assert all(r.component_id == r.doc_id and r.n_shingles == 69 for r in got) and len(got) == 3000
    assert sum(seen) == 0


def test_few_documents_make_few_blocks(spark, monkeypatch):
    """Five hundred documents of one passage that is just short of enough: a strip of few blocks."""
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} {' '.join(f'x{rng.randrange(10**9)}' for _ in range(4 + 6 * (i % 2)))}" for i in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    seen = looked_at(monkeypatch)
    got = ngram_join.report(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(list(enumerate(texts)))
    assert sum(seen) <= 20
