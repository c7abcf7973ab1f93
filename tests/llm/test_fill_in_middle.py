"""Fill-in-the-middle: the boundary set against plain lists, forms against a brute force."""

import hashlib
import re

import numpy as np
import pytest

from ordlog.llm import fill_in_middle as fim
from tests.llm.conftest import LONG

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def raw(text):
    return np.frombuffer(text.encode(), np.uint8)


def offsets(text):
    out = [0]
    for u in UNIT.findall(text):
        out.append(out[-1] + len(u.encode()))
    return out


TEXTS = [
    "",
    "a",
    "one two",
    "naïve café 東京 🙂 I'm",
    "\n\n..a",
    "x" * 200_000,  # two stretches without a boundary
    "." * 70_000,  # one run
    "ab " * 50_000,  # bitmaps
    ("word " * 20 + "." * 300) * 300,  # runs and singles
    "é" * 40_000 + "b" * 65_536 + ".",
    "a" * 65_535 + "b",
    "a" * 65_536,
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_every_boundary_is_found(text):
    found, want = fim.Boundaries(raw(text)), offsets(text)
    assert len(found) == len(want)
    some = range(len(want)) if len(want) < 3000 else [*range(0, len(want), 997), len(want) - 1]
    assert [found.select(k) for k in some] == [want[k] for k in some]


def test_containers_are_of_the_smallest_kind():
    kinds = lambda text: {c.kind for c in fim.Boundaries(raw(text)).containers}
    assert kinds("some words of a text") == {fim.ARRAY}
    assert kinds("." * 60_000) == {fim.RUNS}
    assert kinds("ab " * 21_000) == {fim.BITMAP}


@pytest.mark.parametrize("members", [[0], [65_535], [*range(65_536)], [*range(0, 65_536, 2)], [5, 6, 7, 9, 40_000]])
def test_select_in_each_container(members):
    held = fim.Container.of(np.array(members))
    assert [held.select(k) for k in range(len(members))] == members


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def key(row):
    return repr(row)


def test_forms_and_cuts(spark):
    texts = [None, "a<P>b", "a<S", "S>b <", "<<M>", "P>S>M>", *TEXTS, LONG, "東京" * 9, "two words", "\r\n\t \x00"]
    rows = [(100 * k + i, t) for k in range(12) for i, t in enumerate(texts) if k < 2 or t is None or len(t) < 1000]
    rows += [(None, "no id"), (1, "again"), (1, "again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = [tuple(r) for r in fim.transformed(docs).collect()]
    assert sorted(got, key=key) == sorted((brute(*r) for r in rows), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = fim.transformed(docs).select("doc_id", fim.restored().alias("text")).collect()
    assert sorted(map(tuple, back), key=key) == sorted(((d, t or "") for d, t in rows), key=key)


def test_real_documents(real):
    want = [brute(r.doc_id, r.text) for r in real.collect()]
    assert sorted(map(tuple, fim.transformed(real).collect()), key=key) == sorted(want, key=key)


def test_other_columns_are_not_in_the_way(spark, nasty, none):
    clashing = nasty.selectExpr("text as output", "doc_id as n", "1 as form", "2 as h1", "'x' as text", "3 as prefix_chars")
    got = fim.report(clashing, doc_id="n", text="output").collect()
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, fim.report(nasty).collect()), key=key)
    assert len(got) == nasty.count()
    assert fim.report(none).columns == "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256".split()
    assert fim.report(none).collect() == []
