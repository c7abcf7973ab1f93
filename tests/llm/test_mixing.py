import re

import pytest

from ordlog.llm import mixing


def rows_of(df):
    return {(r.doc_id, r["size"]): r for r in df.collect()}


def targets(sizes, weights=(3, 1, 2)):
    """Targets by sharing again and again what does not fit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            return out | share
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_sizes_targets_and_what_is_taken(real):
    got = mixing.report(real).collect()
    source = {r.doc_id: r.source for r in real.collect()}
    text = {r.doc_id: r.text for r in real.collect()}
    sizes, taken, most = {}, {}, {}
    for r in got:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id]))
        assert r.taken in (0, r["size"], 2 * r["size"])
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r.taken
        most[s] = max(most.get(s, 0), r["size"])
    want = targets(sizes)
    for r in got:
        assert r.target == pytest.approx(want[source[r.doc_id]]) and r.source_size == sizes[source[r.doc_id]]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= most[s] + max(most.values())
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())


def test_reruns_and_other_splits_agree(real):
    first = {r.doc_id: r.taken for r in mixing.report(real).collect()}
    again = {r.doc_id: r.taken for r in mixing.report(real.repartition(5)).collect()}
    assert first == again


def test_the_mix_repeats_documents_as_reported(real):
    taken = {r.doc_id: r.taken // r["size"] if r["size"] else 0 for r in mixing.report(real).collect()}
    found = {r.doc_id: r["count"] for r in mixing.mixed(real).groupBy("doc_id").count().collect()}
    assert found == {d: n for d, n in taken.items() if n}
    assert mixing.mixed(real).columns == real.columns


def alike(spark):
    """Null ids and repeated ones, of one size or text, in hot groups."""
    rows = [(None, "a b c d", "en", "x", 0)] * 250 + [(7, f"w{i} b c d", "en", "y", 0) for i in range(300)]
    rows += [(8, "e f", "en", "y", 0)] * 40 + [(i, "g " * (1 + i % 9), "en", "z", 0) for i in range(100, 300)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").repartition(5)


def test_rows_alike_are_shared_out(spark):
    docs = alike(spark)
    source = {None: "x", 7: "y", 8: "y"}
    got = mixing.report(docs).collect()
    assert len(got) == docs.count()
    taken = {}
    for r in got:
        taken[source.get(r.doc_id, "z")] = taken.get(source.get(r.doc_id, "z"), 0) + r.taken
    for r in got:
        assert abs(taken[source.get(r.doc_id, "z")] - r.target) <= 20
    again = mixing.report(docs.repartition(2)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    mixed = mixing.mixed(docs).groupBy("source").agg({"*": "count"}).collect()
    words = {"x": 4, "y": None, "z": None}
    assert {r.source for r in mixed} == set(words) and next(r[1] for r in mixed if r.source == "x") * 4 == taken["x"]


def test_rows_alike_without_a_broadcast(spark, monkeypatch):
    docs = alike(spark)
    want = sorted(map(tuple, mixing.report(docs).collect()), key=repr)
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, mixing.report(docs).collect()), key=repr) == want


def test_rows_alike_agree_with_the_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from ordlog.llm import queries

    docs = alike(spark)
    docs.write.parquet(f"{tmp_path}/documents")
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{tmp_path}/documents/*.parquet'")
    want = connection.execute(queries.SQL["op3_source_mix"])
    names = [d[0] for d in want.description]
    got = mixing.report(docs).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)


def test_a_source_that_runs_dry_leaves_its_share_to_the_others(docs):
    small, large = ["a b"] * 2, ["c d e f"] * 40
    got = mixing.report(docs(small + large, source=["a"] * 2 + ["b"] * 40)).collect()
    assert {(r.source_size, r.target) for r in got} == {(4, 8.0), (160, 1.5 * 164 - 8)}


def test_nasty_rows(nasty, none):
    clash = nasty.withColumnRenamed("n_chars", "size").withColumnRenamed("lang", "place")
    got = mixing.report(clash).collect()
    assert len(got) == nasty.count()
    assert all(r.taken <= 2 * r["size"] for r in got)
    assert mixing.mixed(clash).columns == clash.columns
    assert mixing.report(none).count() == 0 and mixing.mixed(none).count() == 0


def test_only_empty_texts(docs):
    assert {(r.target, r.taken) for r in mixing.report(docs(["", None, " "])).collect()} == {(0.0, 0)}


def test_the_main_path_runs_no_python(spark, real):
    for df in (mixing.report(real), mixing.mixed(real)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
