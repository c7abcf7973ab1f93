import random
import signal

import pytest
from pyspark.sql import functions as F

from ordlog.operators import compare, order_check, reconcile

LOG = "topic string, partition int, offset bigint, key_ int"


def _brute(rows, key=lambda k: (k is not None, k)):
    """Plain Python: rows, violations, gapless and the violating rows of each partition."""
    out = {}
    for part in sorted({(t, p) for t, p, _, _ in rows}):
        mine = sorted([(o, k) for t, p, o, k in rows if (t, p) == part], key=lambda r: r[0])
        bad = [(o, a, b) for (_, a), (o, b) in zip(mine, mine[1:]) if key(a) > key(b)]
        offsets = [o for o, _ in mine]
        gapless = offsets == list(range(offsets[0], offsets[0] + len(offsets)))
        out[part] = (len(mine), len(bad), gapless, bad)
    return out


def _log(rng, n, step, nulls):
    rows = []
    for t in ("a", "b"):
        for p in range(2):
            o = rng.randrange(5)
            for i in range(n):
                o += 1 if rng.random() < step else rng.randrange(1, 6)
                k = None if rng.random() < nulls else (i if rng.random() < 0.8 else rng.randrange(n))
                rows.append((t, p, o, k))
    return rows


@pytest.mark.parametrize("width", [2, 3, 7, 100_000])
@pytest.mark.parametrize("step, nulls, shuffled", [(1, 0, False), (1, 0.1, True), (0.5, 0.1, False), (0.9, 0, True)])
def test_reports_agree_with_plain_python(spark, width, step, nulls, shuffled):
    rng = random.Random(hash((width, step)) % 1000)
    rows = _log(rng, 60, step, nulls)
    if shuffled:
        rng.shuffle(rows)
    df = spark.createDataFrame(rows, LOG).repartition(3) if shuffled else spark.createDataFrame(rows, LOG).coalesce(2)
    want = _brute(rows)
    report = order_check.order_report(df, "key_", width=width).collect()
    assert {(r.topic, r.partition): (r.rows, r.violations, r.gapless) for r in report} == {
        k: v[:3] for k, v in want.items()
    }
    found = order_check.first_violations(df, "key_", n=4, width=width).collect()
    got = {k: [] for k in want}
    for r in sorted(found, key=lambda r: r.nth):
        got[(r.topic, r.partition)].append((r.offset, r.before, r.key))
    assert got == {k: v[3][:4] for k, v in want.items()}


def test_long_log_in_small_batches(spark):
    """Runs end at batch edges, which must not hide or double a pair."""
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        df = spark.range(0, 5000, 1, 3).selectExpr("'t' topic", "0 partition", "id offset", "id * 7919 % 5000 k")
        keys = [i * 7919 % 5000 for i in range(5000)]
        bad = [i for i in range(1, 5000) if keys[i - 1] > keys[i]]
        report = order_check.order_report(df, "k", width=50).first()
        assert (report["rows"], report["violations"], report["gapless"]) == (5000, len(bad), True)
        found = order_check.first_violations(df, "k", width=50).orderBy("nth").collect()
        assert [r.offset for r in found] == bad[:3]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


@pytest.mark.parametrize(
    "kind, keys, bad",
    [
        ("string", ["Z", "a", "a", "ab", "b"], 0),
        ("string", ["a", "Z", "b"], 1),
        ("string", ["￿", "\U00010000"], 0),
        ("double", [1.0, 2.0, float("nan"), float("nan")], 0),
        ("double", [1.0, float("nan"), 2.0], 1),
        ("double", [None, 0.0, None], 1),
        ("int", [2, 3, 21, 100], 0),
        ("int", [100, 21, 3], 2),
        ("timestamp_ntz", [None, None], 0),
        ("boolean", [False, True, False], 1),
        ("decimal(10,2)", [None, None], 0),
    ],
)
def test_keys_of_any_type(spark, kind, keys, bad):
    rows = [("t", 0, i, k) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, f"topic string, partition int, offset bigint, k {kind}").coalesce(1)
    assert order_check.order_report(df, "k").first().violations == bad
    for width in (1, 2):
        assert order_check.order_report(df.repartition(3), "k", width=width).first().violations == bad


def test_repeated_and_missing_offsets_are_not_gapless(spark):
    log = lambda offsets: spark.createDataFrame([("t", 0, o, 1) for o in offsets], LOG)
    assert not order_check.order_report(log([0, 1, 1, 2]), "key_").first().gapless
    assert not order_check.order_report(log([0, 1, 1, 3]).repartition(3), "key_", width=2).first().gapless
    assert not order_check.order_report(log([0, 2]), "key_").first().gapless
    assert order_check.order_report(log([5, 6, 7]).repartition(3), "key_", width=2).first().gapless


def test_no_rows(spark):
    empty = spark.createDataFrame([], LOG)
    assert order_check.order_report(empty, "key_").count() == 0
    assert order_check.first_violations(empty, "key_").count() == 0


def test_fingerprint_ignores_order_and_sees_copies(spark):
    df = spark.range(1000).selectExpr("id % 100 a", "cast(id % 7 as string) b")
    assert compare.same_rows(df, df.repartition(5)).first().equal
    one_more = df.union(df.limit(1))
    assert not compare.same_rows(df, one_more).first().equal
    swapped = df.withColumn("a", F.when(F.col("a") == 3, 4).when(F.col("a") == 4, 3).otherwise(F.col("a")))
    assert not compare.same_rows(df, swapped).first().equal
    empty = df.limit(0)
    assert compare.same_rows(empty, empty).first().equal
    assert not compare.same_rows(empty, df).first().equal


def test_fingerprint_equals_hash_sums(spark):
    df = spark.range(3000).selectExpr("cast(id % 50 as string) v")
    got = compare.fingerprint(df, "v").first()
    hashes = [r.h % 2**64 for r in df.select(F.xxhash64("v").alias("h")).collect()]
    assert got.rows == 3000
    for i, quarter in enumerate(compare.QUARTERS):
        assert got[quarter] == sum(h >> 16 * i & 0xFFFF for h in hashes)


def test_multiset_diff(spark):
    df = lambda xs: spark.createDataFrame([(x,) for x in xs], "v string")
    got = compare.multiset_diff(df(["a", "a", "b", None]), df(["a", "c", "b"])).collect()
    assert {(r.v, r.surplus) for r in got} == {("a", 1), ("c", -1), (None, 1)}


def test_domain_diff(spark):
    df = lambda xs: spark.createDataFrame([(x,) for x in xs], "v string")
    got = compare.domain_diff(df(["a", "b", "b"]), "v", df(["b", "c"])).collect()
    assert {(r.value, r.status) for r in got} == {("a", "unexpected"), ("c", "missing")}
    assert compare.domain_diff(df(["b", "c", "c"]), "v", df(["b", "c"])).count() == 0


def test_reconcile(spark):
    out = reconcile.reconcile(spark, {"a": 3, "b": 2}, {"a": 3, "b": 3}, strict=False).orderBy("step").collect()
    assert [(r.stage, r["rows"], r.lost, r.matches_source) for r in out] == [("a", 3, 0, True), ("b", 2, 1, False)]
    with pytest.raises(reconcile.LostRows, match="b has 2 rows instead of 3"):
        reconcile.reconcile(spark, {"a": 3, "b": 2}, {"a": 3, "b": 3})


# --- which rows differ ----------------------------------------------------------------


def _diff(left, right, **options):
    got = sorted(map(tuple, compare.lost_rows(left, right, **options).collect()), key=repr)
    assert got == sorted(map(tuple, compare.multiset_diff(left, right).collect()), key=repr)
    return got


def test_differing_rows_are_named_without_shuffling_rows(spark):
    left = spark.range(0, 5000, 1, 4).selectExpr("id % 1000 as a", "if(id % 7 = 0, null, cast(id as string)) as b", "if(id % 5 = 0, null, 'x') as c")
    extra = spark.createDataFrame([(1, None, "x"), (1, "x", None), (1, "x", None), (None, None, None)], "a long, b string, c string")
    assert _diff(left, left) == []
    assert len(_diff(left, left.filter("a <> 17"))) == 5
    assert sorted(r[3] for r in _diff(left.union(extra), left)) == [1, 1, 2]
    assert sorted(r[3] for r in _diff(left.filter("a <> 3"), left.union(extra).select("a", "b", "c"))) == [-2] + [-1] * 7
    assert _diff(left.limit(0), extra) and _diff(extra, left.limit(0)) and _diff(extra.limit(0), left.limit(0)) == []
    plan = compare.difference_cells(left, extra)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_too_many_differences_take_the_exact_way(spark):
    left = spark.range(0, 3000).selectExpr("id", "'r' as t")
    cells = {r.cell: [r[n] for n in compare.SUMS] for r in compare.difference_cells(left, left.limit(0), bits=6).collect()}
    assert compare.decode(cells, bits=6) is None
    assert len(_diff(left, left.filter("id % 2 = 0"), bits=6)) == 1500
    assert len(_diff(left, left.filter("id % 100 <> 0"), bits=6)) == 30


def test_the_sketch_is_decoded_like_the_engine_made_it(spark):
    rows = spark.range(500).selectExpr("id", "cast(id as string) t")
    hashes = {r[0] % (1 << 64) for r in rows.select(compare.row_hash(rows.columns)).collect()}
    cells = {r.cell: [r[n] for n in compare.SUMS] for r in compare.difference_cells(rows, rows.limit(0)).collect()}
    assert compare.decode(cells) == dict.fromkeys(hashes, 1)


@pytest.fixture
def within():
    """Fails a test that does not end."""

    def late(*_):
        raise TimeoutError("it does not end")

    before = signal.signal(signal.SIGALRM, late)
    yield signal.alarm
    signal.alarm(0)
    signal.signal(signal.SIGALRM, before)


def _sketch(left, right, bits):
    return {r.cell: [r[n] for n in compare.SUMS] for r in compare.difference_cells(left, right, bits).collect()}


@pytest.mark.parametrize("every", [2, 3, 4])
def test_a_sketch_with_too_many_differences_comes_to_an_end(spark, within, every):
    rows = spark.range(6000).selectExpr("id", "cast(id * 7 as string) t")
    cells = _sketch(rows.filter(f"id % {every} <> 0"), rows.filter(f"id % {every} = 0"), 10)
    within(60)
    assert compare.decode(cells, 10) is None


def test_rows_taken_for_one_are_not_put_back_for_ever(within, monkeypatch):
    """Two rows alike in their first cell look like two copies of their mean where no checksum
    tells them apart; the mean's other cells then seem to miss these."""
    monkeypatch.setattr(compare, "_checks_of", lambda h: [0, 0])
    a, b = 5, 5 + (2 << 20) + (2 << 40)
    within(60)
    sums = [2, *[(a >> 16 * q & 0xFFFF) + (b >> 16 * q & 0xFFFF) for q in range(4)], 0, 0]
    assert compare.decode({5: sums}, 4) is None


def test_sums_and_means_of_hashes_are_no_hashes():
    rng, taken = random.Random(5), 0
    for _ in range(2000):
        a, b, c = (rng.getrandbits(48) << 16 | 0x1234 for _ in range(3))
        for signed in (((a, 1), (b, 1)), ((a, 1), (b, 1), (c, -1))):
            n = sum(s for _, s in signed)
            values = [[1, *[h >> 16 * q & 0xFFFF for q in range(4)], *compare._checks_of(h)] for h, _ in signed]
            sums = [sum(s * v[i] for v, (_, s) in zip(values, signed)) for i in range(len(compare.SUMS))]
            taken += n != 0 and compare.decode({0x234: sums}) is not None
            parts = [v // n for v in sums[1:5]]
            if all(v % n == 0 and 0 <= v // n <= 0xFFFF for v in sums[1:5]):
                h = sum(p << 16 * q for q, p in enumerate(parts))
                taken += [v / n for v in sums[5:]] == compare._checks_of(h)
    assert taken == 0


def test_a_sketch_that_is_too_small_is_made_larger(spark, within):
    within(120)
    left = spark.range(3000).selectExpr("id", "'r' as t")
    right = left.filter("id % 2 = 0").union(left.filter("id % 100 = 2"))
    assert compare.decode(_sketch(left, right, 8), 8) is None
    found = compare.differing_hashes(left, right, 8)
    assert sorted(found.values()) == [-1] * 30 + [1] * 1500
    assert len(_diff(left, right, bits=8)) == 1530
    assert compare.differing_hashes(left, right, 5) is None  # too many for eight times as much
    assert len(_diff(left, right, bits=5)) == 1530


def test_where_the_nulls_are_counts(spark):
    a = spark.createDataFrame([(None, "x")], "a string, b string")
    b = spark.createDataFrame([("x", None)], "a string, b string")
    assert not compare.same_rows(a, b).first().equal and compare.same_rows(a, a).first().equal
