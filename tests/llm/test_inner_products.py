import numpy as np
import pytest
from pyspark.sql import functions as F

from ordlog.llm import inner_products
from tests.llm.conftest import small

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, k, every, scale=64):
    good = [
        (i, [inner_products.whole(float(x), scale) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, v in good:
        if q is None or q % every:
            continue
        scores = sorted(((-sum(a * b for a, b in zip(v, c)), i is None, i or 0) for i, c in good if i != q))[:k]
        fits = [-(1 << 63) <= -s < 1 << 63 for s, _, _ in scores]
        out += [(q, r + 1, None if null else i, -s if ok else None) for r, ((s, null, i), ok) in enumerate(zip(scores, fits))]
    return sorted(out, key=repr)


def found(df, k, every, **options):
    got = inner_products.search(df, F.col("vec_id") % every == 0, k=k, **options)
    return sorted(map(tuple, got.collect()), key=repr)


def test_real_vectors(spark):
    df = spark.read.parquet(small("embeddings"))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(df, 20, 20) == brute(rows, 20, 20)


@pytest.mark.parametrize("block", [3, 4096])
def test_lengths_that_differ_and_blocks_of_queries(spark, monkeypatch, block):
    monkeypatch.setattr(inner_products, "QUERY_BLOCK", block)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * 2.0 ** rng.integers(-3, 4)).astype(np.float32).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df, 5, 10) == brute([(i, np.float32(v)) for i, v in rows], 5, 10)


def test_ties_copies_and_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    same = [(i, [0.5, -0.25, 0.0]) for i in range(40)]
    odd = [(50, None), (60, [nan, 0.0, 0.0]), (70, [inf, 0.0, 0.0]), (80, [None, 1.0, 1.0]), (None, [0.5, 0.5, 0.5]), (90, []), (100, [1.0])]
    df = spark.createDataFrame(same + odd, SCHEMA).repartition(3).withColumn("score", F.lit(1)).withColumn("rank", F.lit(2))
    assert found(df, 7, 10) == brute(same + odd, 7, 10)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], SCHEMA)
    assert found(df, 20, 20) == [(0, 1, 1, 32 * 64 + 32 * 128)]
    assert found(df.limit(0), 20, 20) == []
    assert found(df.filter("vec_id = 0"), 20, 20) == []


def test_repeated_ids(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [2.0]), (3, [1.0]), (3, [1.0])], SCHEMA)
    got = found(df, 5, 20)
    assert [r[2] for r in got] == [3, 3, 3, 3] and sorted(r[3] for r in got) == [4096, 4096, 8192, 8192]


@pytest.mark.parametrize("block", [4, 4096])
def test_components_of_any_size(spark, monkeypatch, block):
    monkeypatch.setattr(inner_products, "QUERY_BLOCK", block)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    huge = [1e9, -1e9, 3e18, -3e18, 1e30, -1e200, 1.7e308, 2.0**53, 1e9, 3e18]
    for i, x in enumerate(huge):
        v = rng.normal(size=5).tolist()
        v[i % 5] = x
        rows.append((100 + 5 * i, v))
    rows += [(200, [3e18] * 5), (201, [3e18] * 5), (202, [3e18, 3e18, 3e18, 3e18, 3e18 * (1 + 2.0**-52)]), (None, [1e9] * 5), (203, [-1e308] * 5), (210, [1e308] * 5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    for k in (1, 7, 100):
        assert found(df, k, 10) == brute(rows, k, 10)


def test_large_vectors_only(spark):
    df = spark.createDataFrame([(0, [3e18]), (1, [1e9]), (20, [1.0])], SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(df, 5, 20) == brute(rows, 5, 20)
    some = df.filter("vec_id < 20")
    assert found(some, 5, 20) == brute(rows[:2], 5, 20)


def test_most_large_candidates_are_ruled_out_without_integers(monkeypatch):
    rng = np.random.default_rng(7)
    packed = [(1e9 * rng.normal(size=8)).astype("<f8").tobytes() for _ in range(500)]
    asked = [rng.integers(-60, 60, 8).astype("<f8").tobytes() for _ in range(10)]

    class Shared:
        value = list(range(10)), np.arange(10) + 1000, asked, [False] * 10, 8

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(500), pa.int64()), "x": packed, "large": [True] * 500})
    done = []
    real = inner_products._Exact.ints
    monkeypatch.setattr(inner_products._Exact, "ints", lambda self, i: done.append(i) or real(self, i))
    out = pa.Table.from_batches(list(inner_products._search_exactly(Shared, 5, 64)([batch])))
    assert out.num_rows == 50 and len(done) < 10 * 7
