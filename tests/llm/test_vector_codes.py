"""Vector codes against a plain computation in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from ordlog.llm import vector_codes
from ordlog.llm.vector_codes import whole

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """vec_id, code, error, label_error of each row, and the digest."""
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole_rows = [[whole(x) for x in v] + [0] * (parts * width - len(v)) for _, v, _ in kept]
    cut = [[r[a : a + width] for a in range(0, parts * width, width)] for r in whole_rows]
    books = [[cut[i][q] for i in range(min(entries, len(cut)))] for q in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for q in range(parts):
            members = {}
            for row in cut:
                members.setdefault(nearest(row[q], books[q])[1], []).append(row[q])
            for e, some in members.items():
                books[q][e] = [sum(c) // len(some) for c in zip(*some)]
    out, sums = [], {}
    for (i, _, label), row in zip(kept, cut):
        found = [nearest(row[q], books[q]) for q in range(parts)]
        error = sum(f[0] for f in found)
        sums[label] = sums.get(label, 0) + error
        out.append((i, "".join(f"{f[1]:02x}" for f in found), error, label))
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    most = (1 << 63) - 1
    over = {label for _, _, e, label in out if e > most}
    sums = {k: None if k in over or v > most else v for k, v in sums.items()}
    return [(i, c, None if e > most else e, sums[label], digest) for i, c, e, label in out]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def vectors(seed, n, d, scale=1.0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, scale) for _ in range(d)] for _ in range(5)]
    return [
        (i, [c + draw.gauss(0, scale / 5) for c in draw.choice(centres)], draw.choice([None, 0, 1, 2]))
        for i in draw.sample(range(10 * n), n)
    ]


def test_real_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(200)
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    got = vector_codes.report(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert ordered(got) == ordered(brute(rows))


@pytest.mark.parametrize("d", [1, 8, 20, 32])
def test_drawn_vectors(spark, d):
    rows = vectors(d, 150, d)
    got = vector_codes.report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert ordered(got) == ordered(brute(rows))


def test_nulls_ties_repeats_and_odd_lengths(spark):
    one = [0.5, -0.25, 1.0, 2.0, -3.0, 0.1, 0.2, 0.3]
    rows = vectors(7, 60, 8)
    rows += [(None, one, 1), (None, None, None), (10_000, None, 1), (10_001, [None] * 8, 2), (10_002, [math.nan] * 8, 1)]
    rows += [(10_003, [math.inf, *one[1:]], 1), (10_004, [], 0), (10_005, one[:3], 0), (10_006, [0.0] * 8, None)]
    rows += [(10_007, one, 3)] * 5 + [(10_008, one, 3)] * 20
    got = vector_codes.report(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert ordered(got) == ordered(brute(rows))


@pytest.mark.parametrize("first", [True, False], ids=["among the first entries", "later"])
def test_components_of_any_size(spark, first):
    rows = vectors(3, 80, 16)
    huge = [1e9, -1e9, 3e18, 1e30, -3.4e38, 1e5, 2.0**53, -(2.0**31)]
    for k, x in enumerate(huge):
        v = list(rows[k][1])
        v[k] = x
        rows.append((-100 + k if first else 100_000 + k, v, 5 + k))
    rows.append((-1 if first else 200_000, [1e160] * 16, 30))
    got = vector_codes.report(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert ordered(got) == ordered(brute(rows))


def test_vectors_all_alike_and_fewer_than_entries(spark):
    for rows in ([(i, [0.1] * 8, 1) for i in range(40)], [(i, [float(i)] * 8, None) for i in range(5)]):
        got = vector_codes.report(spark.createDataFrame(rows, SCHEMA)).collect()
        assert ordered(got) == ordered(brute(rows))


def test_many_labels_go_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_ROWS", 3)
    rows = [(i, v, None if i % 2 else i % 41) for i, v, _ in vectors(5, 120, 8)]
    got = vector_codes.report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert ordered(got) == ordered(brute(rows))


def test_bounds_spare_exact_distances(monkeypatch):
    """Most entries of clustered vectors are ruled out by their bounds."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 4096, (16, 8)).astype(int)
    parts = (centres[rng.integers(0, 16, 5000)] + rng.normal(0, 200, (5000, 8))).astype(np.int64)
    entries = [[int(v) for v in c] for c in centres]
    pivots = vector_codes.pick_pivots(entries)
    far = np.sqrt(((parts[:, None] - np.array(pivots)) ** 2).sum(axis=2)).astype("<f4")
    done = []
    real = np.einsum
    monkeypatch.setattr(vector_codes.np, "einsum", lambda s, a, b: done.append(len(a)) or real(s, a, b))
    entry, square, _ = vector_codes.Codebook(entries, pivots).nearest(parts, far)
    every = ((parts[:, None] - centres) ** 2).sum(axis=2)
    assert (entry == every.argmin(axis=1)).all() and (square == every.min(axis=1)).all()
    assert sum(done) < 0.35 * every.size


def test_other_columns_are_not_in_the_way(spark):
    rows = vectors(9, 40, 8)
    table = spark.createDataFrame(rows, SCHEMA)
    clashing = table.selectExpr("embedding as id", "vec_id as v", "label as code", "1 as error", "2 as x", "3 as vec_id")
    got = vector_codes.report(clashing, vec_id="v", vector="id", label="code").collect()
    assert ordered(got) == ordered(brute(rows))


def test_an_empty_table(spark):
    got = vector_codes.report(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got.collect() == []
    codes, _ = vector_codes.encode(spark.createDataFrame([(1, [0.5] * 8)], "vec_id bigint, embedding array<float>"), label=None)
    assert [r.code for r in codes.collect()] == ["00" * 8]
