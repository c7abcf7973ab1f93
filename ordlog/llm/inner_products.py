"""Exact search for the largest inner products.

Vectors are scaled and rounded down to integers, so scores are exact. Candidates are
processed by descending length. With the axes turned by the singular vectors of all
candidates, most of a product comes from the first axes; by Cauchy-Schwarz the rest is at
most the product of the lengths of what remains. A candidate is passed over when

    lengths' product                        < k-th best score so far   (whole blocks)
    product on the first axes + the bound   < k-th best score so far

and scored exactly otherwise. A query starts with the k-th best score among the longest
vectors, so every task prunes from its first block on.

Queries are taken ``QUERY_BLOCK`` at a time, each block broadcast to the tasks that hold the
candidates: no join, and the memory of a task does not grow with the queries. Each task
hands on at most k candidates a query. The d x d matrix of products of components is summed
by Spark from one such matrix a task.

Vectors so long that floating point could not hold their products exactly (components beyond
about 2**26 / sqrt(d) after scaling) are kept apart, as queries and as candidates. Products
with them are bounded in floating point, with the rounding's own bound, and where that
leaves a candidate among the k best it is computed in unbounded integers. A score beyond 64
bits is null; its row has the rank of the exact score.

Vectors that are null or have a null, NaN or infinite component take no part, as query or
as candidate; a query left out has no rows. Rows of a null id are no queries, and as
candidates come after all others of their score. Vectors of different lengths are compared
as if the shorter ended in zeros. Rows that repeat an id are candidates of their own, and a
query for each; a query's own id is no candidate. Fewer candidates than k give as many rows,
an empty table none. Ties go to smaller ids. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordlog import workspace
from ordlog.llm.shared import stage, tidy
from ordlog.operators import segments

SCALE = 64
K = 20
QUERY_BLOCK = 4096
BLOCK = 1024  # candidates scored at once
SEEDS = 2048  # of the longest vectors, for the first bounds
HEAD = 4  # one axis in so many comes before the bound is looked at
_EXACT = float(1 << 53)
_NO_ID = 2**63 - 1  # sorts last


_VECTORS = "id bigint, asked boolean, large boolean, square double, x binary"


def _scaled(scale: int):
    """Integer components of the rows that take part; of large ones the vector as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for one, asked, value in zip(batch.column("id").to_pylist(), batch.column("asked").to_pylist(), batch.column("v")):
                if value.values is None or value.values.null_count:
                    continue
                raw = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(raw).all():
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(scale * raw)
                    square = float(x @ x)
                large = not square * 2 <= _EXACT
                rows.append((one, asked, large, square, (raw if large else x).astype("<f8").tobytes()))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = pa.int64(), pa.bool_(), pa.bool_(), pa.float64(), pa.binary()
            names = ["id", "asked", "large", "square", "x"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return tidy(run)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    out = np.zeros((len(column), d))
    for i, x in enumerate(column):
        x = np.frombuffer(x.as_buffer(), "<f8")
        out[i, : len(x)] = x
    return out


def _gram(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                x = _matrix(batch.column("x").slice(a, 4096), d)
                total += x.T @ x
        yield pa.RecordBatch.from_pydict({"cell": np.arange(d * d), "value": total.ravel()})

    return tidy(run)


def axes(scaled: DataFrame, d: int) -> np.ndarray:
    """Right singular vectors of all candidates as columns, largest singular value first."""
    cells = scaled.select("x").mapInArrow(_gram(d), "cell bigint, value double")
    gram = np.zeros(d * d)
    for cell, value in cells.groupBy("cell").agg(F.sum("value")).collect():
        gram[cell] = value
    return np.linalg.eigh(gram.reshape(d, d))[1][:, ::-1]


class Best:
    """The k best candidates of each query so far; ties go to smaller ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), _NO_ID)

    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some queries with candidates in id order; -inf is no candidate."""
        k = min(self.k, score.shape[1])
        # the k-th largest score, and of those equal to it the first ones
        cut = np.partition(score, -k, axis=1)[:, -k][:, None]
        above, equal = score > cut, score == cut
        room = k - above.sum(axis=1, keepdims=True)
        taken = (above | (equal & (np.cumsum(equal, axis=1) <= room))) & (score > -np.inf)
        row, column = np.nonzero(taken)
        at = np.concatenate([[0], np.cumsum(taken.sum(axis=1))])
        new_score = np.full((len(rows), k), -np.inf)
        new_id = np.full((len(rows), k), _NO_ID)
        place = np.arange(len(row)) - at[row]
        new_score[row, place] = score[row, column]
        new_id[row, place] = ids[column]
        all_score = np.concatenate([self.score[rows], new_score], axis=1)
        all_id = np.concatenate([self.id[rows], new_id], axis=1)
        order = np.lexsort((all_id, -all_score), axis=1)[:, : self.k]
        self.score[rows] = np.take_along_axis(all_score, order, axis=1)
        self.id[rows] = np.take_along_axis(all_id, order, axis=1)


def _own_out(score: np.ndarray, query_ids: np.ndarray, ids: np.ndarray) -> None:
    """A query's own id is no candidate of it."""
    order = np.argsort(ids, kind="stable")
    low = np.searchsorted(ids[order], query_ids, "left")
    high = np.searchsorted(ids[order], query_ids, "right")
    for q in np.flatnonzero(high > low).tolist():
        score[q, order[low[q] : high[q]]] = -np.inf


_FOUND = "at bigint, query_id bigint, vec_id bigint, score bigint, rough double, digits string"


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, query_ids, queries, least, turn = shared.value
        d = queries.shape[1]
        head = max(1, d // HEAD)
        turned = queries @ turn
        length = np.sqrt((queries**2).sum(axis=1))
        rest = np.sqrt(np.maximum((turned[:, head:] ** 2).sum(axis=1), 0))
        best = Best(len(query_ids), k)
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                ids = batch.column("id").slice(a, BLOCK).fill_null(_NO_ID).to_numpy()
                x = _matrix(batch.column("x").slice(a, BLOCK), d)
                order = np.argsort(ids, kind="stable")
                ids, x = ids[order], x[order]
                norm = np.sqrt((x**2).sum(axis=1))
                # rounding of the turned vectors must not prune a candidate
                slack = 1e-9 * (1 + length * norm.max(initial=0))
                bound = np.maximum(best.least(), least) - slack
                rows = np.flatnonzero(length * norm.max(initial=0) >= bound)
                if not len(rows):
                    continue
                y = x @ turn
                most = turned[rows, :head] @ y[:, :head].T
                most += rest[rows, None] * np.sqrt((y[:, head:] ** 2).sum(axis=1))
                hopeful = most >= bound[rows, None]
                some, columns = hopeful.any(axis=1), hopeful.any(axis=0)
                if not some.any():
                    continue
                rows, hopeful = rows[some], hopeful[some][:, columns]
                score = queries[rows] @ x[columns].T  # whole numbers below 2**53
                score[~hopeful | (score < least[rows, None])] = -np.inf
                _own_out(score, query_ids[rows], ids[columns])
                best.add(rows, score, ids[columns])
        row, column = np.nonzero(best.score > -np.inf)
        yield pa.RecordBatch.from_pydict(
            {
                "at": pa.array(numbers[row], pa.int64()),
                "query_id": pa.array(query_ids[row], pa.int64()),
                "vec_id": pa.array(best.id[row, column], pa.int64()),
                "score": pa.array(best.score[row, column].astype(np.int64), pa.int64()),
                "rough": pa.array(best.score[row, column], pa.float64()),
                "digits": pa.array([""] * len(row), pa.string()),
            }
        )

    return tidy(run)


# --- vectors that floating point does not hold -------------------------------------------


def whole(x: float, scale: int = SCALE) -> int:
    """The scaled component, rounded down, exactly."""
    over, under = float(x).as_integer_ratio()
    return over * scale // under


class _Exact:
    """Some vectors as floating point numbers, nearly, and as integers, exactly."""

    def __init__(self, packed: list[bytes], large: list[bool], d: int, scale: int):
        self.raw, self.large, self.scale = [np.frombuffer(x, "<f8") for x in packed], large, scale
        self.near = np.zeros((len(packed), d))
        with np.errstate(over="ignore"):
            for i, (x, far) in enumerate(zip(self.raw, large)):
                self.near[i, : len(x)] = np.floor(scale * x) if far else x
        self.held: dict[int, list[int]] = {}

    def ints(self, i: int) -> list[int]:
        if i not in self.held:
            x = self.raw[i].tolist()
            self.held[i] = [whole(v, self.scale) for v in x] if self.large[i] else [int(v) for v in x]
        return self.held[i]


def _rough(score: int) -> float:
    """In the order of the scores, though different ones may share a number."""
    try:
        return float(score)
    except OverflowError:
        return math.inf if score > 0 else -math.inf


def _digits(score: int) -> str:
    """Text in the order of the scores that share a ``_rough`` number, the smallest first."""
    if abs(score) < _EXACT:
        return ""
    text = str(abs(score))
    if score > 0:
        return f"{len(text):05d}{text}"
    return f"{99999 - len(text):05d}" + "".join(str(9 - int(c)) for c in text)


def _search_exactly(shared, k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, query_ids, packed, large, d = shared.value
        queries = _Exact(packed, large, d, scale)
        best: list[list[tuple[int, int]]] = [[] for _ in packed]  # (-score, id), the best first
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                some = batch.slice(a, BLOCK)
                ids = some.column("id").fill_null(_NO_ID).to_numpy()
                theirs = _Exact(some.column("x").to_pylist(), some.column("large").to_pylist(), d, scale)
                with np.errstate(over="ignore", invalid="ignore"):
                    near = queries.near @ theirs.near.T
                    slack = (np.abs(queries.near) @ np.abs(theirs.near).T) * ((d + 2) * 2.0**-52)
                    low, high = near - slack, near + slack
                low[~np.isfinite(low)] = -np.inf  # beyond floating point: the integers decide
                high[~np.isfinite(high)] = np.inf
                _own_out(low, query_ids, ids)
                _own_out(high, query_ids, ids)
                for q in range(len(packed)):
                    bound = np.partition(low[q], -k)[-k] if len(ids) >= k else -np.inf
                    if len(best[q]) == k:
                        bound = max(bound, np.nextafter(_rough(-best[q][-1][0]), -np.inf))
                    mine = queries.ints(q)
                    new = [
                        (-sum(x * y for x, y in zip(mine, theirs.ints(c))), int(ids[c]))
                        for c in np.flatnonzero((high[q] >= bound) & (high[q] > -np.inf)).tolist()
                    ]
                    best[q] = sorted(best[q] + new)[:k]
        rows = [(int(numbers[q]), int(query_ids[q]), i, -s) for q, found in enumerate(best) for s, i in found]
        at, query_id, vec_id, score = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_pydict(
            {
                "at": pa.array(at, pa.int64()),
                "query_id": pa.array(query_id, pa.int64()),
                "vec_id": pa.array(vec_id, pa.int64()),
                "score": pa.array([s if -(1 << 63) <= s < 1 << 63 else None for s in score], pa.int64()),
                "rough": pa.array([_rough(s) for s in score], pa.float64()),
                "digits": pa.array([_digits(s) for s in score], pa.string()),
            }
        )

    return tidy(run)


def _arrays(rows: list, d: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array([_NO_ID if r.id is None else r.id for r in rows], np.int64)
    x = np.zeros((len(rows), d))
    for i, r in enumerate(rows):
        one = np.frombuffer(r.x, "<f8")
        x[i, : len(one)] = one
    return ids, x


def _first_bounds(query_ids, queries, seed_ids, seeds, k: int) -> np.ndarray:
    """For each query the k-th best score among the longest vectors, a lower bound."""
    best = Best(len(query_ids), k)
    if not len(query_ids):
        return best.least()
    order = np.argsort(seed_ids, kind="stable")
    seed_ids, seeds = seed_ids[order], seeds[order]
    for a in range(0, len(seed_ids), BLOCK):
        score = queries @ seeds[a : a + BLOCK].T
        _own_out(score, query_ids, seed_ids[a : a + BLOCK])
        best.add(np.arange(len(query_ids)), score, seed_ids[a : a + BLOCK])
    return best.least()


def search(
    vectors: DataFrame,
    is_query: Column,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """For each row that ``is_query`` (a condition on the table's columns) holds for, the k
    other rows of the largest products: query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession
    asked = F.coalesce(is_query, F.lit(False)) & F.col(vec_id).isNotNull()
    named = vectors.select(F.col(vec_id).cast("bigint").alias("id"), asked.alias("asked"), F.col(vector).alias("v"))
    every = stage(named.mapInArrow(_scaled(scale), _VECTORS), "vectors")
    order = [F.col("square").desc(), F.col("id")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = every.filter("not large").select("id", "square", "x")
    longest_first = plain.repartitionByRange(parts, *order, F.xxhash64("x"))
    candidates = stage(longest_first.sortWithinPartitions(*order), "by-length")
    size = every.agg(F.max(F.length("x")).alias("bytes"), F.count_if("large").alias("large")).first()
    d = max(1, (size["bytes"] or 8) // 8)
    turn = axes(candidates, d)
    seed_ids, seeds = _arrays(candidates.orderBy(*order).limit(SEEDS).collect(), d)
    far = every.filter("large")

    found = []
    for rows in _blocks(every.filter("asked and not large")):
        ids, x = _arrays(rows, d)
        numbers = np.array([r["at"] for r in rows], np.int64)
        least = _first_bounds(ids, x, seed_ids, seeds, k)
        shared = spark.sparkContext.broadcast((numbers, ids, x, least, turn))
        found.append(stage(candidates.select("id", "x").mapInArrow(_search(shared, k), _FOUND), "best"))
        if size["large"]:
            found.append(_exactly(rows, far, d, k, scale, 1))
    if size["large"]:
        found += [_exactly(rows, every, d, k, scale, -1) for rows in _blocks(every.filter("asked and large"))]
    if not found:
        found = [spark.createDataFrame([], _FOUND)]
    every_found = reduce(DataFrame.unionAll, found)
    place = Window.partitionBy("at").orderBy(F.col("rough").desc(), F.col("digits").desc(), "vec_id")
    ranked = every_found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    known = F.when(F.col("vec_id") != F.lit(_NO_ID), F.col("vec_id"))
    return ranked.select("query_id", "rank", known.alias("vec_id"), "score")


def _blocks(asked: DataFrame) -> Iterator[list]:
    """The queries, QUERY_BLOCK at a time, numbered: each stands in one block, and a block is
    a folder of its own, so that taking it reads no other."""
    spark = asked.sparkSession
    path = workspace.fresh(spark, "queries")
    data = segments.stage(segments.number(asked), f"{path}/data")
    table = segments.stage_table(segments.starts(data, []), f"{path}/segments")
    block = F.expr(f"offset div {QUERY_BLOCK}")
    numbered = segments.place(data, table, []).withColumn("block", block).withColumnRenamed("offset", "at")
    blocks = segments.stage(numbered, f"{path}/blocks", partition_by=["block"])
    total = table.agg(F.sum("rows")).first()[0] or 0
    for b in range(-(-total // QUERY_BLOCK)):
        yield sorted(blocks.filter(F.col("block") == b).collect(), key=lambda r: r["at"])


def _exactly(rows: list, vectors: DataFrame, d: int, k: int, scale: int, sign: int) -> DataFrame:
    """What ``_search_exactly`` finds for one block of queries; of large queries the numbers
    are negative, to be told from those of others."""
    numbers = [r["at"] if sign > 0 else -1 - r["at"] for r in rows]
    ids = np.array([r.id for r in rows], np.int64)
    block = numbers, ids, [bytes(r.x) for r in rows], [r.large for r in rows], d
    shared = vectors.sparkSession.sparkContext.broadcast(block)
    return stage(vectors.select("id", "x", "large").mapInArrow(_search_exactly(shared, k, scale), _FOUND), "exact")
