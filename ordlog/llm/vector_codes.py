"""Vectors as short codes: each part's nearest entry of a codebook, found by pivots (LAESA).

Components become integers (scaled, rounded down), so distances and codebooks are exact and
any rerun agrees. A vector is cut into equal parts; each part position has a codebook of its
own, which begins as that part of the rows of smallest ids and is moved by rounds of
assignment and averaging (rounded down).

A few entries of the first codebook, far from each other, are a position's fixed pivots.
The distances of every part to them are computed once and staged with the parts. In each
round only the pivots' distances to the moved entries are new; by the triangle inequality

    | distance(part, pivot) - distance(pivot, entry) |  <=  distance(part, entry)

Each part tries the entries by rising bound and stops where the bound exceeds the best
distance so far: exact integers are computed for the entries before that alone. Bounds are
floating point, lowered by more than their rounding, so no nearest entry or tie is missed.

A round is one pass over the staged parts. A task adds up its parts by entry and hands on
one sum for each entry and component, whatever its rows, as 32-bit digits that Spark adds
without overflow. The driver and each task hold the codebooks alone: the number of entries
times the vector's length.

Vectors that are null or hold a null, NaN or infinite component take no part. Components of
any finite size are exact: those too large for 64-bit squares are computed as unbounded
integers. An error beyond 64 bits is null, and so are sums that it is part of. Shorter
vectors (empty ones too), and lengths that the number of parts does not divide, end in
zeros. Null ids come after all others as first entries; rows of one id are taken in the
order of their components. Fewer rows than entries give as many entries; equal entries are
ties and the lower number is taken. Repeated rows count as often as they stand. An empty
table gives an empty one. Only id, vector and label are read and the columns returned are
the operator's own, so other columns, whatever their names, are not in the way. No column
is a text here.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordlog.llm.shared import BROADCAST_ROWS, stage, tidy

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
PIVOTS = 4
BLOCK = 4096  # rows taken at once
_MOST = (1 << 63) - 1
_SLACK = 1e-6  # of the distances in a bound, more than 32-bit floats round
_FAR = 1e300  # stands for any larger distance of two entries

_SUMS = "part bigint, entry bigint, component bigint, digit bigint, value bigint"
_STAGED = "id bigint, label {label}, x binary, wide string, far binary"


def _limit(width: int) -> int:
    """Components up to this make squared distances of a part below 2**62."""
    return math.isqrt((1 << 62) // max(1, width)) // 2


def whole(x: float, scale: int = SCALE) -> int:
    """The scaled component, rounded down, exactly."""
    over, under = float(x).as_integer_ratio()
    return over * scale // under


def _distance(a, b) -> int:
    return sum((int(x) - int(y)) ** 2 for x, y in zip(a, b))


def _root(square: int) -> float:
    """The distance, or a little less where it is beyond floating point."""
    return math.sqrt(square) if square < 1 << 1000 else min(_FAR, float(min(math.isqrt(square), 10**300)))


class Codebook:
    """Entries of one part position, with the distances to its pivots."""

    def __init__(self, entries: list[list[int]], pivots: list[list[int]]):
        limit = _limit(len(entries[0]) if entries else 1)
        self.entries = entries
        self.wide = np.array([any(abs(v) > limit for v in e) for e in entries], bool)
        narrow = [[0] * len(e) if w else e for e, w in zip(entries, self.wide)]
        self.narrow = np.array(narrow, np.int64).reshape(len(entries), -1)
        self.far = np.array([[_root(_distance(p, e)) for e in entries] for p in pivots])

    def _bounds(self, far: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances of parts (given by those to the pivots) to entries."""
        out = np.zeros((len(far), len(self.entries)))
        for mine, theirs in zip(far.T.astype(np.float64), self.far):
            bound = np.abs(mine[:, None] - theirs) - _SLACK * (mine[:, None] + theirs)
            np.fmax(out, bound, out=out)  # a distance beyond floating point bounds nothing
        return out

    def nearest(self, parts: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
        """For each part the nearest entry (the first of equally near ones) and the squared
        distance; where that is beyond 62 bits it stands in the third result instead."""
        bounds = self._bounds(far)
        order = np.argsort(bounds, axis=1, kind="stable")
        best = np.full(len(parts), _MOST)
        entry = np.full(len(parts), len(self.entries))
        reach = np.full(len(parts), np.inf)
        beyond: dict[int, int] = {}
        rows = np.arange(len(parts))
        for j in range(len(self.entries)):
            tried = order[rows, j]
            near = bounds[rows, tried] <= reach[rows]
            rows, tried = rows[near], tried[near]  # later bounds of the others are no lower
            if not len(rows):
                break
            exact = self.wide[tried]
            some, e = rows[~exact], tried[~exact]
            apart = parts[some] - self.narrow[e]
            square = np.einsum("ij,ij->i", apart, apart)
            better = (square < best[some]) | ((square == best[some]) & (e < entry[some]))
            some, e, square = some[better], e[better], square[better]
            best[some], entry[some] = square, e
            reach[some] = np.sqrt(square.astype(np.float64)) * (1 + 1e-9)
            for row, e in zip(rows[exact].tolist(), tried[exact].tolist()):
                square = _distance(parts[row], self.entries[e])
                now = int(best[row]) if best[row] < _MOST else beyond.get(row, math.inf)
                if (square, e) < (now, int(entry[row])):
                    entry[row] = e
                    if square < 1 << 62:
                        best[row], reach[row] = square, _root(square) * (1 + 1e-9)
                    else:
                        beyond[row] = square
        return entry, best, {r: s for r, s in beyond.items() if best[r] == _MOST}

    def nearest_wide(self, part: list[int]) -> tuple[int, int]:
        """Entry and squared distance of one part of any size."""
        square, entry = min((_distance(part, e), i) for i, e in enumerate(self.entries))
        return entry, square


@dataclass(frozen=True)
class Codebooks:
    books: list[Codebook]
    width: int


def _rows(batch: pa.RecordBatch, d: int, width: int, pivots: int):
    """Blocks of narrow rows as arrays, and each wide row: where they stand, their parts."""
    wide = batch.column("wide").to_pylist()
    narrow = [i for i, w in enumerate(wide) if w is None]
    x, far = batch.column("x"), batch.column("far")
    for a in range(0, len(narrow), BLOCK):
        some = narrow[a : a + BLOCK]
        parts = np.frombuffer(b"".join(x[i].as_py() for i in some), "<i4").reshape(len(some), d)
        away = np.frombuffer(b"".join(far[i].as_py() for i in some), "<f4")
        yield some, parts.astype(np.int64).reshape(len(some), -1, width), away.reshape(len(some), -1, pivots)
    for i, w in enumerate(wide):
        if w is not None:
            values = [int(v) for v in w.split(",")]
            yield i, [values[a : a + width] for a in range(0, d, width)], None


def _staged(d: int, width: int, pivots: list[list[list[int]]], scale: int):
    """Integer components, and the distances to the pivots."""
    limit = _limit(width)
    narrow = [np.array(p, object) for p in pivots]
    fits = [[max(map(abs, p)) <= limit for p in part] for part in pivots]

    def away(parts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(parts), len(pivots), len(pivots[0])))
        for q, part in enumerate(pivots):
            for k, pivot in enumerate(part):
                if fits[q][k]:
                    apart = parts[:, q] - narrow[q][k].astype(np.int64)
                    out[:, q, k] = np.sqrt(np.einsum("ij,ij->i", apart, apart).astype(np.float64))
                else:
                    out[:, q, k] = [_root(_distance(p, pivot)) for p in parts[:, q]]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                some = batch.slice(a, BLOCK)
                sizes = pc.list_value_length(some.column("v")).to_numpy(zero_copy_only=False)
                x = np.zeros((some.num_rows, d))
                x[np.arange(d) < sizes[:, None]] = some.column("v").flatten().to_numpy(zero_copy_only=False)
                with np.errstate(over="ignore"):
                    scaled = np.floor(x * scale)
                large = np.abs(scaled).max(axis=1, initial=0) > limit
                ints = np.where(large[:, None], 0, scaled).astype(np.int64)
                far = away(ints.reshape(len(ints), -1, width)).astype("<f4")
                packed = ints.astype("<i4")
                wide = [",".join(str(whole(v, scale)) for v in x[i]) if large[i] else None for i in range(len(x))]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("id"),
                        some.column("label"),
                        pa.array([r.tobytes() for r in packed], pa.binary(), mask=large),
                        pa.array(wide, pa.string()),
                        pa.array([r.tobytes() for r in far], pa.binary(), mask=large),
                    ],
                    names=["id", "label", "x", "wide", "far"],
                )

    return tidy(run)


def _digits(value: int) -> list[int]:
    """32-bit digits, the last one signed, that add up to the value."""
    out = []
    while not -(1 << 31) <= value < 1 << 31:
        out.append(value & 0xFFFFFFFF)
        value >>= 32
    return [*out, value]


def _sums(shared, d: int, width: int, pivots: int):
    """One task's parts, added up: part, entry, component (-1: how many), digit, value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Codebooks = shared.value
        k = len(books.books[0].entries)
        counts = np.zeros((len(books.books), k), np.int64)
        sums = np.zeros((len(books.books), k, width), np.int64)
        large: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for _, parts, far in _rows(batch, d, width, pivots):
                if far is None:
                    for q, part in enumerate(parts):
                        e, _ = books.books[q].nearest_wide(part)
                        counts[q, e] += 1
                        for at, v in enumerate(part):
                            large[q, e, at] = large.get((q, e, at), 0) + v
                    continue
                for q, book in enumerate(books.books):
                    e, _, _ = book.nearest(parts[:, q], far[:, q])
                    counts[q] += np.bincount(e, minlength=k)
                    np.add.at(sums[q], e, parts[:, q])
        rows = [(q, e, -1, counts[q, e]) for q, e in np.argwhere(counts).tolist()]
        rows += [(q, e, at, sums[q, e, at]) for q, e, at in np.argwhere(sums).tolist()]
        rows += [(*key, v) for key, v in large.items()]
        out = [(q, e, at, n, digit) for q, e, at, v in rows for n, digit in enumerate(_digits(int(v)))]
        columns = list(zip(*out)) or [[]] * 5
        names = ["part", "entry", "component", "digit", "value"]
        yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return tidy(run)


def _codes(shared, d: int, width: int, pivots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Codebooks = shared.value
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(books.books)), np.int64)
            errors: list[int] = [0] * batch.num_rows
            for at, parts, far in _rows(batch, d, width, pivots):
                for q, book in enumerate(books.books):
                    if far is None:
                        codes[at, q], square = book.nearest_wide(parts[q])
                        errors[at] += square
                        continue
                    codes[at, q], square, beyond = book.nearest(parts[:, q], far[:, q])
                    for n, (i, s) in enumerate(zip(at, square.tolist())):
                        errors[i] += beyond.get(n, s) if beyond else s
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array(text, pa.string()),
                    pa.array([e if e <= _MOST else None for e in errors], pa.int64()),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    return tidy(run)


def pick_pivots(entries: list[list[int]], n: int = PIVOTS) -> list[list[int]]:
    """Entries far from each other: each next one has the largest least distance to those
    picked before; the first one is the first entry."""
    picked = entries[:1]
    while len(picked) < min(n, len(entries)):
        picked.append(max(entries, key=lambda e: min(_distance(e, p) for p in picked)))
    return picked


def _moved(books: Codebooks, pivots: list, found: list) -> Codebooks:
    total: dict[tuple[int, int, int], int] = {}
    for r in found:
        key = r["part"], r["entry"], r["component"]
        total[key] = total.get(key, 0) + (r["value"] << 32 * r["digit"])
    out = []
    for q, book in enumerate(books.books):
        entries = []
        for e, entry in enumerate(book.entries):
            n = total.get((q, e, -1), 0)
            entries.append([total.get((q, e, at), 0) // n for at in range(books.width)] if n else entry)
        out.append(Codebook(entries, pivots[q]))
    return Codebooks(out, books.width)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def encode(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str | None = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, list[list[list[int]]]]:
    """The staged codes (vec_id, label, code, error) and the entries of each part position."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits for each part: 1 to 256 entries")
    spark = vectors.sparkSession
    tag = F.col(label) if label else F.lit(None).cast("string")
    named = vectors.select(
        F.col(vec_id).cast("bigint").alias("id"), tag.alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    kept = named.filter(_usable(F.col("v")))
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    d = width * parts
    seeds = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    first = [[whole(x, scale) for x in r.v] + [0] * (d - len(r.v)) for r in seeds]
    cuts = [[row[a : a + width] for row in first] for a in range(0, d, width)]
    kind = named.schema["label"].dataType.simpleString()
    if not first:
        none = [F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")]
        return named.filter("false").select(F.col("id").alias("vec_id"), "label", *none), cuts
    fixed = [pick_pivots(c, pivots) for c in cuts]
    n = len(fixed[0])
    staged = stage(kept.mapInArrow(_staged(d, width, fixed, scale), _STAGED.format(label=kind)), "parts")
    books = Codebooks([Codebook(c, p) for c, p in zip(cuts, fixed)], width)
    body = staged.select("x", "wide", "far")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        task_sums = body.mapInArrow(_sums(shared, d, width, n), _SUMS)
        found = task_sums.groupBy("part", "entry", "component", "digit").agg(F.sum("value").alias("value")).collect()
        shared.destroy()
        books = _moved(books, fixed, found)
    shared = spark.sparkContext.broadcast(books)
    codes = staged.mapInArrow(_codes(shared, d, width, n), f"vec_id bigint, label {kind}, code string, error bigint")
    return stage(codes, "codes"), [b.entries for b in books.books]


def with_label_error(codes: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows of the row's label, nulls together.

    Labels of many rows are few and their sums go by a broadcast; only rows of rarer labels
    are shuffled, and only where there are too many labels for a broadcast of all."""
    known = F.count("error") == F.count("*")
    sums = codes.groupBy("label").agg(
        F.count("*").alias("rows"), F.when(known, F.sum(F.col("error").cast("decimal(38,0)"))).alias("sum")
    )
    fits = F.when(F.col("sum") <= _MOST, F.col("sum")).cast("bigint").alias("label_error")
    sums = stage(sums.select(F.col("label").alias("_of"), "rows", fits), "label-errors")
    same = F.col("label").eqNullSafe(F.col("_of"))
    size = sums.agg(F.count("*").alias("labels"), F.sum("rows").alias("rows")).first()
    if size["labels"] <= BROADCAST_ROWS:
        return codes.join(F.broadcast(sums), same).drop("_of", "rows")
    often = F.col("rows") * BROADCAST_ROWS > size["rows"]
    few = F.broadcast(sums.filter(often))
    rare = codes.join(few, same, "left_anti").join(sums.filter(~often), same)
    return codes.join(few, same).unionByName(rare).drop("_of", "rows")


def report(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error and a digest of all final entries."""
    codes, books = encode(vectors, **options)
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    summed = with_label_error(codes)
    return summed.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
