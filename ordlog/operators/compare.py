"""Do two tables hold the same rows, and the same values?"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARTERS = ("hash_0", "hash_1", "hash_2", "hash_3")
QUARTER_BITS = 16


def fingerprint_sums(line_hash: Column) -> list[Column]:
    """Aggregates that make a fingerprint: the row count and the sums of the hashes' quarters.

    Equal for equal multisets of rows, in any order. A quarter is 16 bits, so a bigint holds
    the sum over 10^14 rows.
    """
    quarters = [
        F.shiftrightunsigned(line_hash, QUARTER_BITS * i).bitwiseAND(F.lit((1 << QUARTER_BITS) - 1))
        for i in range(len(QUARTERS))
    ]
    sums = [F.coalesce(F.sum(q), F.lit(0)).alias(name) for q, name in zip(quarters, QUARTERS)]
    return [F.count(line_hash).alias("rows"), *sums]


def row_hash(columns: list[str]) -> Column:
    """A row's hash; it also tells where the row's nulls are, which xxhash64 passes over."""
    return F.xxhash64(*[F.isnull(F.col(f"`{c}`")).cast("int") for c in columns], *[F.col(f"`{c}`") for c in columns])


def fingerprint(df: DataFrame, *columns: str | Column) -> DataFrame:
    """One row: the fingerprint of a table."""
    hashed = df.select((F.xxhash64(*columns) if columns else row_hash(df.columns)).alias("hash"))
    return hashed.agg(*fingerprint_sums(F.col("hash")))


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: both counts, and whether the fingerprints agree."""
    prints = [
        fingerprint(df).select(F.lit(side).alias("side"), F.struct("rows", *QUARTERS).alias("of"))
        for side, df in enumerate((left, right))
    ]
    both = prints[0].unionByName(prints[1])
    return both.agg(F.min_by("of", "side").alias("l"), F.max_by("of", "side").alias("r")).select(
        F.col("l.rows").alias("left_rows"),
        F.col("r.rows").alias("right_rows"),
        (F.col("l") == F.col("r")).alias("equal"),
    )


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Exact: each differing row once, with how many more the left (or, negative, right) has.

    Copies are added up in the map tasks, so a row that is a third of the data costs one
    row for each task in the shuffle.
    """
    columns = left.columns
    both = left.withColumn("_n", F.lit(1).cast("bigint")).unionByName(
        right.select(*columns).withColumn("_n", F.lit(-1).cast("bigint"))
    )
    return both.groupBy(*columns).agg(F.sum("_n").alias("surplus")).filter(F.col("surplus") != 0)


# --- which rows differ, without shuffling rows ------------------------------------------

CELL_BITS = 12
GROWTH_BITS = 3  # a sketch that was too small is made up to eight times as large
SUMS = ("n", "q0", "q1", "q2", "q3", "check0", "check1")


def _checks_of(h: int) -> list[int]:
    """Halves of a checksum that does not add up as hashes do: the sum or the mean of several
    hashes of one cell is a hash of that cell too, but has another checksum."""
    check = zlib.crc32(str(_signed(h)).encode())
    return [check & 0xFFFF, check >> 16]


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _cells_of(h: int, bits: int) -> list[int]:
    return [(j << bits) + (h >> 20 * j & (1 << bits) - 1) for j in range(3)]


def difference_cells(left: DataFrame, right: DataFrame, bits: int = CELL_BITS) -> DataFrame:
    """An invertible sketch of the rows that one table has and the other has not.

    Each row adds its count and parts of its hash to three of 3 * 2^bits cells, rows of the
    right table with the opposite sign; what both have cancels out. Tasks hand on no more
    than the cells. A sum of 16-bit parts holds over 10^14 rows."""
    sides = []
    low = lambda of, i: F.shiftrightunsigned(of, 16 * i).bitwiseAND(F.lit(0xFFFF))
    for df, sign in ((left, 1), (right.select(*left.columns), -1)):
        h = df.select(row_hash(left.columns).alias("h"))
        h = h.withColumn("check", F.crc32(F.col("h").cast("string")))
        values = [F.lit(1), *[low("h", i) for i in range(4)], *[low("check", i) for i in range(2)]]
        at = [F.lit(j << bits) + F.shiftrightunsigned("h", 20 * j).bitwiseAND(F.lit((1 << bits) - 1)) for j in range(3)]
        signed = [(v * sign).cast("bigint").alias(n) for v, n in zip(values, SUMS)]
        sides.append(h.select(F.explode(F.array(*at)).alias("cell"), *signed))
    both = sides[0].unionAll(sides[1])
    sums = both.groupBy("cell").agg(*[F.sum(n).alias(n) for n in SUMS])
    return sums.filter(" or ".join(f"{n} <> 0" for n in SUMS))


def decode(cells: dict[int, list[int]], bits: int = CELL_BITS) -> dict[int, int] | None:
    """The hashes of the differing rows and by how many they differ; None if there are more
    than the cells can tell. Takes out rows that are alone in a cell, one after the other.

    Each leaves a cell empty for good, so there are no more steps than cells. Were several
    rows taken for one, they might be put back and taken out for ever."""
    cells, found, todo = {c: list(v) for c, v in cells.items()}, {}, list(cells)
    steps = len(cells)
    while todo:
        cell = todo.pop()
        n, *parts = cells.get(cell, [0] * len(SUMS))
        if not n or any(p % n for p in parts):
            continue
        parts = [p // n for p in parts]
        if not all(0 <= p <= 0xFFFF for p in parts):
            continue
        h = sum(p << 16 * i for i, p in enumerate(parts[:4]))
        if parts[4:] != _checks_of(h) or cell not in _cells_of(h, bits):
            continue
        if not steps:
            return None
        steps -= 1
        found[h] = found.get(h, 0) + n
        for other in _cells_of(h, bits):
            held = cells.setdefault(other, [0] * len(SUMS))
            for i, v in enumerate((1, *parts)):
                held[i] -= n * v
            todo.append(other)
    if any(any(v) for v in cells.values()):
        return None
    return {h: n for h, n in found.items() if n}


def bits_needed(cells: dict[int, list[int]], bits: int = CELL_BITS) -> int:
    """How large a sketch must be that holds what was too much for this one. The squares of
    the cells' counts tell about how many rows differ, or more where they do by several copies."""
    total = sum(v[0] for v in cells.values()) / 3
    differing = sum(v[0] ** 2 for v in cells.values()) / 3 - total**2 / (1 << bits)
    return max(bits + 1, int(differing).bit_length() - 1)


def differing_hashes(left: DataFrame, right: DataFrame, bits: int = CELL_BITS) -> dict[int, int] | None:
    """What ``decode`` finds in a sketch of the two tables, or in a larger one, of up to
    2^(bits + GROWTH_BITS) cells three times, where the first shows that this will do."""
    sketch = lambda size: {r.cell: [r[n] for n in SUMS] for r in difference_cells(left, right, size).collect()}
    cells = sketch(bits)
    found = decode(cells, bits)
    if found is None and (larger := bits_needed(cells, bits)) <= bits + GROWTH_BITS:
        found = decode(sketch(larger), larger)
    return found


def lost_rows(left: DataFrame, right: DataFrame, bits: int = CELL_BITS) -> DataFrame:
    """What ``multiset_diff`` gives, for tables that differ in few rows: found by a sketch, so
    that no row is shuffled but those that differ. Where they are too many for it (about
    2^(bits + 1) different ones), a larger one is made; where they are too many for one eight
    times as large, the exact way is taken.

    Rows are known by 64-bit hashes. The differing ones are looked up by one more scan."""
    found = differing_hashes(left, right, bits)
    if found is None:
        return multiset_diff(left, right)
    spark, columns = left.sparkSession, left.columns
    signed = [(_signed(h), n) for h, n in found.items()]
    known = F.broadcast(spark.createDataFrame(signed, "_hash bigint, surplus bigint"))  # some ten thousand rows
    held = []
    for df, more in ((left, "surplus > 0"), (right.select(*columns), "surplus < 0")):
        mine = df.withColumn("_row", row_hash(columns)).join(known.filter(more), F.col("_row") == F.col("_hash"))
        held.append(mine.select(*[F.col(f"`{c}`") for c in columns], "surplus"))
    return held[0].unionByName(held[1]).dropDuplicates()


def observed_domain(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def domain_diff(df: DataFrame, column: str, declared: DataFrame) -> DataFrame:
    """Values seen but not declared, and declared but never seen; empty when they match."""
    seen = observed_domain(df, column).select(F.col(column).alias("value"))
    wanted = declared.select(F.col(declared.columns[0]).alias("value")).distinct()
    return (
        seen.subtract(wanted)
        .select("value", F.lit("unexpected").alias("status"))
        .unionByName(wanted.subtract(seen).select("value", F.lit("missing").alias("status")))
    )
