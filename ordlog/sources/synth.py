"""Seeded record generator.

Each record is a function of (seed, row id) alone: a counter-based generator (SplitMix64)
gives it ten 64-bit words, which are cut into 16-bit pieces, one for each character or
choice; a piece becomes a character by a table. So the table is the same for any
partitioning, a lost task recomputes the same rows, there is nothing to shuffle, and any
engine with 64-bit integers can reproduce the rows.

Tasks draw whole batches at a time, as arrays. ``write_lines`` writes files of lines without
making a row of each: a task hands on blocks of many lines. Workers need numpy and Arrow, not
this package: what they run is sent to them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordlog.schema import (
    ADDRESS_CHARS,
    ADDRESS_LENGTH,
    CONTINENTS,
    FIELDS,
    ID_LIMIT,
    LETTERS,
    NAME_LENGTH,
    RECORD,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# SplitMix64.
GAMMA = 0x9E3779B97F4A7C15
MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))  # shift and multiplier of each round
LAST_SHIFT = 31

WORDS = 10
# which of a record's 40 pieces of 16 bits decide on what; the address opens with a digit
# and a space, which its other characters follow
NAME = 0
ADDRESS = NAME + NAME_LENGTH[1]
DIGIT = ADDRESS + ADDRESS_LENGTH[1] - 2
NAME_SIZE, ADDRESS_SIZE, CONTINENT = DIGIT + 1, DIGIT + 2, DIGIT + 3
ID = 4 * WORDS - 2  # two pieces

RECORDS = T.StructType([T.StructField("row_id", T.LongType(), False), *RECORD.fields])
BLOCK = 1 << 13  # lines handed on as one value
TASK_BLOCKS = 1 << 14  # at most


def seed_word(seed: int) -> int:
    return (seed * 0xD1342543DE82EF95 + 1) % (1 << 64)


def _tables():
    """Characters and choices for each value of a piece, and four digits of each number."""
    import numpy as np

    piece = np.arange(1 << 16, dtype=np.uint32)
    chars = [np.frombuffer(c.encode(), np.uint8)[(piece * len(c)) >> 16] for c in (LETTERS, ADDRESS_CHARS)]
    sizes = [((piece * (high - low + 1)) >> 16).astype(np.uint8) + low for low, high in (NAME_LENGTH, ADDRESS_LENGTH)]
    digit = ((piece * 10) >> 16).astype(np.uint8)
    which = ((piece * len(CONTINENTS)) >> 16).astype(np.uint8)
    number = np.arange(10_000)
    four = np.stack([number // 10**k % 10 for k in (3, 2, 1, 0)], axis=1).astype(np.uint8) + ord("0")
    return chars, sizes, digit, which, four


def _mixed(z):
    import numpy as np

    for shift, factor in MIX:
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return z ^ (z >> np.uint64(LAST_SHIFT))


def _drawn(row_ids, seed: int, tables):
    """ids, names, addresses and continents of some row ids: numbers, and for each text a
    matrix of bytes with its length."""
    import numpy as np

    (letters, chars), (name_sizes, address_sizes), digits, which, _ = tables
    state = _mixed(row_ids.astype(np.int64).view(np.uint64) * np.uint64(GAMMA) + np.uint64(seed_word(seed)))
    steps = np.array([(k + 1) * GAMMA % (1 << 64) for k in range(WORDS)], np.uint64)
    piece = _mixed(state[:, None] + steps).astype("<u8", copy=False).view("<u2")
    ids = piece[:, ID].astype(np.uint64) | piece[:, ID + 1].astype(np.uint64) << np.uint64(16)
    ids = ((ids * np.uint64(ID_LIMIT)) >> np.uint64(32)).astype(np.int32)
    name = letters[piece[:, NAME:ADDRESS]]
    address = np.empty((len(ids), ADDRESS_LENGTH[1]), np.uint8)
    address[:, 0] = digits[piece[:, DIGIT]] + ord("0")
    address[:, 1] = ord(" ")
    address[:, 2:] = chars[piece[:, ADDRESS:DIGIT]]
    sizes = name_sizes[piece[:, NAME_SIZE]], address_sizes[piece[:, ADDRESS_SIZE]]
    return ids, (name, sizes[0]), (address, sizes[1]), which[piece[:, CONTINENT]]


def _texts(matrix, sizes):
    import numpy as np
    import pyarrow as pa

    kept = np.arange(matrix.shape[1], dtype=np.uint8) < sizes[:, None]
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(np.compress(kept.ravel(), matrix.ravel())))


def _records(seed: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        continents, tables = pa.array(CONTINENTS), _tables()
        for batch in batches:
            rows = batch.column("row_id")
            ids, name, address, continent = _drawn(rows.to_numpy(), seed, tables)
            columns = [rows, pa.array(ids), _texts(*name), _texts(*address), continents.take(pa.array(continent))]
            yield pa.RecordBatch.from_arrays(columns, names=["row_id", *FIELDS])

    return run


def _block(first: int, end: int, seed: int, tables) -> bytes:
    """The lines of these row ids, each but the last with its line end."""
    import numpy as np

    four = tables[-1]
    ids, (name, name_size), (address, address_size), continent = _drawn(np.arange(first, end), seed, tables)
    n, comma = len(ids), ord(",")
    widest = max(map(len, CONTINENTS))
    names = np.array([list(c.ljust(widest).encode()) for c in CONTINENTS], np.uint8)
    sizes = np.array([len(c) for c in CONTINENTS], np.uint8)
    # id, name, address and continent, each in its own columns, with what separates them
    at = np.cumsum([0, 12, 1, name.shape[1], 1, address.shape[1], 1, widest, 1])
    line = np.empty((n, at[-1]), np.uint8)
    kept = np.ones(line.shape, bool)
    column = np.arange(at[-1], dtype=np.uint8)
    high, low = np.divmod(ids, 10_000)
    higher, middle = np.divmod(high, 10_000)
    for k, part in enumerate((higher, middle, low)):
        line[:, 4 * k : 4 * k + 4] = four[part]
    digits = np.searchsorted(10 ** np.arange(1, 10), ids, "right").astype(np.uint8) + 1
    kept[:, :12] = column[:12] >= (12 - digits)[:, None]
    line[:, [at[1], at[3], at[5]]] = comma
    for k, (texts, size) in ((2, (name, name_size)), (4, (address, address_size)), (6, (names[continent], sizes[continent]))):
        line[:, at[k] : at[k + 1]] = texts
        kept[:, at[k] : at[k + 1]] = column[: texts.shape[1]] < size[:, None]
    line[:, at[7]] = ord("\n")
    kept[-1, at[7]] = False
    return np.compress(kept.ravel(), line.ravel()).tobytes()


def _blocks(count: int, seed: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tables = _tables()
        for batch in batches:
            for b in batch.column("block").to_pylist():
                lines = _block(b * BLOCK, min(count, (b + 1) * BLOCK), seed, tables)
                yield pa.RecordBatch.from_arrays([pa.array([lines]).cast(pa.string())], names=["value"])

    return run


def records_for(ids: DataFrame, row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """One record for each row id of ``ids``; columns row_id and the record's fields. Rows
    without an id have no record."""
    numbers = ids.select(F.col(row_id).cast("bigint").alias("row_id")).filter("row_id is not null")
    return numbers.mapInArrow(_records(seed), RECORDS)


def records(spark: SparkSession, count: int, seed: int = 42, tasks: int | None = None) -> DataFrame:
    """``count`` records; column row_id numbers them from 0."""
    ids = spark.range(0, count, 1, tasks) if tasks else spark.range(count)
    return records_for(ids.withColumnRenamed("id", "row_id"), seed=seed)


def write_lines(spark: SparkSession, count: int, path: str, seed: int = 42) -> None:
    """Files of the lines of ``count`` records, the same as those of ``records`` make."""
    blocks = -(-count // BLOCK)
    tasks = max(1, min(spark.sparkContext.defaultParallelism, blocks), -(-blocks // TASK_BLOCKS))
    numbers = spark.range(0, blocks, 1, tasks).withColumnRenamed("id", "block")
    numbers.mapInArrow(_blocks(count, seed), "value string").write.text(path)
