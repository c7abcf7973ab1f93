"""Training sequences without padding: documents in pieces of power-of-two length.

A document of n token ids (the end id included) is cut by n's binary digits: as many pieces
of the longest length as fit, then one piece for each further digit, long ones first. Pieces
of one length form a bucket, and each piece is a sequence of its own: no sequence crosses
documents, and none needs padding, since its length is a power of two.

A bucket's sequences follow each other without gaps, and buckets follow each other by
length. Nothing is shuffled for that: each task numbers the pieces of each length as it
writes them, and a table of one row for each task and length says where its stretch begins.

Null and empty texts are one piece, of the end id. Very long texts are encoded alone and
handed on in batches of bounded size. Rows are treated one by one: rows that repeat an id or
a whole row are packed each, and null ids stay null. An empty table has no sequences. Only
the id and the text are read and the columns returned are the operator's own, so other
columns, whatever their names, are not in the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordlog.llm import token_files
from ordlog.llm.shared import BROADCAST_ROWS, stage, tidy

LONGEST = 4096
END_ID = 2
BATCH_IDS = 1 << 20  # ids handed on at once

_PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, shard int, nth bigint"


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two, none above ``longest``, that add up to n; long ones first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _pieces(tokenise, kind: str, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        shard = TaskContext.get().partitionId()
        counts: dict[int, int] = {}
        rows, held = [], 0

        def batch_of(rows: list) -> pa.RecordBatch:
            doc, start, length, total, ids, nth = zip(*rows)
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(doc, pa.int64()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "doc_tokens": pa.array(total, pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                    "shard": pa.array([shard] * len(rows), pa.int32()),
                    "nth": pa.array(nth, pa.int64()),
                }
            )

        for batch in tokenise(batches):
            for doc, packed in zip(batch.column("id").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(unpack(packed.as_buffer()), kind)
                start = 0
                for length in lengths(len(ids), longest):
                    nth = counts.get(length, 0)
                    counts[length] = nth + 1
                    piece = ids[start : start + length].astype("<u4").tobytes()
                    rows.append((doc, start, length, len(ids), piece, nth))
                    start += length
                    held += length
                    if held >= BATCH_IDS:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return tidy(run)


def cut(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
    end_id: int = END_ID,
    spaced: bool = False,
    special: bool = False,
) -> DataFrame:
    """The staged pieces of all documents: doc_id, start, length, doc_tokens, ids (unsigned
    little-endian 32-bit integers), shard and nth, the piece's number among those of its
    length in its shard. ``spaced`` and ``special`` as for ``token_files.tokens``."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece is a power of two")
    tokenise, kind = token_files.encoder(tokenizer, doc_id, text, spaced=spaced, end_id=end_id, special=special)
    return stage(docs.select(doc_id, text).mapInArrow(_pieces(tokenise, kind, longest), _PIECES), "pieces")


def _begins(pieces: DataFrame) -> DataFrame:
    """Where the sequences of each shard and length begin: one row for each of these."""
    counts = stage(pieces.groupBy("length", "shard").agg(F.count("*").alias("rows")), "piece-counts")
    within = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each length, at most 64
    buckets = counts.groupBy("length").agg(F.sum("rows").alias("rows"))
    below = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("length", F.coalesce(F.sum("rows").over(below), F.lit(0)).alias("bucket_begin"))
    begin = F.col("bucket_begin") + F.coalesce(F.sum("rows").over(within), F.lit(0))
    return counts.join(F.broadcast(buckets), "length").select("length", "shard", begin.cast("bigint").alias("begin"))


def pack(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """The sequences: sequence_id, doc_id, start, length, doc_tokens, offset, ids.

    ``options`` as for ``cut``. Each is one piece, so its offset is 0; sequences of one
    length have consecutive ids."""
    pieces = cut(docs, tokenizer, **options)
    begins = stage(_begins(pieces), "piece-begins")
    if begins.count() <= BROADCAST_ROWS:
        begins = F.broadcast(begins)
    return pieces.join(begins, ["length", "shard"]).select(
        (F.col("begin") + F.col("nth")).alias("sequence_id"),
        "doc_id",
        "start",
        "length",
        "doc_tokens",
        F.lit(0).cast("bigint").alias("offset"),
        "ids",
    )


def write(packed: DataFrame, folder: str) -> None:
    """One folder of Parquet files for each length, as a loader of one length reads them."""
    packed.write.partitionBy("length").parquet(folder)


def read(spark: SparkSession, folder: str, length: int) -> DataFrame:
    """The sequences of one length, with their ids as arrays of integers."""
    bucket = spark.read.parquet(folder).filter(F.col("length") == length)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in batch.column("ids")] or [[]])
            at = np.arange(batch.num_rows + 1, dtype=np.int32) * length
            ids = pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype("<i4"), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), ids], names=["sequence_id", "ids"])

    return bucket.select("sequence_id", "ids").mapInArrow(unpacked, "sequence_id bigint, ids array<int>")


def report(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """The sequences with a digest of their ids in place of these."""
    return pack(docs, tokenizer, **options).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
