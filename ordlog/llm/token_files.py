"""Token ids in binary files: frequency ranks in byte-aligned variable-length coding.

A file holds whole documents in ascending id order. Each id is replaced by its rank by
falling frequency in the corpus and written in as few bytes as it needs, 1 to 4. The
number of bytes stands apart, two bits for each id, four ids to a control byte. So a
reader finds all lengths by a table of 256 rows, all positions by a running sum, and the
ids by a lookup in the table of ranks.

    file    magic, then blocks of whole documents of about BLOCK_IDS ids
    block   numbers of documents, of ids and of data bytes (3 x int64)
            ids of the documents (int64), 1 where one is null (uint8), lengths (int64)
            control bytes, data bytes

Documents are tokenised once and staged; the corpus' counts are taken from there, one row
for each task and id. A range shuffle then brings the staged ids in order, and each task
writes one file under a name of its own attempt. Which files count is written down by
Spark's own commit, so the files of lost or repeated attempts are never read. Only the
table of ranks, of the vocabulary's size, and one row for each file pass the driver.

The name of an added token in a text, such as <|endoftext|>, is either text like any other
or, with ``special``, that token's one id, as the tokenizer has it by default.

Null and empty texts have no ids but the end id; a very long text is encoded alone. Null
document ids come first. Rows with the same id follow each other in an order that is not
fixed; every row is written, repeated ones as often as they stand. Ids of the tokenizer that
are equally frequent are ranked by number. An empty table makes no file. Only id and text are
read, so other columns are not in the way.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordlog import workspace
from ordlog.llm import words
from ordlog.llm.shared import stage, tidy

MAGIC = b"RVB1"
BLOCK_IDS = 1 << 20
FILE_IDS = 1 << 26
END_ID = 1
REMEMBERED = 3_000_000  # pieces of text whose ids a worker keeps, some 30 bytes each
STEMS = 50_000  # words whose ids wait for the same word with another sign behind it
CHUNK = 1 << 21  # bytes of texts encoded at once
# what can follow a word and is a piece of its own; an apostrophe may belong to the word
_CLOSING = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _letters(stem: str) -> bool:
    """Nothing but letters, also once it is composed and in lower case."""
    return stem.isalpha() and normalize("NFC", stem).lower().isalpha()


class _Pieces:
    """Ids of pieces of text that the tokenizer treats apart from what stands around them.

    Pieces are known by two 64-bit hashes, without regard to the case of A-Z. Their ids lie
    one behind the other in one array, so the ids of many pieces are one gather.

    ``special``: added tokens named in a text are tokens. Their names are matched before a
    text is lower-cased, so pieces that hold one are encoded apart, as they are written."""

    def __init__(self, path: str, kind: str, special: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a piece are text
        self.special = special
        added = self.tokenizer.get_added_tokens_decoder().values() if special else ()
        self.names = [t.content.encode() for t in added if t.content]
        self.to_model = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.kind = np.dtype(kind)
        self.clear()

    def clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.second = np.empty(0, np.uint64)
        self.start = np.empty(0, np.uint32)
        self.size = np.empty(0, np.uint32)
        self.ids = np.empty(0, self.kind)
        self.stems: dict[bytes, list[int]] = {}

    def whole(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode(), add_special_tokens=False).ids

    def written(self, text: bytes) -> list[int]:
        """Ids of a text as it is written, with the added tokens that it names."""
        self.tokenizer.encode_special_tokens = not self.special
        try:
            return self.whole(text)
        finally:
            self.tokenizer.encode_special_tokens = True

    def _naming(self, w: words.Words) -> list[int]:
        """The words that hold the name of an added token, in rising order."""
        found: set[int] = set()
        raw = w.data.tobytes() if self.names else b""
        for name in self.names:
            at = raw.find(name)
            while at >= 0:
                i = int(np.searchsorted(w.begin, at, "right")) - 1
                if i >= 0 and at + len(name) <= w.end[i]:  # not across rows
                    found.add(i)
                at = raw.find(name, at + 1)
        return sorted(found)

    def encode_named(self, w: words.Words) -> tuple[np.ndarray, np.ndarray]:
        """``encode``, and added tokens where the words name them."""
        ids, size = self.encode(w)
        naming = self._naming(w)
        if not naming:
            return ids, size
        stop, held, parts, last = np.cumsum(size), {}, [], 0
        for i in naming:
            piece = w.data[w.begin[i] : w.end[i]].tobytes()
            if piece not in held:
                held[piece] = np.array(self.written(piece), self.kind)
            parts += [ids[last : stop[i] - size[i]], held[piece]]
            last = stop[i]
        size[naming] = [len(x) for x in parts[1::2]]
        return np.concatenate([*parts, ids[last:]]), size

    def sizes(self, w: words.Words) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, with names of added tokens taken for text, and for tokens."""
        _, as_text = self.encode(w)
        as_tokens = as_text.copy()
        for i in self._naming(w):
            as_tokens[i] = len(self.written(w.data[w.begin[i] : w.end[i]].tobytes()))
        return as_text, as_tokens

    def _stem(self, stem: bytes) -> list[int]:
        """Ids of a run of letters. Plain ones reach the model's merges directly."""
        ids = self.stems.get(stem)
        if ids is None:
            if stem.isascii():
                ids = [t.id for t in self.tokenizer.model.tokenize(stem.decode())]
            else:
                value = stem.decode()
                lower = value.lower()
                if max(value) < "\u0250" and is_normalized("NFC", value):
                    ids = [t.id for t in self.tokenizer.model.tokenize(self.to_model(lower)[0][0])]
                else:
                    ids = self.whole(stem)
            self.stems[stem] = ids
        return ids

    def piece(self, piece: bytes) -> list[int]:
        """Ids of what stands between white space, in lower case as far as A-Z go: mostly a
        word, perhaps with a sign."""
        stem = piece.rstrip(_CLOSING)
        if not stem.isalpha() and not (stem and _letters(stem.decode())):
            return self.whole(piece)
        ids = self._stem(stem)
        if len(stem) == len(piece):
            return ids
        signs = piece[len(stem) :]
        if signs not in self.stems:
            self.stems[signs] = self.whole(signs)
        return ids + self.stems[signs]

    def encode(self, w: words.Words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words of some texts, and how many each word has."""
        if len(self.hashes) >= REMEMBERED:
            self.clear()
        distinct, first, which = np.unique(w.hashes, return_index=True, return_inverse=True)
        order = np.argsort(first)
        second = np.empty(len(distinct), np.uint64)
        second[order] = w.second(first[order])
        at = np.searchsorted(self.hashes, distinct)
        held = np.minimum(at, max(0, len(self.hashes) - 1))
        known = np.zeros(len(distinct), bool)
        if len(self.hashes):
            known = (self.hashes[held] == distinct) & (self.second[held] == second)
        new = np.flatnonzero(~known)
        found = [self.piece(w.text(i)) for i in first[new].tolist()]
        sizes = np.array([len(f) for f in found], np.int64)
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        flat = np.fromiter((i for f in found for i in f), self.kind, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        start, size = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        start[known], size[known] = self.start[held[known]], self.size[held[known]]
        start[new], size[new] = starts, sizes
        # a second piece of the same first hash is not kept, and encoded each time
        fresh = new[self.hashes[held[new]] != distinct[new]] if len(self.hashes) else new
        place = at[fresh]
        self.hashes = np.insert(self.hashes, place, distinct[fresh])
        self.second = np.insert(self.second, place, second[fresh])
        self.start = np.insert(self.start, place, start[fresh])
        self.size = np.insert(self.size, place, size[fresh])
        if len(self.stems) > STEMS:
            self.stems = {}
        start, size = start[which], size[which]
        shift = np.repeat(start - (np.cumsum(size) - size), size)
        return self.ids[shift + np.arange(len(shift))], size


@lru_cache(maxsize=2)
def pieces_of(path: str, kind: str, special: bool = False) -> _Pieces:
    return _Pieces(path, kind, special)


def id_kind(path: str, end_id: int) -> str:
    from tokenizers import Tokenizer

    largest = max([end_id, *Tokenizer.from_file(path).get_vocab().values()])
    return "<u2" if largest < 1 << 16 else "<u4"


def _tokenise(doc_id: str, text: str, path: str, kind: str, spaced: bool, end_id: int, special: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path, kind, special)
        end = np.array([end_id], kind).tobytes()
        press = zstandard.ZstdCompressor(level=3).compress
        width = np.dtype(kind).itemsize
        for batch in batches:
            data, at = words.buffer(batch.column(text))
            for i, j in words.chunks(at, CHUNK):
                first = at[i : j + 1] - at[i]
                raw = data[at[i] : at[j]]
                if spaced:
                    w = words.split(raw, first, words.SPACED)
                    ids, size = pieces.encode_named(w)
                    stop = np.concatenate([[0], np.cumsum(size)])[w.at]
                    rows = [ids[a:b].tobytes() for a, b in zip(stop[:-1].tolist(), stop[1:].tolist())]
                else:
                    texts = [raw[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                    rows = [np.array(pieces.written(t), kind).tobytes() for t in texts]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column(doc_id).slice(i, j - i).cast(pa.int64()),
                        "n": pa.array([len(r) // width + 1 for r in rows], pa.int64()),
                        "ids": pa.array([press(r + end) for r in rows], pa.binary()),
                    }
                )

    return tidy(run)


def encoder(path: str, doc_id: str, text: str, *, spaced: bool, end_id: int, special: bool):
    """A mapInArrow function from these two columns to id, n and zstd-packed ids of each
    document, and the ids' numpy type; options as for ``tokens``."""
    kind = id_kind(path, end_id)
    return _tokenise(doc_id, text, path, kind, spaced, end_id, special), kind


def tokens(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    spaced: bool = False,
    end_id: int = END_ID,
    special: bool = False,
) -> tuple[DataFrame, str]:
    """Staged ids of each document, zstd-packed, and their numpy type.

    ``spaced``: the tokenizer drops white space, no token spans it, and lower-cased runs
    of letters are one piece before its merges. Then each piece between white space is
    encoded once for a worker, not once for each place where it stands.

    ``special``: the name of an added token in a text is that token, not text."""
    run, kind = encoder(tokenizer, doc_id, text, spaced=spaced, end_id=end_id, special=special)
    ids = docs.select(doc_id, text).mapInArrow(run, "id bigint, n bigint, ids binary")
    path = workspace.fresh(docs.sparkSession, "token-ids")
    ids.write.option("compression", "none").parquet(path)  # they are packed already
    return docs.sparkSession.read.schema(ids.schema).parquet(path), kind


def _count(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        sums = np.zeros(0, np.int64)
        for batch in batches:
            for packed in batch.column("ids"):
                found = np.bincount(np.frombuffer(unpack(packed.as_buffer()), kind))
                if len(found) > len(sums):
                    sums = np.pad(sums, (0, len(found) - len(sums)))
                sums[: len(found)] += found
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"id": pa.array(seen, pa.int64()), "n": pa.array(sums[seen], pa.int64())})

    return tidy(run)


def ranks(staged: DataFrame, kind: str) -> np.ndarray:
    """Ids by falling frequency; there are no more than the vocabulary has."""
    partial = staged.select("ids").mapInArrow(_count(kind), "id bigint, n bigint")
    rows = partial.groupBy("id").agg(F.sum("n").alias("n")).collect()
    return np.array([r.id for r in sorted(rows, key=lambda r: (-r.n, r.id))], "<u4")


# --- the coding ----------------------------------------------------------------------


def encode(ranked: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of some ranks."""
    r = ranked.astype("<u4")
    size = 1 + (r >= 1 << 8).astype(np.uint8) + (r >= 1 << 16) + (r >= 1 << 24)
    code = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    code[: len(r)] = size - 1
    control = code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


_SIZES = np.array([[1 + (b >> 2 * k & 3) for k in range(4)] for b in range(256)], np.uint8)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = _SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    end = np.cumsum(size, dtype=np.int64)
    begin = end - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[begin].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        out |= raw[begin + k].astype(np.uint32) << np.uint32(8 * k)
    return out & _MASKS[size]


# --- files ---------------------------------------------------------------------------


def _block(ids: list, sizes: list[int], ranked: list[np.ndarray]) -> bytes:
    every = np.concatenate(ranked)
    control, data = encode(every)
    return b"".join(
        [
            np.array([len(ids), len(every), len(data)], "<i8").tobytes(),
            np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
            np.array([i is None for i in ids], np.uint8).tobytes(),
            np.array(sizes, "<i8").tobytes(),
            control,
            data,
        ]
    )


def _write(folder: str, kind: str, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        shard = TaskContext.get().partitionId()
        system, root = fs.FileSystem.from_uri(folder)
        path, out = f"shard-{shard:07d}-{uuid.uuid4().hex}.rvb", None
        rank = np.zeros(int(table.value.max(initial=0)) + 1, np.uint32)
        rank[table.value] = np.arange(len(table.value), dtype=np.uint32)
        ids, sizes, ranked, held, docs, total = [], [], [], 0, 0, 0
        for batch in batches:
            for one, packed in zip(batch.column("id").to_pylist(), batch.column("ids")):
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{path}")
                    out.write(MAGIC)
                ranked.append(rank[np.frombuffer(unpack(packed.as_buffer()), kind)])
                ids.append(one)
                sizes.append(len(ranked[-1]))
                held += sizes[-1]
                docs, total = docs + 1, total + sizes[-1]
                if held >= BLOCK_IDS:
                    out.write(_block(ids, sizes, ranked))
                    ids, sizes, ranked, held = [], [], [], 0
        if out is not None:
            if ids:
                out.write(_block(ids, sizes, ranked))
            out.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "path": pa.array([path]),
                    "docs": pa.array([docs], pa.int64()),
                    "ids": pa.array([total], pa.int64()),
                }
            )

    return tidy(run)


def _read(folder: str, table, shaped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with system.open_input_stream(f"{root}/{path}") as file:
                    if file.read(len(MAGIC)) != MAGIC:
                        raise ValueError(f"{path} is no file of token ids")
                    while head := file.read(24):
                        n_docs, n_ids, n_data = np.frombuffer(head, "<i8").tolist()
                        ids = np.frombuffer(file.read(8 * n_docs), "<i8")
                        null = np.frombuffer(file.read(n_docs), np.uint8).astype(bool)
                        sizes = np.frombuffer(file.read(8 * n_docs), "<i8")
                        control, data = file.read(-(-n_ids // 4)), file.read(n_data)
                        tokens = table.value[decode(control, data, n_ids)]
                        end = np.cumsum(sizes)
                        at = np.concatenate([[0], end])
                        yield pa.RecordBatch.from_pydict(
                            {
                                "id": pa.array(ids, pa.int64(), mask=null),
                                "start": pa.array(start + end - sizes, pa.int64()),
                                **shaped(tokens, at),
                            }
                        )
                        start += n_ids

    return tidy(run)


def write(staged: DataFrame, kind: str, folder: str) -> tuple[DataFrame, np.ndarray]:
    """Write staged ids as files below ``folder``; one row for each file, in id order, and
    the table of ranks (also written to the folder)."""
    spark = staged.sparkSession
    table = ranks(staged, kind)
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/ranks.u4") as out:
        out.write(table.tobytes())
    total = staged.agg(F.sum("n")).first()[0] or 0
    files = max(-(-total // FILE_IDS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the last key spreads even rows that are all alike
    keyed = staged.withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("id").asc_nulls_first(), F.col("_row")]
    ranged = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_row")
    shared = spark.sparkContext.broadcast(table)
    manifest = ranged.mapInArrow(_write(folder, kind, shared), "shard int, path string, docs bigint, ids bigint")
    return stage(manifest, "token-files"), table


def _lists(tokens: np.ndarray, at: np.ndarray) -> dict:
    return {"ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(tokens.astype("<i4"), pa.int32()))}


def _digests(tokens: np.ndarray, at: np.ndarray) -> dict:
    raw, at = tokens.astype("<u4").tobytes(), at.tolist()
    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at[1:])]
    return {"n_tokens": pa.array(np.diff(at), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}


_LISTS = _lists, "id bigint, start bigint, ids array<int>"
_DIGESTS = _digests, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read(spark: SparkSession, manifest: DataFrame, folder: str, table: np.ndarray, shape=_LISTS) -> DataFrame:
    """The documents of the files: id, start (ids of all documents before it), and ids or
    what else ``shape`` makes of them."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    spread = files.select("path", "start").repartition(max(1, manifest.count()))
    return spread.mapInArrow(_read(folder, spark.sparkContext.broadcast(table), shape[0]), shape[1])


def report(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """Write the files and read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = workspace.fresh(spark, "rvb")
    staged, kind = tokens(docs, tokenizer, doc_id=doc_id, **options)
    manifest, table = write(staged, kind, folder)
    return read(spark, manifest, folder, table, _DIGESTS).withColumnRenamed("id", doc_id)
