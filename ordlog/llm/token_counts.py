"""Token counts by source, language and tokenizer version, kept up to date by deltas.

A batch of changes becomes signed sums by key: an insert adds a document and its tokens, a
delete takes them away, a revision takes the old count from the old key and adds the new one
to the new key. The sums are committed as one folder, named after the batch. Totals are the
sum over all committed batches, in any order.

A batch counts once. Its sums are written below a name of this attempt and then renamed to
the batch's name, which fails if that exists; so a batch that is sent again, or whose first
commit was cut short, adds nothing twice. Compaction sums some batches into one folder that
lists them, and readers pass over batches that a compacted folder lists. What it sums and
what it lists come from one look at the folder, so a batch committed meanwhile is neither.

Changes are summed by key with partial aggregation, so a key with a third of all changes is
no more than a row for each task. Null sources and languages are keys of their own. Empty
tables make empty batches, which commit an empty folder; a null count counts as 0. Repeated
rows are changes of their own: what may not count twice is the batch.

A corpus is counted in one pass over its texts, each whole, however long: null and empty
ones have no tokens. Only the named columns are read, so others are not in the way.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordlog.llm import token_files, words
from ordlog.llm.shared import stage, tidy

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
_BATCH = "batch="
_COMPACT = "compact="


def _paths(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _change(sign: int, tokenizer: str, tokens: Column, source: Column, lang: Column) -> Column:
    return F.struct(
        source.cast("string").alias("source"),
        lang.cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(sign).cast("bigint").alias("docs"),
        (F.coalesce(tokens, F.lit(0)) * sign).cast("bigint").alias("tokens"),
    )


def inserts(rows: DataFrame, tokens: Column, tokenizer: str, source: str = "source", lang: str = "lang") -> DataFrame:
    return rows.select(_change(1, tokenizer, tokens, F.col(source), F.col(lang)).alias("c")).select("c.*")


def deletes(rows: DataFrame, tokens: Column, tokenizer: str, source: str = "source", lang: str = "lang") -> DataFrame:
    return rows.select(_change(-1, tokenizer, tokens, F.col(source), F.col(lang)).alias("c")).select("c.*")


def revisions(
    rows: DataFrame,
    old: Column,
    new: Column,
    tokenizer: str,
    source: str = "source",
    lang: str = "lang",
    new_source: Column | None = None,
    new_lang: Column | None = None,
) -> DataFrame:
    """Documents whose count, source or language changes: ``old`` goes from the old key and
    ``new`` comes to the new one, which is the old one unless it is given."""
    before = _change(-1, tokenizer, old, F.col(source), F.col(lang))
    to = F.col(source) if new_source is None else new_source, F.col(lang) if new_lang is None else new_lang
    after = _change(1, tokenizer, new, *to)
    return rows.select(F.inline(F.array(before, after)))


class Rollup:
    """Totals below a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _listed(self) -> list[str]:
        at, system = _paths(self.spark, self.root)
        return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []

    def _compacted(self, names: list[str]) -> tuple[str | None, set[str]]:
        """The last compacted folder and the batches it stands for; older ones don't count."""
        last = max((n for n in names if n.startswith(_COMPACT)), default=None)
        if last is None:
            return None, set()
        return last, {r.value for r in self.spark.read.text(f"{self.root}/{last}/batches").collect()}

    def committed(self) -> set[str]:
        return self._batches(self._listed())

    def _batches(self, names: list[str]) -> set[str]:
        own = {n.removeprefix(_BATCH) for n in names if n.startswith(_BATCH)}
        return own | self._compacted(names)[1]

    def commit(self, batch: str, *changes: DataFrame) -> bool:
        """Add a batch of changes; False if a batch of this name has been added before."""
        if not batch or "/" in batch:
            raise ValueError("a batch needs a name without slashes")
        if batch in self.committed():
            return False
        every = reduce(DataFrame.unionByName, changes)
        sums = every.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        attempt = f"{self.root}/_attempt-{uuid.uuid4().hex}"
        sums.filter("docs <> 0 or tokens <> 0").write.parquet(attempt)
        return self._renamed(attempt, f"{self.root}/{_BATCH}{batch}")

    def _renamed(self, attempt: str, to: str) -> bool:
        source, system = _paths(self.spark, attempt)
        target, _ = _paths(self.spark, to)
        done = not system.exists(target) and system.rename(source, target)
        if not done:
            system.delete(source, True)
        return done

    def _sums(self, names: list[str]) -> DataFrame:
        """The totals of what a look at the folder has found."""
        last, covered = self._compacted(names)
        live = [n for n in names if n.startswith(_BATCH) and n.removeprefix(_BATCH) not in covered]
        paths = [f"{self.root}/{n}" for n in live] + ([f"{self.root}/{last}/sums"] if last else [])
        reader = self.spark.read.schema(DELTA)
        rows = reader.parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.filter("docs <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs and tokens; keys without documents and tokens go."""
        return self._sums(self._listed())

    def compact(self) -> None:
        """Sum all live folders into one. The old ones stay until ``sweep``."""
        names = self._listed()
        last, _ = self._compacted(names)
        batches = sorted(self._batches(names))
        if not batches:
            return
        attempt = f"{self.root}/_attempt-{uuid.uuid4().hex}"
        self._sums(names).write.parquet(f"{attempt}/sums")
        self.spark.createDataFrame([(b,) for b in batches], "value string").write.text(f"{attempt}/batches")
        number = int(last.removeprefix(_COMPACT)) + 1 if last else 0
        self._renamed(attempt, f"{self.root}/{_COMPACT}{number:012d}")

    def sweep(self) -> None:
        """Delete what the last compacted folder stands for. No reader may be under way."""
        names = self._listed()
        last, covered = self._compacted(names)
        for name in names:
            old = name.startswith(_COMPACT) and name != last
            if old or name.startswith(_BATCH) and name.removeprefix(_BATCH) in covered:
                at, system = _paths(self.spark, f"{self.root}/{name}")
                system.delete(at, True)


# --- the counts of a corpus ------------------------------------------------------------

COUNTED = "id bigint, source string, lang string, same binary, as_text bigint, as_tokens bigint, words bigint"
SHORT = 20  # words; shorter texts are filed under no language
NO_LANG = "und"


def _count(tokenizer: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = token_files.pieces_of(tokenizer, kind, True)
        for batch in batches:
            data, at = words.buffer(batch.column("text"))
            null = batch.column("text").is_null().to_pylist()
            for i, j in words.chunks(at, token_files.CHUNK):
                raw, first = data[at[i] : at[j]], at[i : j + 1] - at[i]
                w = words.split(raw, first, words.SPACED)
                sums = [np.r_[0, np.cumsum(s)] for s in pieces.sizes(w)]
                plain = words.split(raw, first, words.ALNUM)
                same = [None if null[r] else hashlib.sha256(data[at[r] : at[r + 1]]).digest() for r in range(i, j)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(i, j - i) for c in ("id", "source", "lang")],
                        pa.array(same, pa.binary()),
                        *[pa.array(s[w.at[1:]] - s[w.at[:-1]], pa.int64()) for s in sums],
                        pa.array(np.diff(plain.at), pa.int64()),
                    ],
                    names=[c.split()[0] for c in COUNTED.split(", ")],
                )

    return tidy(run)


def counted(
    docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang"
) -> DataFrame:
    """The staged counts of each document: ``as_text`` and ``as_tokens``, ids of the tokenizer
    with names of added tokens in the text taken for text or for tokens, and ``words``, runs of
    digits, letters and characters beyond ASCII. The tokenizer drops white space."""
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("id"),
        F.col(source).cast("string").alias("source"),
        F.col(lang).cast("string").alias("lang"),
        F.col(text).alias("text"),
    )
    run = _count(tokenizer, token_files.id_kind(tokenizer, 0))
    return stage(rows.mapInArrow(run, COUNTED), "token-counts")


def maintained(docs: DataFrame, root: str, tokenizer: str, version: str, **columns) -> DataFrame:
    """The totals of a corpus after its usual life.

    All documents are counted by the tokenizer (its ``version``) and by words. The tokenizer's
    counts are revised, as names of added tokens are no longer text. Texts of fewer than
    SHORT words are filed under no language, by both versions. Exact copies are taken down,
    all but that of the smallest id (null ids after all others, then the first by source and
    language). The first batch is sent again, to no effect."""
    rows = counted(docs, tokenizer, **columns)
    rollup = Rollup(docs.sparkSession, root)
    tokens, count = F.col("as_tokens"), F.col("words")
    first = inserts(rows, F.col("as_text"), version)
    rollup.commit("load-tokens", first)
    rollup.commit("load-words", inserts(rows, count, "words"))
    rollup.commit("revise-tokens", revisions(rows.filter("as_text <> as_tokens"), F.col("as_text"), tokens, version))
    filed = F.when(count < SHORT, F.lit(NO_LANG)).otherwise(F.col("lang"))
    moved = rows.filter(~filed.eqNullSafe(F.col("lang")))
    both = [revisions(moved, n, n, name, new_lang=filed) for n, name in ((tokens, version), (count, "words"))]
    rollup.commit("file-short-texts", *both)
    # all texts go and one of each comes back: no join meets a text's many copies
    texts = rows.filter(F.col("same").isNotNull()).withColumn("lang", filed)
    order = [F.struct(F.col(c).isNull(), F.col(c)).alias(f"by_{c}") for c in ("id", "source", "lang")]
    kept = texts.groupBy("same").agg(F.min(F.struct(*order, "source", "lang", "as_tokens", "words")).alias("k")).select("k.*")
    changes = [deletes(texts, tokens, version), deletes(texts, count, "words")]
    rollup.commit("take-down-copies", *changes, inserts(kept, tokens, version), inserts(kept, count, "words"))
    rollup.commit("load-tokens", first)
    return rollup.totals()
