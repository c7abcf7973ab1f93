"""Fill-in-the-middle: texts cut in three, the middle put last.

A text is a row of units: a run of the letters A-Z and a-z is one, any other character is
one. Where units begin and end is kept as a set of byte offsets in the manner of Roaring
bitmaps: each stretch of 65,536 offsets has a container that is an array of its members, a
bitmap, or a list of runs, whichever is smallest; running sums of the containers' sizes
stand beside them. The k-th boundary is found by a search in the running sums and a select
within one container. A text's set is built stretch by stretch, so a very long text costs
little more than its bytes.

Both cuts and the form are drawn from a digest of the document's id, so that any rerun and
any split of the input draws the same:

    plain   the text as it is: empty texts, texts that hold a marker, a share of the rest
    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle

A text of a psm or spm row holds no marker and no marker can arise where pieces meet, so
``restored`` gets the exact text back from output and form alone.

Null texts are empty. A null id is drawn for like an empty one. Rows are treated one by
one, so ties, repeated rows and repeated ids don't meet; an empty table gives an empty one.
Only the id and the text are read, and the columns returned are the operator's own, so other
columns, whatever their names, are not in the way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordlog.llm import words
from ordlog.llm.shared import tidy

SEED = "1:"
PLAIN_FROM = 90  # of 100 draws, those from here on stay plain
SPM_BELOW = 20  # of 100 draws, those below become spm
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
OUT_BYTES = 1 << 22  # of outputs in one batch; a longer one comes alone

STRETCH = 1 << 16
ARRAY, BITMAP, RUNS = range(3)
_BITMAP_BYTES = STRETCH // 8
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)


def _letters() -> np.ndarray:
    table = np.zeros(256, bool)
    table[65:91] = table[97:123] = True
    return table


LETTER = _letters()
CONTINUED = np.arange(256) >> 6 == 2  # a byte that goes on with a character


@dataclass(frozen=True)
class Container:
    """Members of one stretch, as offsets from its begin."""

    kind: int
    data: np.ndarray  # array: uint16; bitmap: bytes, low bits first; runs: uint16 pairs
    sums: np.ndarray | None  # runs: members before each run; bitmap: before each byte

    @staticmethod
    def of(members: np.ndarray) -> Container:
        """The smallest container of sorted, distinct members below STRETCH."""
        breaks = np.flatnonzero(members[1:] != members[:-1] + 1)
        n_runs = len(breaks) + 1
        as_array, as_runs = 2 * len(members), 4 * n_runs
        if as_array <= min(as_runs, _BITMAP_BYTES):
            return Container(ARRAY, members.astype(np.uint16), None)
        if as_runs <= _BITMAP_BYTES:
            first = members[np.r_[0, breaks + 1]]
            last = members[np.r_[breaks, len(members) - 1]]
            sums = np.cumsum(last - first + 1) - (last - first + 1)
            return Container(RUNS, np.stack([first, last], axis=1).astype(np.uint16), sums)
        flags = np.zeros(STRETCH, bool)
        flags[members] = True
        bits = np.packbits(flags, bitorder="little")
        ones = _ONES[bits]
        return Container(BITMAP, bits, np.cumsum(ones) - ones)

    def select(self, k: int) -> int:
        """The member with k smaller ones."""
        if self.kind == ARRAY:
            return int(self.data[k])
        at = int(np.searchsorted(self.sums, k, "right")) - 1
        left = k - int(self.sums[at])
        if self.kind == RUNS:
            return int(self.data[at, 0]) + left
        byte = int(self.data[at])
        for _ in range(left):
            byte &= byte - 1  # takes the lowest one out
        return 8 * at + (byte & -byte).bit_length() - 1


class Boundaries:
    """The offsets at which units of a text begin or end, 0 and the text's length included."""

    def __init__(self, text: np.ndarray):
        self.containers: list[Container] = []
        self.keys: list[int] = []
        ends = []
        for begin in range(0, len(text) + 1, STRETCH):
            members = self._members(text, begin)
            if len(members):  # a stretch within one run of letters has none
                self.keys.append(begin)
                self.containers.append(Container.of(members))
                ends.append(len(members))
        #: how many members the containers up to each one hold
        self.sums = np.cumsum(ends)

    @staticmethod
    def _members(text: np.ndarray, begin: int) -> np.ndarray:
        """Boundaries from ``begin`` on, within one stretch, counted from ``begin``."""
        end = min(begin + STRETCH, len(text) + 1)
        here = text[begin:end]  # the end of the text has no byte
        inside = np.zeros(end - begin, bool)
        letter = LETTER[here]
        inside[1 : len(here)] = letter[1:] & letter[:-1]
        if begin and len(here):
            inside[0] = letter[0] and LETTER[text[begin - 1]]
        inside[: len(here)] |= CONTINUED[here]
        return np.flatnonzero(~inside)

    def __len__(self) -> int:
        return int(self.sums[-1])

    def select(self, k: int) -> int:
        """The offset with k smaller boundaries: the end of the k-th unit."""
        at = int(np.searchsorted(self.sums, k, "right"))
        return self.keys[at] + self.containers[at].select(k - (int(self.sums[at - 1]) if at else 0))


def cut(text: np.ndarray, h: list[int]) -> tuple[int, str, int, int]:
    """Units of a text, its form, and both cuts as byte offsets; h are four draws."""
    found = Boundaries(text)
    n = len(found) - 1
    raw = text.tobytes()
    if not raw or h[2] % 100 >= PLAIN_FROM or any(m in raw for m in MARKERS):
        return n, "plain", 0, 0
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return n, "spm" if h[3] % 100 < SPM_BELOW else "psm", found.select(a), found.select(b)


def _moved(text: np.ndarray, form: str, a: int, b: int) -> bytes:
    prefix, middle, suffix = (text[i:j].tobytes() for i, j in ((0, a), (a, b), (b, len(text))))
    p, s, m = MARKERS
    if form == "plain":
        return text.tobytes()
    return b"".join([p, prefix, s, suffix, m, middle] if form == "psm" else [s, suffix, p, prefix, m, middle])


def _chars(text: np.ndarray) -> int:
    return len(text) - int(CONTINUED[text].sum())


_SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = words.buffer(batch.column("text"))
        draws = [batch.column(f"h{k}").to_pylist() for k in range(1, 5)]
        for i, j in words.chunks(at, OUT_BYTES):
            rows = []
            for r in range(i, j):
                text = data[at[r] : at[r + 1]]
                n, form, a, b = cut(text, [h[r] for h in draws])
                sizes = (None, None) if form == "plain" else (_chars(text[:a]), _chars(text[a:b]))
                rows.append((n, form, *sizes, _moved(text, form, a, b)))
            n, form, prefix, middle, output = zip(*rows)
            kinds = pa.int64(), pa.string(), pa.int64(), pa.int64()
            columns = [pa.array(c, k) for c, k in zip((n, form, prefix, middle), kinds)]
            # large offsets: a batch may hold one text of any length
            texts = pa.array(output, pa.large_binary()).view(pa.large_string())
            if sum(map(len, output)) < 1 << 31:
                texts = texts.cast(pa.string())
            ids = batch.column("doc_id").slice(i, j - i)
            names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
            yield pa.RecordBatch.from_arrays([ids, *columns, texts], names=names)


def transformed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its units counted, its form, and its output: doc_id, n, form,
    prefix_chars, middle_chars (null if plain), output."""
    key = F.sha2(F.concat(F.lit(SEED), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(key, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]
    drawn = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), *draws)
    return drawn.mapInArrow(tidy(_transform), _SCHEMA)


def restored(output: str = "output", form: str = "form"):
    """A column: the text that an output was made from."""
    first, second, middle = (F.get(F.split(F.col(output), "<[PSM]>", -1), F.lit(k)) for k in (1, 2, 3))
    psm, spm = F.concat(first, middle, second), F.concat(second, middle, first)
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))


def report(docs: DataFrame, **columns) -> DataFrame:
    """Digests of outputs and of the texts got back from them."""
    done = transformed(docs, **columns)
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )
