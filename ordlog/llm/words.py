"""Words of whole texts as numpy arrays of 64-bit hashes; nothing here knows Spark.

A word is a run of bytes of one kind in the UTF-8 text. All separators are ASCII, so the
bytes of a multi-byte character always fall into one word. Upper-case A-Z count as
lower-case. Two different words get the same hash with a chance of about 2**-64; callers
that must be exact compare the bytes of what they found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 16  # bytes hashed at once; a longer word by itself
CHUNK = 1 << 21  # bytes of texts taken at once

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # of two polynomials, odd
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# each byte's term of the polynomials
_TERMS = [np.random.default_rng(20 + i).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER] for i in (0, 1)]


def _table(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)])


#: Anything but ASCII white space.
SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Digits, letters, and every byte of a character beyond ASCII.
ALNUM = _table(lambda b: b >= 0x80 or chr(b).isascii() and chr(b).isalnum())


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)
_KNOWN = {b: _powers(b, PIECE) for b in _BASES + _INVERSES}


def _power(n: int, base: int) -> np.ndarray:
    known = _KNOWN[base]
    return known[:n] if n <= len(known) else _powers(base, n)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all bits; one to one."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass(frozen=True)
class Words:
    """The words of some rows: row i has words ``at[i]`` to ``at[i + 1]``."""

    data: np.ndarray
    hashes: np.ndarray
    begin: np.ndarray  # first byte of each word in data
    end: np.ndarray
    at: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.begin[i] : self.end[i]].tobytes().lower()

    def second(self, some: np.ndarray) -> np.ndarray:
        """Hashes by another polynomial of the words with these numbers, in rising order."""
        return _hash(self.data, self.begin[some], self.end[some], 1)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array and where each row begins; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def chunks(at: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row comes alone."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, last
        first = last


def split(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> Words:
    """The words of the rows that begin at ``at`` (one more than rows) in ``data``."""
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, _hash(data, begin, end), begin, end, np.searchsorted(begin, at))


def _hash(data: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    out = np.empty(len(begin), np.uint64)
    first = 0
    while first < len(begin):
        base = begin[first]
        last = max(first + 1, int(np.searchsorted(end, base + PIECE, "right")))
        n = int(end[last - 1] - base)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TERMS[which][data[base : base + n]] * _power(n, _BASES[which]), out=sums[1:])
        a, b = begin[first:last] - base, end[first:last] - base
        out[first:last] = (sums[b] - sums[a]) * _power(n, _INVERSES[which])[a] + (b - a).astype(np.uint64)
        first = last
    return mixed(out)


def split_texts(texts: pa.Array, kind: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """Words of an Arrow string array, some rows at a time: first row, end row, words."""
    data, at = buffer(texts)
    for i, j in chunks(at):
        yield i, j, split(data[at[i] : at[j]], at[i : j + 1] - at[i], kind)


def hash_word(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(_hash(raw, np.array([0]), np.array([len(raw)]))[0])


_PLACE = mixed(np.arange(1, 65, dtype=np.uint64) * _U(_BASES[0])) | _U(1)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n words that follow each other, row bounds not looked at."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out += hashes[k : len(hashes) - n + 1 + k] * _PLACE[k]
    return mixed(out)


def shingle_sets(w: Words, n: int) -> list[np.ndarray]:
    """For each row its distinct n-word shingles, sorted; a row of fewer words, but not
    none, has the whole sequence as its one shingle."""
    every = grams(w.hashes, n)
    out = []
    for a, b in zip(w.at[:-1].tolist(), w.at[1:].tolist()):
        if b - a >= n:
            s = np.sort(every[a : b - n + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif b > a:  # the count keeps it apart from shingles of other lengths
            out.append(mixed(grams(w.hashes[a:b], b - a) + _U(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
