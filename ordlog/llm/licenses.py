"""License notices in documents: an exact set-similarity join of text blocks with templates.

A paragraph is a run of lines that all have words; a block is a window of ``LINES``
neighbouring lines of a paragraph, or all of a shorter one, so a notice is found however it
is wrapped over so many lines. Blocks and templates become sets of words (A-Z lower-cased,
runs of digits, letters and characters beyond ASCII). A block matches a template when it
holds at least ``threshold`` of the template's words. All matches are found, by

* one global order of words, rarest first, by the number of lines of all documents that
  hold them;
* prefixes: of a template of n words that must share o, one of its n - o + 1 rarest words
  is also among the block's as many rarest ones, so only those are looked up;
* length: a block with fewer than o template words can't match;
* position: the words after the first common one must still suffice for o;

and a check of what is left. Words that no template has count as the rarest of a block:
they can't match, so a block's prefix is taken from its other words alone.

Beside that, labels follow from fixed phrases whose words stand consecutively, on whatever
lines. Templates are a bounded set: their words are broadcast, ``MAX_WORDS`` at most.

Null and empty texts have no blocks, no phrases and an empty string of labels; without
templates or phrases none are found. Very long texts are taken one at a time, whole. Rows
are treated one by one, so ties, repeated rows and repeated ids don't meet; an empty table
gives an empty one. Other columns stay as they are: what is found replaces a column of the
name given for it, ``found``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordlog.llm import words
from ordlog.llm.shared import tidy

THRESHOLD = 0.92  # notices that differ in one telling word must not match each other
MAX_WORDS = 1_000_000  # of all templates
LINES = 3  # over which a notice may be wrapped

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Short notices by which common licenses are declared, and their labels.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2", "This program is licensed under the GNU General Public License, version 2"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("agpl-3", "Licensed under the GNU Affero General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("base", T.ArrayType(T.StringType())),
        T.StructField("matched", T.ArrayType(T.StringType())),
        T.StructField("containment", T.DoubleType()),
    ]
)


def _words(value: str) -> list[bytes]:
    raw = np.frombuffer(value.encode(), np.uint8)
    w = words.split(raw, np.array([0, len(raw)]), words.ALNUM)
    return [w.text(i) for i in range(len(w.hashes))]


@dataclass
class Templates:
    """The templates' words and, once these are counted, the index of their prefixes."""

    labels: list[str]
    sets: list[set[bytes]]
    need: list[int]
    phrases: list[tuple[list[bytes], np.ndarray, str]]
    words: list[bytes] = field(default_factory=list)
    rank: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def __post_init__(self):
        self.words = sorted(set().union(*self.sets)) if self.sets else []
        if len(self.words) > MAX_WORDS:
            raise ValueError(f"the templates have more than {MAX_WORDS} different words")
        raw = b" ".join(self.words)
        hashes = words.split(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), words.ALNUM).hashes
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def count(self, lines_with: dict[bytes, int]) -> None:
        """Fix the global order and index the templates' prefixes."""
        by_rarity = sorted(range(len(self.words)), key=lambda i: (lines_with.get(self.words[i], 0), self.words[i]))
        self.rank = np.empty(len(self.words), np.int64)
        self.rank[by_rarity] = np.arange(len(self.words))
        place = {w: int(self.rank[i]) for i, w in enumerate(self.words)}
        self.ranked = [sorted(place[w] for w in s) for s in self.sets]
        self.index: dict[int, list[tuple[int, int]]] = {}
        for t, (r, o) in enumerate(zip(self.ranked, self.need)):
            for j, token in enumerate(r[: len(r) - o + 1]):
                self.index.setdefault(token, []).append((t, j))
        self.starts = np.zeros(len(self.words) + 1, bool)
        self.starts[list(self.index)] = True
        self.least = min(self.need, default=1)

    def match(self, block: list[int]) -> Iterator[tuple[int, float]]:
        """The templates that a block, as sorted ranks of its template words, contains."""
        size, seen = len(block), set()
        for i, token in enumerate(block[: max(0, size - self.least + 1)]):
            for t, j in self.index.get(token, ()):
                o = self.need[t]
                if t in seen or size < o or 1 + min(size - i, len(self.ranked[t]) - j) - 1 < o:
                    continue
                seen.add(t)
                common = len(set(block) & set(self.ranked[t]))
                if common >= o:
                    yield t, common / len(self.ranked[t])


def _prepared(templates, phrases, threshold: float) -> Templates:
    kept = [(label, set(_words(value))) for label, value in templates if value and label]
    kept = [(label, s) for label, s in kept if s]
    spoken = []
    for phrase, label in phrases.items():
        parts = _words(phrase)
        if parts:
            spoken.append((parts, np.array([words.hash_word(p.decode()) for p in parts], np.uint64), label))
    need = [max(1, math.ceil(threshold * len(s) - 1e-9)) for _, s in kept]
    return Templates([label for label, _ in kept], [s for _, s in kept], need, spoken)


def _lines(w: words.Words, first_byte: np.ndarray) -> np.ndarray:
    """The line of each word; a line ends with its row."""
    breaks = np.union1d(np.flatnonzero(w.data == 0x0A), first_byte[1:-1])
    return np.searchsorted(breaks, w.begin, "right")


def _tokens(model: Templates, w: words.Words, first_byte: np.ndarray):
    """Distinct (line, template word) pairs, and a word of each."""
    ids = model.lookup(w.hashes)
    at = np.flatnonzero(ids >= 0)
    line = _lines(w, first_byte)[at] if len(at) else at
    return _distinct(model, line, ids[at], at)


def _distinct(model: Templates, place: np.ndarray, token: np.ndarray, at: np.ndarray):
    size = max(1, len(model.words))
    pair, one = np.unique(place * size + token, return_index=True)
    return pair // size, pair % size, at[one]


def _blocks(model: Templates, w: words.Words, first_byte: np.ndarray):
    """Distinct (block, template word) pairs, and a word of each; a block has the number of
    its first line."""
    ids = model.lookup(w.hashes)
    at = np.flatnonzero(ids >= 0)
    if not len(at):
        return at, at, at
    line = _lines(w, first_byte)
    opens = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])  # first words of the lines that have words
    number = line[opens]
    row = np.searchsorted(w.at, opens, "right")
    begins = np.r_[True, (number[1:] != number[:-1] + 1) | (row[1:] != row[:-1])]
    nth = np.arange(len(number))
    first = np.maximum.accumulate(np.where(begins, nth, 0))
    ends = np.r_[begins[1:], True]
    last = np.minimum.accumulate(np.where(ends, nth, len(nth))[::-1])[::-1]
    mine = np.searchsorted(opens, at, "right") - 1
    low = np.maximum(first[mine], mine - LINES + 1)
    high = np.minimum(mine, np.maximum(first[mine], last[mine] - LINES + 1))
    many = high - low + 1
    block = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return _distinct(model, block, np.repeat(ids[at], many), np.repeat(at, many))


def _count(text: str, shared):
    """How many lines hold each template word, one row for each task and word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sums = shared.value, Counter()
        for batch in batches:
            data, at = words.buffer(batch.column(text))
            for i, j in words.chunks(at):
                first_byte = at[i : j + 1] - at[i]
                w = words.split(data[at[i] : at[j]], first_byte, words.ALNUM)
                _, token, _ = _tokens(model, w, first_byte)
                for t, n in zip(*np.unique(token, return_counts=True)):
                    sums[model.words[t].decode()] += int(n)
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(list(sums), pa.string()), "n": pa.array(list(sums.values()), pa.int64())}
        )

    return tidy(run)


def _places(model: Templates, w: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """First words of the phrases' occurrences, and which phrase."""
    starts, which = [], []
    row = None
    for k, (parts, hashes, _) in enumerate(model.phrases):
        n = len(parts)
        if len(w.hashes) < n:
            continue
        at = np.flatnonzero(w.hashes[: len(w.hashes) - n + 1] == hashes[0])
        for step in range(1, n):
            at = at[w.hashes[at + step] == hashes[step]]
        if len(at):
            row = w.rows() if row is None else row
            at = at[row[at] == row[at + n - 1]]
            at = np.array([i for i in at.tolist() if [w.text(i + s) for s in range(n)] == parts], np.int64)
        starts.append(at)
        which.append(np.full(len(at), k))
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts, which = np.concatenate(starts), np.concatenate(which)
    order = np.lexsort((which, starts))
    return starts[order], which[order]


def _join(text: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            n_words: list[int] = []
            places, base, matched, best = [], [], [], []
            data, at = words.buffer(batch.column(text))
            for i, j in words.chunks(at):
                first_byte = at[i : j + 1] - at[i]
                w = words.split(data[at[i] : at[j]], first_byte, words.ALNUM)
                n_words += np.diff(w.at).tolist()
                spots = [[] for _ in range(i, j)]
                named = [set() for _ in range(i, j)]
                labels = [set() for _ in range(i, j)]
                score = [0.0] * (j - i)
                for start, phrase in zip(*(x.tolist() for x in _places(model, w))):
                    row = int(np.searchsorted(w.at, start, "right")) - 1
                    spots[row].append(start - int(w.at[row]))
                    named[row].add(model.phrases[phrase][2])
                for row, t, share in _matches(model, w, first_byte):
                    labels[row].add(model.labels[t])
                    score[row] = max(score[row], share)
                places += spots
                base += [sorted(x) for x in named]
                matched += [sorted(x) for x in labels]
                best += score
            found = pa.StructArray.from_arrays(
                [
                    pa.array(n_words, pa.int64()),
                    pa.array(places, pa.list_(pa.int64())),
                    pa.array(base, pa.list_(pa.string())),
                    pa.array(matched, pa.list_(pa.string())),
                    pa.array(best, pa.float64()),
                ],
                names=FOUND.fieldNames(),
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "found"])

    return tidy(run)


def _matches(model: Templates, w: words.Words, first_byte: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """Row, template and containment of every matching block."""
    block_of, token, at = _blocks(model, w, first_byte)
    if not len(at):
        return
    rank = model.rank[token]
    bounds = np.flatnonzero(np.r_[True, block_of[1:] != block_of[:-1], True])
    # only a block with a word of some template's prefix can match, and not one that is too short
    hopeful = np.add.reduceat(model.starts[rank].astype(np.int64), bounds[:-1]) > 0
    hopeful &= np.diff(bounds) >= model.least
    for k in np.flatnonzero(hopeful).tolist():
        here = slice(bounds[k], bounds[k + 1])
        words_here = zip(rank[here].tolist(), token[here].tolist(), at[here].tolist())
        block = sorted(r for r, t, i in words_here if w.text(i) == model.words[t])
        for t, share in model.match(block):
            yield int(np.searchsorted(w.at, at[bounds[k]], "right")) - 1, t, share


def find(
    docs: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None,
    *,
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with a struct ``found``: n_words, places and base labels of the phrases,
    labels of matched templates and the highest containment of a matched template (0 if
    there is none). A column ``found`` that is already there is replaced."""
    spark = docs.sparkSession
    model = _prepared(
        TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases, threshold
    )
    before = spark.sparkContext.broadcast(model)
    counts = docs.select(text).mapInArrow(_count(text, before), "word string, n bigint")
    model.count({r.word: r.n for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()})
    out = docs.drop("found")
    schema = T.StructType([*out.schema.fields, T.StructField("found", FOUND)])
    return out.mapInArrow(_join(text, spark.sparkContext.broadcast(model)), schema)


def report(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """For each document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels and score (1 if a phrase stands there, else the best containment)."""
    named = docs.select(F.col(doc_id).alias("id"), F.col(options.pop("text", "text")).alias("text"))
    f = find(named, **options)
    return f.select(
        F.col("id").alias(doc_id),
        F.col("found.n_words").alias("n_words"),
        F.size("found.places").cast("bigint").alias("n_base"),
        F.array_min("found.places").alias("first_word"),
        F.array_max("found.places").alias("last_word"),
        F.concat_ws(",", "found.base").alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("found.base", "found.matched"))).alias("labels"),
        F.when(F.size("found.places") > 0, 1.0).otherwise(F.col("found.containment")).alias("score"),
    )
