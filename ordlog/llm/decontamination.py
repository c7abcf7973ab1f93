"""Benchmark passages in documents: a generalised suffix automaton of the test items.

Texts become words (A-Z lower-cased, then runs of digits, letters and characters beyond
ASCII). The automaton holds every run of words of every item. A document's words are
streamed through it; after each word it knows the longest run that ends there and stands
in some item. A run of ``window`` words, or a whole item of fewer, is a hit.

Items are taken ``block_words`` words at a time, and an item is never split, so neither the
driver nor a task holds more than one block's automaton: a larger benchmark is scanned for in
several passes, one after the other. Each adds to what the passes before it found and is
written down before the next one begins; its automaton is let go then, and so is what the
pass before it wrote.

Nulls and empty texts have no words, so nothing is found in them; items without words are
passed over, and without items nothing is found. Items with a null id count like others and
their hits are cut, but they have no name: the items of a document leave them out. Very long
texts are streamed a piece of some megabytes, or one text, at a time. Rows are treated one by
one: ties, repeated rows and repeated ids don't meet; an empty table gives an empty one. Other
columns stay as they are, whatever their names: what is found goes by a name that no column
has, unless the caller names it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordlog import workspace
from ordlog.llm import words
from ordlog.llm.shared import free_name, tidy

WINDOW = 10
BLOCK_WORDS = 500_000  # some 200 MB of automaton in Python
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


class Automaton:
    """Suffix automaton of several sequences of word ids."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        vocabulary = sorted({w for _, ws in items for w in ws})
        self.words = vocabulary
        ids = {w: i for i, w in enumerate(vocabulary)}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: dict[int, set[str]] = {}
        sequences = [(name, [ids[w] for w in ws]) for name, ws in items if ws]
        for name, sequence in sequences:
            last = 0
            for symbol in sequence:
                last = self._extend(last, symbol)
                self.ends.setdefault(last, set()).update(_named(name))
        self._index(sequences)
        self._arrays(vocabulary, sequences)

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:
            there = self.next[last][symbol]
            if self.length[there] == self.length[last] + 1:
                return there
            return self._clone(last, symbol, there)
        new = self._state(self.length[last] + 1)
        p = last
        while p != -1 and symbol not in self.next[p]:
            self.next[p][symbol] = new
            p = self.link[p]
        if p == -1:
            self.link[new] = 0
        else:
            q = self.next[p][symbol]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, symbol, q)
        return new

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, symbol: int, q: int) -> int:
        copy = self._state(self.length[p] + 1)
        self.next[copy] = dict(self.next[q])
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p != -1 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def _index(self, sequences) -> None:
        """The items of each window's state, and the whole items shorter than a window."""
        n = self.window
        # a window ends in exactly one state of those whose shortest run is no longer
        self.of_window: dict[int, set[str]] = {}
        for state, names in self.ends.items():
            p = state
            while p > 0 and self.length[self.link[p]] >= n:
                p = self.link[p]
            if self.length[p] >= n:
                self.of_window.setdefault(p, set()).update(names)
        # the states above a window's state hold the same window in other contexts
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        for name, sequence in sequences:
            if len(sequence) < n:
                state = 0
                for symbol in sequence:
                    state = self.next[state][symbol]
                self.short.setdefault(state, []).append((len(sequence), name))
        self.shortest = min([n, *(len(s) for _, s in sequences)])

    def _arrays(self, vocabulary: list[bytes], sequences) -> None:
        """What finds the stretches that are worth streaming."""
        raw = b" ".join(vocabulary)
        table = words.split(
            np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), words.ALNUM
        ).hashes
        order = np.argsort(table)
        self.hashes, self.ids = table[order], order
        size = max(1, len(vocabulary))
        pairs = {a * size + b for _, s in sequences for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.low = np.zeros(1 << 16, bool)
        self.low[(table & np.uint64(0xFFFF)).astype(np.int64)] = True

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The id of each word, -1 if no item has it."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.low[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            same = self.hashes[at] == hashes[maybe]
            out[maybe[same]] = self.ids[at[same]]
        return out

    def stretches(self, w: words.Words, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words, within a row, whose neighbours all are neighbours in some item.

        Any run of the length looked for lies whole within one of them."""
        known = ids >= 0
        if len(ids) < 1 or not len(self.hashes):
            return
        linked = known[:-1] & known[1:]
        inner = w.at[1:-1]
        inner = inner[(inner > 0) & (inner < len(ids))]
        linked[inner - 1] = False
        at = np.flatnonzero(linked)
        if len(at):
            pair = ids[at] * len(self.words) + ids[at + 1]
            place = np.minimum(np.searchsorted(self.pairs, pair), max(0, len(self.pairs) - 1))
            linked[at] = self.pairs[place] == pair if len(self.pairs) else False
        begins = known.copy()
        begins[1:] &= ~linked
        ends = known.copy()
        ends[:-1] &= ~linked
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        long = last - first >= self.shortest
        yield from zip(first[long].tolist(), last[long].tolist())

    def stream(self, symbols: list[int]) -> Iterator[tuple[int, int, list[str]]]:
        """Hits of a stretch: first word, end, items with the window that ends there."""
        state, length, n = 0, 0, self.window
        for i, symbol in enumerate(symbols):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(symbol, 0)
            length = length + 1 if state else 0
            p, reach = state, length
            while p > 0:
                for size, name in self.short.get(p, ()):
                    if size <= reach:
                        yield i + 1 - size, i + 1, _named(name)
                below = self.length[self.link[p]]
                if below < n <= reach:
                    yield i + 1 - n, i + 1, sorted(self.of_window.get(p, ()))
                if not self.short and below < n:
                    break
                p, reach = self.link[p], below


def _named(name: str | None) -> list[str]:
    return [] if name is None else [name]


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _find(automaton: Automaton, texts: pa.Array) -> tuple[list[int], list, list]:
    """For each text its number of words, merged hits (in words) and items."""
    counts: list[int] = []
    hits: list[list] = []
    items: list[list[str]] = []
    for i, j, w in words.split_texts(texts, words.ALNUM):
        counts += np.diff(w.at).tolist()
        found = [[] for _ in range(i, j)]
        names = [set() for _ in range(i, j)]
        ids = automaton.lookup(w.hashes)
        for first, last in automaton.stretches(w, ids):
            symbols = ids[first:last].tolist()
            for k, symbol in enumerate(symbols):
                if w.text(first + k) != automaton.words[symbol]:
                    symbols[k] = -1  # another word of the same hash
            row = int(np.searchsorted(w.at, first, "right")) - 1
            for a, b, who in automaton.stream(symbols):
                found[row].append((first + a - int(w.at[row]), first + b - int(w.at[row])))
                names[row].update(who)
        hits += [_merged(x) for x in found]
        items += [sorted(x) for x in names]
    return counts, hits, items


def _found(counts: list, hits: list, items: list) -> pa.StructArray:
    columns = [
        pa.array(counts, pa.int64()),
        pa.array(hits, pa.list_(pa.list_(pa.int64()))),
        pa.array(items, pa.list_(pa.string())),
    ]
    return pa.StructArray.from_arrays(columns, names=FOUND.fieldNames())


def _scan(text: str, model, first: bool, max_coverage: float | None, name: str):
    """Add what one block finds. Given ``max_coverage`` this is the last block: texts are cut,
    rows that are covered further go, and so does the column of finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.value
        for batch in batches:
            counts, hits, items = _find(automaton, batch.column(text))
            if not first:
                before = batch.column(name)
                old_hits, old_items = before.field("hits").to_pylist(), before.field("items").to_pylist()
                hits = [_merged([*map(tuple, a), *map(tuple, b)]) for a, b in zip(old_hits, hits)]
                items = [sorted({*a, *b}) for a, b in zip(old_items, items)]
                batch = batch.drop_columns([name])
            if max_coverage is None:
                found = _found(counts, hits, items)
                yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, name])
            else:
                yield _cut(batch, text, counts, hits, max_coverage)

    return tidy(run)


def _cut(batch: pa.RecordBatch, text: str, counts: list, hits: list, max_coverage: float) -> pa.RecordBatch:
    """Texts without their hits, and without the rows that are mostly hit."""
    hit = [sum(b - a for a, b in spans) for spans in hits]
    if any(hit):
        at = batch.schema.get_field_index(text)
        new = [_without(v.as_py(), spans) if spans else v.as_py() for v, spans in zip(batch.column(text), hits)]
        columns = list(batch.columns)
        columns[at] = pa.array(new, batch.schema.field(at).type)
        batch = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    return batch.filter(pa.array([h <= max_coverage * n for h, n in zip(hit, counts)], pa.bool_()))


def _blocks(items: DataFrame, item_id: str, text: str, block_words: int):
    """Items with their words, ``block_words`` at a time; an item is never split."""
    block, size = [], 0
    rows = items.select(F.col(item_id).cast("string"), F.col(text))
    for name, value in rows.toLocalIterator():
        found = next(words.split_texts(pa.array([value], pa.string()), words.ALNUM), None)
        if found is None or not len(found[2].hashes):
            continue
        block.append((name, [found[2].text(i) for i in range(len(found[2].hashes))]))
        size += len(block[-1][1])
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def find(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    found: str = "found",
) -> DataFrame:
    """``docs`` with a struct ``found``: n_words, hits (merged [first, end) in words), items.

    A column of that name that is already there is replaced."""
    return _scanned(docs.drop(found), items, None, text, item_id, item_text, window, block_words, found)


def _scanned(docs, items, max_coverage, text, item_id, item_text, window, block_words, name) -> DataFrame:
    spark = docs.sparkSession
    blocks = _blocks(items, item_id, item_text, block_words)
    block = next(blocks, [])  # without items the words are counted all the same
    out, before = docs, None
    while True:
        following = next(blocks, None)
        model = spark.sparkContext.broadcast(Automaton(block, window))
        last = following is None and max_coverage is not None
        schema = docs.schema if last else T.StructType([*docs.schema.fields, T.StructField(name, FOUND)])
        out = out.mapInArrow(_scan(text, model, before is None, max_coverage if last else None, name), schema)
        if following is None:
            return out
        path = workspace.fresh(spark, "scanned")
        out.write.parquet(path)
        model.destroy()
        if before:
            workspace.drop(spark, before)
        out, before, block = spark.read.schema(schema).parquet(path), path, following


def covered(found: str = "found") -> Column:
    """Words inside hits."""
    sizes = F.transform(F.col(f"{found}.hits"), lambda h: h[1] - h[0])
    return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _without(value: str, spans: list[list[int]]) -> str:
    raw = value.encode()
    data = np.frombuffer(raw, np.uint8)
    w = words.split(data, np.array([0, len(data)]), words.ALNUM)
    parts, last = [], 0
    for a, b in spans:
        parts.append(raw[last : int(w.begin[a])])
        last = int(w.end[b - 1])
    parts.append(raw[last:])
    return b"".join(parts).decode()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    max_coverage: float = 0.5,
) -> DataFrame:
    """Cut the hits out of the texts; a document of which more than ``max_coverage`` is
    hit goes as a whole. The columns are those of ``docs``, clean documents stay as is."""
    name = free_name(docs, "found")
    return _scanned(docs, items, max_coverage, text, item_id, item_text, window, block_words, name)


def report(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """For each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    text = options.pop("text", "text")
    named = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    found = find(named, items, **options)
    return found.select(
        F.col("id").alias(doc_id),
        F.col("found.n_words").alias("n_words"),
        covered().alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"),
        (covered() > 0).alias("contaminated"),
    )
