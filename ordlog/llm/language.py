"""Language of texts by string kernels.

The kernel of two texts is the number of n-grams of 1 to 3 characters (a blended spectrum)
that both have, whether once or often, over the geometric mean of the numbers each has.
Characters are lower-cased; every letter is told apart, all else is one blank.

Some training texts of each language are landmarks (Nystroem): a text becomes its kernels
with the landmarks, times the inverse root of the landmarks' own kernel matrix. On these
features one ridge regression for each language separates it from all others. Texts are
scored a batch at a time: a 0/1 matrix of n-grams times the landmarks' n-grams, divided by
the norms, times the weights.

The regressions say which language is the most likely one, not whether it is one of them:
of L languages the best always has 1/L or more. Whether a text is like anything learned is
seen from its n-grams: the share of them that any landmark has. It must be nearer to the share
of the training texts (landmarks judged by the other landmarks) than to that of the same
texts with their characters in random order, less what chance does to a short text.

Training takes about ``PER_LANGUAGE`` documents of a language, and ``TRAINED`` of all
languages, drawn by a hash of their id; of a document longer than ``PASSAGE`` characters a
passage of that length at a place drawn by the hash. They and the model pass the driver. All
else runs where the rows are and reads whole texts.

Null texts and texts without a letter are ``und`` with score 0, and so is everything if there
is nothing to learn from. Documents with a null id are not learned from and not held out.
Ties between languages go to the first by name. Very long texts are scored whole, one at a
time. Rows are treated one by one, so repeated rows and ids don't meet; an empty table gives
an empty one. Other columns stay as they are, whatever their names: what is found goes by a
name that no column has, unless the caller names it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordlog.llm.shared import BROADCAST_ROWS, free_name, tidy

PER_LANGUAGE = 600
TRAINED = 20_000
PASSAGE = 5_000
LANDMARKS = 32  # of each language
ALL_LANDMARKS = 1024
RIDGE = 1e-3
BATCH = 128
PIECE = 1 << 20  # characters looked at once
LEAST = 0.01  # so many of the training texts may have a lower share of known n-grams
SLACK = 2  # standard deviations
UNKNOWN = "und"

FEW_KINDS = 64
_BITS = 21  # of a code point
_BLANK, _FIRST = 1, 2


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=1)
def _numbers() -> np.ndarray:
    return np.zeros(0x110000 + _FIRST, np.int32)


def symbols(text: str) -> np.ndarray:
    """A number for each character: its own for a letter, one for all else."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters()[points], points + np.uint32(_FIRST), np.uint32(_BLANK)).astype(np.int64)


def _distinct(s: np.ndarray) -> np.ndarray:
    """The distinct n-grams of a text's symbols, sorted: single ones, then pairs, then triples."""
    kinds = np.unique(s)
    n = len(kinds)
    if n > FEW_KINDS:
        two = s[:-1] << _BITS | s[1:]
        return np.unique(np.concatenate([s, two, two[:-1] << _BITS | s[2:]]))
    # of few different symbols all triples have a place of their own
    number = _numbers()
    number[kinds] = np.arange(n, dtype=np.int32)
    a = number[s]
    two = a[:-1] * n + a[1:]
    seen = np.zeros(n + n**2 + n**3, bool)
    seen[a] = seen[two + n] = seen[two[:-1] * n + a[2:] + (n + n**2)] = True
    at = np.flatnonzero(seen)
    pairs, triples = np.searchsorted(at, [n, n + n**2])
    first, second = np.divmod(at[pairs:triples] - n, n)
    front, third = np.divmod(at[triples:] - (n + n**2), n)
    pair = lambda x, y: kinds[x] << _BITS | kinds[y]
    return np.concatenate([kinds[at[:pairs]], pair(first, second), pair(*np.divmod(front, n)) << _BITS | kinds[third]])


def grams(text: str) -> np.ndarray:
    """The distinct n-grams of a text, sorted; none if it has no letter."""
    pieces = [symbols(text[a : a + PIECE + 2]) for a in range(0, len(text), PIECE)]
    if not any((s != _BLANK).any() for s in pieces):
        return np.empty(0, np.int64)
    found = [_distinct(s) for s in pieces]
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


@dataclass
class Model:
    languages: list[str]
    kinds: np.ndarray  # the landmarks' n-grams, sorted
    landmarks: np.ndarray  # n-grams x landmarks, a bit each
    norms: np.ndarray
    weights: np.ndarray  # landmarks and a constant x languages
    least: float = 0.0  # share of a long text's n-grams that landmarks have at least

    def places(self, row: np.ndarray) -> np.ndarray:
        """Where those of a text's n-grams stand that a landmark has."""
        at = np.minimum(np.searchsorted(self.kinds, row), len(self.kinds) - 1)
        return at[self.kinds[at] == row]

    def kernel(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Kernels of some texts with the landmarks, and the shares that landmarks have."""
        at = [self.places(r) for r in rows]
        columns, which = np.unique(np.concatenate(at), return_inverse=True)
        sizes = np.array([len(a) for a in at])
        present = np.zeros((len(rows), len(columns)), np.float32)
        present[np.repeat(np.arange(len(rows)), sizes), which] = 1
        theirs = np.unpackbits(self.landmarks[columns], axis=1, count=len(self.norms)).astype(np.float32)
        n = np.maximum(1, [len(r) for r in rows])
        return (present @ theirs) / (np.sqrt(n)[:, None] * self.norms), sizes / n

    def familiar(self, share: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Texts of n n-grams with this share of known ones that are like what was learned: a
        character is in three of them, so a third of n are draws of their own."""
        return share >= self.least - SLACK * np.sqrt(self.least * (1 - self.least) * 3 / n)

    def decide(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        kernel, share = self.kernel(rows)
        return kernel @ self.weights[:-1] + self.weights[-1], share


def _judge(model: Model, texts: list[str], chosen: list[int], rows: list[np.ndarray]) -> float:
    """The share of known n-grams that parts texts like the training texts from others."""
    held = np.unpackbits(model.landmarks, axis=1, count=len(chosen)).sum(axis=1)
    marks, draw = set(chosen), np.random.default_rng(0)
    like, unlike = [], []
    for i, text in enumerate(texts):
        at = model.places(rows[i])
        # a landmark's own n-grams count if another one has them too
        like.append(((held[at] > 1).sum() if i in marks else len(at)) / len(rows[i]))
        mixed = _distinct(draw.permutation(symbols(text)))
        unlike.append(len(model.places(mixed)) / len(mixed))
    low = float(np.quantile(like, LEAST))
    return min(low, (low + float(np.median(unlike))) / 2)


def fit(texts: list[str], languages: list[str]) -> Model | None:
    """A model from whole texts and their languages, in the order given."""
    pairs = [(t, c, g) for t, c in zip(texts, languages) if len(g := grams(t))]
    if not pairs:
        return None
    texts, languages, rows = (list(x) for x in zip(*pairs))
    names = sorted(set(languages))
    each = max(1, min(LANDMARKS, ALL_LANDMARKS // len(names)))
    chosen: list[int] = []
    taken: Counter = Counter()
    for i, language in enumerate(languages):
        if taken[language] < each:
            taken[language] += 1
            chosen.append(i)
    kinds = np.unique(np.concatenate([rows[i] for i in chosen]))
    marks = np.zeros((len(kinds), -(-len(chosen) // 8)), np.uint8)
    for k, i in enumerate(chosen):
        marks[np.searchsorted(kinds, rows[i]), k // 8] |= 128 >> k % 8
    norms = np.sqrt([len(rows[i]) for i in chosen])
    model = Model(names, kinds, marks, norms, np.zeros(0))
    model.least = _judge(model, texts, chosen, rows)

    own = model.kernel([rows[i] for i in chosen])[0].astype(np.float64)
    value, vector = np.linalg.eigh((own + own.T) / 2)
    keep = value > 1e-8 * value[-1]
    root = vector[:, keep] / np.sqrt(value[keep])
    features = np.concatenate([model.kernel(rows[a : a + BATCH])[0] for a in range(0, len(rows), BATCH)]) @ root
    target = np.where(np.array(languages)[:, None] == np.array(names), 1.0, -1.0)
    # each language counts alike, however many documents it has
    share = Counter(languages)
    weight = np.array([1 / share[c] for c in languages])[:, None] / len(names)
    center, aim = (weight * features).sum(axis=0), (weight * target).sum(axis=0)
    x, y = features - center, target - aim
    inner = np.linalg.solve(x.T @ (weight * x) + RIDGE * np.eye(x.shape[1]), x.T @ (weight * y))
    model.weights = np.concatenate([root @ inner, (aim - center @ inner)[None, :]])
    return model


def _score(text: str, shared, found: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names = [UNKNOWN] * batch.num_rows
            scores, known = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            values = batch.column(text)
            for a in range(0, batch.num_rows if model else 0, BATCH):
                at, rows = [], []
                for i, value in enumerate(values.slice(a, BATCH), a):
                    row = grams(value.as_py() or "")
                    if len(row):
                        at.append(i)
                        rows.append(row)
                if rows:
                    decision, share = model.decide(rows)
                    best = decision.argmax(axis=1)
                    scores[at] = np.clip((decision[np.arange(len(at)), best] + 1) / 2, 0, 1)
                    known[at] = model.familiar(share, np.array([len(r) for r in rows]))
                    for i, b in zip(at, best.tolist()):
                        names[i] = model.languages[b]
            columns = [pa.array(names, pa.string()), pa.array(scores), pa.array(known)]
            struct = pa.StructArray.from_arrays(columns, names=["lang", "score", "familiar"])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, found])

    return tidy(run)


def learned_from(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 != 1, F.lit(False))


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", eligible: Column | None = None) -> Model | None:
    """Fit on documents drawn from the ``eligible`` ones (by default those that ids pick)."""
    rows = docs.filter((learned_from(doc_id) if eligible is None else eligible) & F.col(lang).isNotNull())
    rows = rows.select(
        F.xxhash64(doc_id).alias("hash"), F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    ).filter("text is not null")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    size = counts.agg(F.count("*")).first()[0]
    each = min(PER_LANGUAGE, -(-TRAINED // max(1, size)))
    chance = counts.select(F.col("lang").alias("of"), (F.lit(float(each)) / F.col("n")).alias("chance"))
    chance = F.broadcast(chance) if size <= BROADCAST_ROWS else chance
    # a language's documents are drawn with the same chance, by a hash of the id
    draw = F.pmod("hash", F.lit(1 << 30)) / F.lit(float(1 << 30))
    begin = F.pmod(F.shiftright("hash", 30), F.greatest(F.char_length("text") - PASSAGE + 1, F.lit(1))) + 1
    passage = F.substring("text", begin.cast("int"), F.lit(PASSAGE))
    drawn = rows.join(chance, F.col("lang") == F.col("of")).filter(draw < F.col("chance"))
    drawn = drawn.select(passage.alias("text"), "lang", "hash", "id").collect()
    drawn.sort(key=lambda r: (r[2], r[3], r[0]))
    unique = {r[0]: r[1] for r in reversed(drawn)}
    return fit(list(unique), list(unique.values()))


def identify(docs: DataFrame, model: Model | None, *, text: str = "text", found: str = "found") -> DataFrame:
    """``docs`` with a struct of lang, score and familiar, named ``found``; a column of that
    name is replaced."""
    out = docs.drop(found)
    kind = T.StructType().add("lang", T.StringType()).add("score", T.DoubleType()).add("familiar", T.BooleanType())
    schema = T.StructType([*out.schema.fields, T.StructField(found, kind)])
    return out.mapInArrow(_score(text, docs.sparkSession.sparkContext.broadcast(model), found), schema)


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """For each document: doc_id, held_out, lang_pred and score (0 to 1)."""
    model = train(docs, doc_id=doc_id, text=text, lang=lang)
    name = free_name(docs, "found")
    found = identify(docs.select(doc_id, text), model, text=text, found=name)
    held_out = F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
    lang_pred, score = F.col(name)["lang"].alias("lang_pred"), F.col(name)["score"].alias("score")
    return found.select(doc_id, held_out.alias("held_out"), lang_pred, score)


def recognised(docs: DataFrame, *, min_score: float = 0.0, **columns) -> DataFrame:
    """The documents that are like what was learned of some language, and whose language is
    recognised with at least ``min_score``. All columns stay as they are."""
    model = train(docs, **columns)
    name = free_name(docs, "found")
    found = identify(docs, model, text=columns.get("text", "text"), found=name)
    good = F.col(name)["familiar"] & (F.col(name)["score"] >= min_score)
    return found.filter(good).select(*[F.col(f"`{c}`") for c in docs.columns])
