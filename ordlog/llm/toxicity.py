"""Toxicity of texts: a factorization machine over hashed words.

    score = sigmoid(w0 + sum of w[i] + sum over pairs i < j of <v[i], v[j]>)

over the distinct words of a text (A-Z lower-cased, runs of digits, letters and characters
beyond ASCII), hashed to ``2**BITS`` numbers. The pairs let words count together that don't
count alone. The sum over pairs is half of |sum of v|^2 less the sum of |v|^2, so a text
costs no more than its words.

Training takes at most about ``PER_CLASS`` labelled documents of either label, drawn by a
hash of their id, none of more than ``MOST_WORDS`` different words; both labels weigh alike.
Their hashed words and the model pass the driver. Words of fewer than ``LEAST_DOCS`` of them
count for nothing. All others have a weight and pair factors, also those that tell nothing by
themselves: an insult can be two words of which each is as common in clean texts. Those of
words that are associated with the label by less than ``LEAST_STRENGTH`` are thinned out (L1,
``SPARSE``), or the noise of thousands of them would outweigh the pairs.

Null and empty texts have the score of a text without words; with nothing to learn from
every score is 0. Documents with a null id are neither learned from nor held out. If labels
repeat an id, it is toxic if one of them says so. Very long texts are scored whole. Texts of
the same words tie, whatever else they hold; repeated rows are scored alike; an empty table
gives an empty one. Other columns stay as they are; ``score`` replaces ``toxicity``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordlog.llm import words
from ordlog.llm.shared import tidy

BITS = 20
FACTORS = 4
PER_CLASS = 6000
MOST_WORDS = 5000
LEAST_DOCS = 4
LEAST_STRENGTH = 10.0  # chi-squared, of one degree of freedom
EPOCHS = 20
BATCH = 256
RATE = 0.3
SHRINK = 1e-3  # L2, on pair factors and weights
SPARSE = 6e-4  # L1, on weights and pair factors of words of little association


def _terms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and end row, then distinct (row, hashed word) pairs of these rows."""
    mask = np.uint64((1 << BITS) - 1)
    for i, j, w in words.split_texts(texts, words.ALNUM):
        key = (w.rows() << BITS) | (w.hashes & mask).astype(np.int64)
        key = np.unique(key)
        yield i, j, key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Model:
    place: np.ndarray  # of each hashed word among those of enough documents, -1 for others
    constant: float
    weight: np.ndarray
    factor: np.ndarray  # words x factors

    def raw(self, n: int, row: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid of n texts given as (row, hashed word) pairs."""
        at = self.place[term]
        row, at = row[at >= 0], at[at >= 0]
        out = self.constant + np.bincount(row, self.weight[at], n)
        for f in range(self.factor.shape[1]):
            v = self.factor[at, f]
            out += (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n)) / 2
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(docs: list[np.ndarray], label: np.ndarray, importance: np.ndarray) -> Model | None:
    """A model from the hashed words of each document, its label and its weight."""
    if not len(docs) or len(set(label.tolist())) < 2:
        return None
    importance = importance / importance.mean()
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    term = np.concatenate(docs).astype(np.int64)
    place, strong = _screened(row, term, label, importance)
    at = place[term]
    row, at = row[at >= 0], at[at >= 0]
    bounds = np.searchsorted(row, np.arange(len(docs) + 1))
    rng = np.random.default_rng(7)
    prior = float((importance * label).sum() / importance.sum())
    size = int(place.max()) + 1
    model = Model(place, float(np.log(prior / (1 - prior))), np.zeros(size), rng.normal(0, 0.02, (size, FACTORS)))
    past_w, past_v, past_0 = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3), 1e-3
    for epoch in range(EPOCHS):
        order = rng.permutation(len(docs))
        for a in range(0, len(order), BATCH):
            chosen = order[a : a + BATCH]
            spans = [np.arange(bounds[d], bounds[d + 1]) for d in chosen]
            k = at[np.concatenate(spans)]
            r = np.repeat(np.arange(len(chosen)), [len(s) for s in spans])
            n = len(chosen)
            sums = np.stack([np.bincount(r, model.factor[k, f], n) for f in range(FACTORS)], axis=1)
            raw = model.constant + np.bincount(r, model.weight[k], n)
            squares = (model.factor**2).sum(axis=1)
            raw += ((sums**2).sum(axis=1) - np.bincount(r, squares[k], n)) / 2
            slope = (sigmoid(raw) - label[chosen]) * importance[chosen] / n
            past_0 += slope.sum() ** 2
            model.constant -= RATE * slope.sum() / np.sqrt(past_0)
            used, where = np.unique(k, return_inverse=True)
            g = np.bincount(where, slope[r], len(used)) + SHRINK / n * model.weight[used]
            past_w[used] += g * g
            step = RATE / np.sqrt(past_w[used])
            model.weight[used] = _thinned(model.weight[used] - step * g, np.where(strong[used], 0, SPARSE * step))
            for f in range(FACTORS):
                v = model.factor[k, f]
                g = np.bincount(where, slope[r] * (sums[r, f] - v), len(used)) + SHRINK * model.factor[used, f]
                past_v[used, f] += g * g
                step = 0.25 * RATE / np.sqrt(past_v[used, f])
                model.factor[used, f] = _thinned(model.factor[used, f] - step * g, np.where(strong[used], 0, SPARSE * step))
    return model


def _thinned(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - by, 0)


def _screened(row, term, label, importance) -> tuple[np.ndarray, np.ndarray]:
    """The place of each word of enough documents, and which places are of words associated
    with the label. A word that tells nothing alone may in a pair."""
    docs = np.bincount(term, minlength=1 << BITS)
    weight = np.bincount(term, importance[row], 1 << BITS)
    toxic = np.bincount(term, (importance * label)[row], 1 << BITS)
    rate = (importance * label).sum() / importance.sum()
    strength = (toxic - rate * weight) ** 2 / np.maximum(rate * weight, 1e-9)
    enough = np.flatnonzero(docs >= LEAST_DOCS)
    place = np.full(1 << BITS, -1, np.int32)
    place[enough] = np.arange(len(enough))
    if not len(enough):
        place[0] = 0
        return place, np.zeros(1, bool)
    return place, strength[enough] >= LEAST_STRENGTH


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, row, term in _terms(batch.column("text")):
            at = np.searchsorted(row, np.arange(j - i + 1))
            few = np.flatnonzero(np.diff(at) <= MOST_WORDS)
            chosen = pa.array(few + i)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id").take(chosen),
                    "toxic": batch.column("toxic").take(chosen),
                    "terms": pa.array([term[at[d] : at[d + 1]].astype("<i4").tobytes() for d in few.tolist()], pa.binary()),
                }
            )


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model | None:
    """Fit on labelled documents drawn from those whose id's crc32 is no multiple of 5."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(toxic).cast("int").alias("toxic")).dropna()
    known = known.filter(F.crc32(F.col("id").cast("string")) % 5 != 0).groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chance = F.when(F.col("toxic") == 1, PER_CLASS / counts.get(1, 1)).otherwise(PER_CLASS / counts.get(0, 1))
    drawn = known.filter(draw < chance)  # bounded: about PER_CLASS of either label
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(drawn), "id")
    rows = rows.mapInArrow(_drawn, "id bigint, toxic int, terms binary").collect()
    rows.sort(key=lambda r: (r.id, r.terms))
    label = np.array([r.toxic for r in rows], float)
    found = {k: max(1, int((label == k).sum())) for k in (0, 1)}
    importance = np.array([1 / found[r.toxic] for r in rows], float)
    return fit([np.frombuffer(r.terms, "<i4") for r in rows], label, importance)


def _score(text: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if model:
                for i, j, row, term in _terms(batch.column(text)):
                    score[i:j] = sigmoid(model.raw(j - i, row, term))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "toxicity"])

    return tidy(run)


def score(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` from 0 to 1; a column of that name is replaced."""
    out = docs.drop("toxicity")
    schema = T.StructType([*out.schema.fields, T.StructField("toxicity", T.DoubleType())])
    return out.mapInArrow(_score(text, docs.sparkSession.sparkContext.broadcast(model)), schema)


def report(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """For each document: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on)."""
    model = train(docs, labels, doc_id=doc_id, text=text, toxic=toxic)
    scored = score(docs.select(doc_id, text), model, text=text)
    held_out = F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
    predicted = (F.col("toxicity") >= 0.5).cast("int")
    return scored.select(doc_id, held_out.alias("held_out"), F.col("toxicity").alias("score"), predicted.alias("predicted"))
