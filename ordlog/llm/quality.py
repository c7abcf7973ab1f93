"""Quality of documents: their own evidence, and that of the site they come from.

A logistic regression on what a text looks like (lengths, shares of letters, digits and
signs, repeated words and lines) gives each document its evidence. A site is a host and a
path below it, two or more columns from the widest on. Sites' evidence is pooled level by
level: the posterior of a site is

    (strength * posterior of the site around it + sum of its documents' evidence)
    / (strength + number of its documents)

so a site of few documents stays near what is around it, the host near the global mean and
the path near its host. The strengths are empirical Bayes estimates by moments: evidence's
variance within sites of a level over the variance of their means around the level above.
A document's score adds, in log odds, what its path says beyond the global mean to its own
evidence. What the path says is the posterior of its other documents: the document's own
evidence is taken out of the sums of every level, so it counts once.

Sites' sums are partial aggregates; documents meet their site's row in a broadcast join of a
counted number of sites, else in a join that Spark can split, so a site with a third of all
documents does no harm. Training takes about ``PER_CLASS`` labelled documents of either
label, drawn by a hash of their id; ten numbers of each pass the driver.

Null and empty texts have the evidence of an empty text, very long ones that of all of
their words. A null host or path is a site of its own; the only document of a site has what
is around it. With nothing to learn from all evidence is 0.5. If labels repeat an id it
counts as good if one of them says so. Rows are scored one by one, equal ones alike;
repeated rows count as often in their site as they stand there. Only the named columns are
read, so others are not in the way. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordlog.llm import words
from ordlog.llm.shared import BROADCAST_ROWS, stage, tidy

PER_CLASS = 3000
STEPS = 60
RIDGE = 1e-3
MIXED_MOST = 1000.0  # strongest prior, in documents; sites that all agree get no more
_LETTER = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SIGN = np.array([33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'-" for b in range(256)])
FEATURES = 10


def _shares(table: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.r_[0, np.cumsum(table[data])]
    return (sums[at[1:]] - sums[at[:-1]]) / np.maximum(1, np.diff(at))


def features(texts: pa.Array) -> np.ndarray:
    """What each text looks like, in FEATURES numbers."""
    out = [np.zeros((0, FEATURES))]
    data, at = words.buffer(texts)
    for i, j in words.chunks(at):
        raw, first = data[at[i] : at[j]], at[i : j + 1] - at[i]
        w = words.split(raw, first, words.SPACED)
        count = np.diff(w.at)
        row = w.rows()
        some = np.maximum(1, count)
        key = np.lexsort((w.hashes, row))
        h, r = w.hashes[key], row[key]
        new = np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])] if len(h) else np.zeros(0, bool)
        runs = np.flatnonzero(new)
        most = np.zeros(j - i)
        if len(runs):
            np.maximum.at(most, r[runs], np.diff(np.r_[runs, len(h)]))
        same = np.r_[False, (w.hashes[1:] == w.hashes[:-1]) & (row[1:] == row[:-1])] if len(h) else new
        lines = _shares(np.arange(256) == 10, raw, first) * np.diff(first) + 1
        size = np.diff(first)
        out.append(
            np.stack(
                [
                    np.log1p(count),
                    np.log1p(size / some),
                    np.bincount(r[runs], minlength=j - i) / some,
                    most / some,
                    np.bincount(row[same], minlength=j - i) / some,
                    _shares(_LETTER, raw, first),
                    _shares(_UPPER, raw, first),
                    _shares(_DIGIT, raw, first),
                    _shares(_SIGN, raw, first),
                    np.log1p(size / lines),
                ],
                axis=1,
            )
        )
    return np.concatenate(out)


def _basis(x: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - center) / scale, -5, 5)
    return np.concatenate([np.ones((len(z), 1)), z, z * z], axis=1)


def fit(x: np.ndarray, y: np.ndarray) -> tuple | None:
    """Logistic regression on the features and their squares, labels weighing alike."""
    if len(set(y.tolist())) < 2:
        return None
    center, scale = np.median(x, axis=0), x.std(axis=0) + 1e-9
    b = _basis(x, center, scale)
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    beta = np.zeros(b.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(b @ beta, -30, 30)))
        slope = b.T @ (weight * (p - y)) + RIDGE * beta
        bend = (b * (weight * p * (1 - p))[:, None]).T @ b + RIDGE * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return center, scale, beta


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(batch.column("text"))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("good"), lists], names=["id", "good", "x"]
        )


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", quality: str = "quality"):
    known = labels.select(F.col(doc_id).alias("id"), F.col(quality).cast("int").alias("good")).dropna()
    known = known.groupBy("id").agg(F.max("good").alias("good"))
    counts = {r.good: r["count"] for r in known.groupBy("good").count().collect()}
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chance = F.when(F.col("good") == 1, PER_CLASS / counts.get(1, 1)).otherwise(PER_CLASS / counts.get(0, 1))
    drawn = known.filter(draw < chance)  # bounded: about PER_CLASS of either label
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(drawn), "id")
    rows = rows.mapInArrow(_drawn, "id bigint, good int, x array<double>").collect()
    rows.sort(key=lambda r: (r.id, r.x))
    return fit(np.array([r.x for r in rows]).reshape(-1, FEATURES), np.array([r.good for r in rows], float))


def _evidence(shared, columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if model is None:
                p = np.full(batch.num_rows, 0.5)
            else:
                center, scale, beta = model
                p = 1 / (1 + np.exp(-np.clip(_basis(features(batch.column("text")), center, scale) @ beta, -12, 12)))
            kept = batch.columns[:columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p)], names=[*batch.schema.names[:columns], "evidence"])

    return tidy(run)


def _strength(sites: DataFrame, above: Column) -> float:
    """How many documents the level above counts for: variance within over between."""
    mean = F.col("total") / F.col("docs")
    row = sites.agg(
        F.sum(F.col("squares") - F.col("docs") * mean * mean).alias("within"),
        F.sum(F.col("docs") * (mean - above) * (mean - above)).alias("between"),
        F.sum("docs").alias("docs"),
        F.count("*").alias("sites"),
        F.sum(F.col("docs") * F.col("docs")).alias("docs2"),
    ).first()
    if not row.docs or row.docs <= row.sites:
        return MIXED_MOST
    within = max(row.within, 0.0) / (row.docs - row.sites)
    spread = row.docs - row.docs2 / row.docs
    between = (row.between - row.sites * within) / spread if spread > 0 else 0.0
    return MIXED_MOST if between <= 0 else float(min(MIXED_MOST, max(1e-3, within / between)))


def posteriors(scored: DataFrame, levels: list[str]) -> tuple[list[DataFrame], float]:
    """For each level a row for each site, with its posterior, the sum and number of its
    documents' evidence and what the level above counts for; and the global mean."""
    sums = [F.sum("evidence").alias("total"), F.sum(F.col("evidence") * F.col("evidence")).alias("squares"), F.count("*").alias("docs")]
    finest = stage(scored.groupBy(*levels).agg(*sums), "sites")
    whole = finest.agg(F.sum("total"), F.sum("docs")).first()
    mean = whole[0] / whole[1] if whole[1] else 0.5
    out: list[DataFrame] = []
    for depth in range(1, len(levels) + 1):
        keys = levels[:depth]
        sites = finest.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("total", "squares", "docs")])
        if out:
            wider = out[-1].select(*[F.col(k).alias(f"_{k}") for k in keys[:-1]], F.col("posterior").alias("above"))
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys[:-1]]
            sites = sites.join(wider, same).drop(*[f"_{k}" for k in keys[:-1]])
        else:
            sites = sites.withColumn("above", F.lit(float(mean)))
        sites = stage(sites, "level")
        strength = _strength(sites, F.col("above"))
        posterior = (F.col("above") * strength + F.col("total")) / (F.col("docs") + strength)
        out.append(sites.select(*keys, posterior.alias("posterior"), "total", "docs", F.lit(strength).alias("strength")))
    return out, mean


def _all_levels(tables: list[DataFrame], names: list[str]) -> tuple[DataFrame, list[Column]]:
    """A row for each site of the last level, with what all levels know of it, and the
    condition on which a document meets it."""
    out = None
    for depth, level in enumerate(tables):
        keys = names[: depth + 1]
        known = [F.col(c).alias(f"_{c}_{depth}") for c in ("posterior", "total", "docs", "strength")]
        level = level.select(*[F.col(k).alias(f"_{k}") for k in keys], *known)
        if out is not None:
            wider = out.select(*[F.col(f"_{k}").alias(f"__{k}") for k in keys[:-1]], *[c for c in out.columns if c[1:] not in names])
            meet = [F.col(f"_{k}").eqNullSafe(F.col(f"__{k}")) for k in keys[:-1]]
            level = level.join(wider, meet).drop(*[f"__{k}" for k in keys[:-1]])
        out = level
    return stage(out, "sites"), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in names]


def _logit(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(held / (1 - held))


def assess(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    levels: tuple[Column | str, ...] = ("source", "lang"),
    keep: float = 0.5,
) -> DataFrame:
    """For each document: doc_id, evidence, host_posterior, path_posterior, score, keep.

    ``levels`` are the columns that make a site, host first; the last level is the path."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs, labels, doc_id=doc_id, text=text))
    names = [f"site_{i}" for i in range(len(levels))]
    sites = [(F.col(c) if isinstance(c, str) else c).cast("string").alias(n) for c, n in zip(levels, names)]
    read = docs.select(F.col(doc_id).alias("id"), *sites, F.col(text).alias("text"))
    schema = ", ".join([f"id {read.schema['id'].dataType.simpleString()}", *[f"{n} string" for n in names], "evidence double"])
    scored = stage(read.mapInArrow(_evidence(model, 1 + len(names)), schema), "evidence")
    tables, mean = posteriors(scored, names)
    sites, same = _all_levels(tables, names)
    out = scored.join(F.broadcast(sites) if sites.count() <= BROADCAST_ROWS else sites, same)
    others = F.lit(float(mean))
    for depth in range(len(names)):
        total, docs_, strength = (F.col(f"_{c}_{depth}") for c in ("total", "docs", "strength"))
        others = (others * strength + total - F.col("evidence")) / (strength + docs_ - 1)
    out = out.withColumn("host_posterior", F.col("_posterior_0")).withColumn("path_posterior", F.col(f"_posterior_{len(names) - 1}"))
    odds = _logit(F.col("evidence")) + _logit(others) - _logit(F.lit(float(mean)))
    out = out.withColumn("score", 1 / (1 + F.exp(-odds)))
    return out.select(
        F.col("id").alias(doc_id), "evidence", "host_posterior", "path_posterior", "score", (F.col("score") >= keep).alias("keep")
    )


def url_levels(url: str = "url") -> tuple[Column, Column]:
    """Host and first part of the path of a URL, for tables of pages."""
    return F.lower(F.parse_url(F.col(url), F.lit("HOST"))), F.regexp_extract(F.parse_url(F.col(url), F.lit("PATH")), r"^/([^/]*)", 1)
