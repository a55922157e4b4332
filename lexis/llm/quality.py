"""Quality classifier (operator 1): regularised quadratic discriminant.

Each text gives a row of transformed statistics; each class has a mean and a
covariance that is shrunk towards the pooled diagonal; the score is the
logistic of the difference of the classes' log-densities, which need the
Mahalanobis distances under each class's Cholesky factor.  The inverse factors
are computed once and cached with the model.

Scale: texts are read once, in Arrow batches without a Python string a word.
The statistics are written as a narrow table; means and covariances are sums
over all labelled training rows (two rows reach the driver); scoring is one
more pass over the narrow table, without a shuffle.

Defined cases: null text counts as empty.  Labels other than 0 and 1, labels of
held-out folds and labels without a document are ignored; a document with
both labels counts once for each.  Without training rows of both classes
the score is the share of label 1 (0.5 without labels).  Rows without a doc_id
are scored and count as not held out.  Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm import hashing
from lexis.llm.common import fold
from lexis.session import ship_package, written

FOLDS, HELD_OUT_FOLD = 4, 2
THRESHOLD = 0.7
SHRINKAGE = 0.1  # weight of the pooled diagonal in a class covariance
RIDGE = 1e-3
NAMES = ("size", "word_length", "upper", "digit", "symbol", "marks", "other", "repeat", "variety", "top",
         "line_words", "stops")
PRIOR_WORDS = 12.0  # a share is smoothed as if so many typical words came first

_UPPER = np.zeros(256)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256)
_DIGIT[48:58] = 1
_SYMBOL = np.zeros(256)  # ASCII that is neither letter, digit, space nor usual punctuation
_SYMBOL[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-?!"]] = 1
_MARKS = np.zeros(256)
_MARKS[[ord(c) for c in "!?;:\"()"]] = 1
_STOPS = np.zeros(256)
_STOPS[[ord("."), ord(",")]] = 1
_CONTROL = np.zeros(256)
_CONTROL[[*range(9), *range(14, 32), 127]] = 1
_KINDS = np.vstack([_UPPER, _DIGIT, _SYMBOL, _MARKS, _CONTROL, _STOPS])


def _counts(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Bytes of a kind per text, in pieces of bounded size."""
    out = np.zeros(len(offsets) - 1)
    for a in range(0, len(raw), hashing.SEGMENT):
        part = np.concatenate([[0.0], np.cumsum(table[raw[a:a + hashing.SEGMENT]])])
        at = np.clip(offsets - a, 0, len(part) - 1)
        out += part[at[1:]] - part[at[:-1]]
    return out


def features(column: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text."""
    raw, offsets = hashing.buffers(column)
    h, at = hashing.words(raw, offsets)
    n = np.diff(at).astype(float)
    size = np.diff(offsets).astype(float)
    upper, digit, symbol, marks, control, stops = (_counts(raw, offsets, t) for t in _KINDS)
    lines = _counts(raw, offsets, (np.arange(256) == 10).astype(float)) + 1
    same = np.zeros(len(h) + 1)
    if len(h):
        same[1:-1] = h[1:] == h[:-1]
    edges = np.cumsum(np.concatenate([[0.0], same[:-1]])) if len(h) else np.zeros(1)
    first = same[np.minimum(at[:-1], len(same) - 1)]
    repeat = edges[at[1:]] - edges[at[:-1]] - np.where(n > 0, first, 0)
    distinct, top = np.zeros(len(n)), np.zeros(len(n))
    for i in np.flatnonzero(n):
        _, c = np.unique(h[at[i]:at[i + 1]], return_counts=True)
        distinct[i], top[i] = len(c), c.max()

    def share(k, usual, of=n, prior=PRIOR_WORDS):
        x = (k + usual * prior) / (of + prior)
        return np.log(x / np.maximum(1e-9, 1 - np.minimum(x, 0.999)))

    return np.column_stack([
        np.log1p(n), np.log((size + 6 * PRIOR_WORDS) / (n + PRIOR_WORDS)), share(upper, 0.02, size, 60.0),
        share(digit, 0.002, size, 60.0), share(symbol, 0.002, size, 60.0), share(marks, 0.003, size, 60.0),
        share(control, 0.001, size, 60.0), share(repeat, 0.02), share(distinct, 0.75), share(top, 0.06),
        np.log((n + 3 * PRIOR_WORDS) / (lines + 3)), share(stops, 0.12),
    ])


def _extract(batches):
    for batch in batches:
        x = features(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x[:, j]) for j in range(x.shape[1]))], ["doc_id", *NAMES])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _extract, "doc_id " + docs.schema["doc_id"].dataType.simpleString() + "".join(f", {c} double" for c in NAMES))


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors and log-determinants."""

    means: list
    inverse: list
    half_logdet: list
    log_prior: float  # ln P(1) - ln P(0)
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = [-0.5 * (((x - m) @ inv.T) ** 2).sum(axis=1) - ld
                   for m, inv, ld in zip(self.means, self.inverse, self.half_logdet)]
        return 1.0 / (1.0 + np.exp(-np.clip(density[1] - density[0] + self.log_prior, -500, 500)))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", shrinkage: float = SHRINKAGE) -> Discriminant:
    """Sums over all labelled rows outside the held-out fold."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select(
        F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).distinct()
    rows = stats.where(fold("doc_id", FOLDS) != HELD_OUT_FOLD).join(marks, F.col("doc_id") == F.col("_id"))
    d = len(NAMES)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    sums = [F.sum(c) for c in NAMES] + [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])) for i, j in pairs]
    found = {r[0]: r[1:] for r in rows.groupBy("_y").agg(F.count(F.lit(1)), *sums).collect()}
    total = sum(r[0] for r in found.values())
    if len(found) < 2:
        return Discriminant([], [], [], 0.0, 0.5 if not total else float(1 in found))
    means, covs, ns = [], [], []
    for y in (0, 1):
        n, s = found[y][0], np.array(found[y][1:], dtype=float)
        mean, cov = s[:d] / n, np.zeros((d, d))
        for (i, j), v in zip(pairs, s[d:] / n):
            cov[i, j] = cov[j, i] = v - mean[i] * mean[j]
        means.append(mean)
        covs.append(cov)
        ns.append(n)
    pooled = np.diag(np.maximum((ns[0] * np.diag(covs[0]) + ns[1] * np.diag(covs[1])) / total, 0) + RIDGE)
    inverse, half = [], []
    for n, cov in zip(ns, covs):
        weight = max(shrinkage, d / (d + n))
        low = np.linalg.cholesky((1 - weight) * cov + weight * pooled + RIDGE * np.eye(d))
        inverse.append(np.linalg.inv(low))
        half.append(float(np.log(np.diag(low)).sum()))
    return Discriminant(means, inverse, half, float(np.log(ns[1] / ns[0])))


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    def run(batches):
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy() for c in NAMES]) if batch.num_rows else np.zeros((0, len(NAMES)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    out = stats.mapInArrow(run, f"doc_id {kind}, score double")
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT_FOLD, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled training rows of ``docs`` and score every row."""
    stats = written(statistics(docs), "quality")
    return score(stats, fit(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows whose prediction is 1 (rows without a doc_id stay)."""
    bad = classify(docs, labels).where("predicted = 0 and doc_id is not null").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)
