"""Relational multinomial Naive Bayes (C6) on long-form TF-IDF weights.

fit:      fc[c,t] = sum of weights of term t in training docs of class c
          S[c]    = sum_t fc[c,t];  prior[c] = ln(N_c / N)   (unsmoothed)
score:    prior[c] + sum_t w[d,t] * (ln(fc[c,t] + a) - ln(S[c] + a*V))
        = prior[c] - (ln(S[c] + a*V) - ln a) * W[d]
          + sum_{t: fc[c,t] > 0} w[d,t] * (ln(fc[c,t] + a) - ln a)
with W[d] = sum_t w[d,t].  Only (doc, class) pairs sharing a term are ever
materialised; per-class constants (K values, K bounded) are literals, so no
doc x class cross join is needed.  Ties go to the lowest class code.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.functions.text import argmax
from lexis.session import written


@dataclass
class NaiveBayesModel:
    class_terms: DataFrame  # (_class, term, g) with g = ln(fc + a) - ln a
    prior: list
    log_norm: list  # ln(S[c] + a V) - ln a
    alpha: float


def class_sums(weights: DataFrame, label_col: str = "label_id") -> DataFrame:
    """(label, term, fc) of training weights, materialised: every smoothing
    value and the class totals read it."""
    return written(weights.groupBy(label_col, "term").agg(F.sum("weight").alias("fc")), "class-sums")


def fit(fc: DataFrame, docs: DataFrame, n_terms: int, *, label_col: str = "label_id",
        alpha: float = 1.0, num_classes: int | None = None) -> NaiveBayesModel:
    """``fc`` from ``class_sums``; ``docs`` holds the label of every training
    document (those without terms count in the prior)."""
    if alpha <= 0:
        raise ValueError("alpha must be > 0")
    counts = {r[0]: r[1] for r in docs.groupBy(label_col).count().collect()}
    sums = {r[0]: r[1] for r in fc.groupBy(label_col).agg(F.sum("fc")).collect()}
    k = num_classes or (max(counts) + 1)
    n = sum(counts.values())
    prior = [math.log(counts[c] / n) if counts.get(c) else float("-inf") for c in range(k)]
    log_norm = [math.log(sums.get(c, 0.0) + alpha * n_terms) - math.log(alpha) for c in range(k)]
    g = F.log(F.col("fc") + F.lit(alpha)) - F.lit(math.log(alpha))
    return NaiveBayesModel(fc.select(F.col(label_col).alias("_class"), "term", g.alias("g")), prior, log_norm, alpha)


def predict(model: NaiveBayesModel, weights: DataFrame, docs: DataFrame, id_col: str,
            out_col: str = "prediction") -> DataFrame:
    """Add ``out_col`` (argmax class code) to ``docs`` (one row per doc to
    score); ``weights`` holds those docs' (id, term, weight)."""
    part = (weights.select(id_col, "term", "weight").join(model.class_terms, "term")
            .groupBy(id_col, "_class").agg(F.sum(F.col("weight") * F.col("g")).alias("p"))
            .groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("_class", "p"))).alias("_pm")))
    total = weights.groupBy(id_col).agg(F.sum("weight").alias("_W"))
    scored = docs.join(total, id_col, "left").join(part, id_col, "left")
    prior = F.array(*[F.lit(x) for x in model.prior])
    norm = F.array(*[F.lit(x) for x in model.log_norm])
    k = len(model.prior)
    scores = F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda c: prior[c] - norm[c] * F.coalesce(F.col("_W"), F.lit(0.0))
        + F.coalesce(F.try_element_at(F.col("_pm"), c), F.lit(0.0)),
    )
    return scored.withColumn(out_col, argmax(scores).cast("int")).drop("_W", "_pm")
