"""Mixing sources to target weights (operator 2), with DataFrame functions only.

Documents are counted in cells of (source, lang, topic) by their tokens.
Iterative proportional fitting finds one factor per source, language and topic
such that the reweighted cells meet the target shares of all three marginals.
A document's sampling probability is its cell's factor product divided by the
largest one, so no probability is clipped and the expected token shares of the
sample are the fitted ones.

Scale: texts are read once; a cell is one row whatever a source's share, since
counting is aggregated map-side.  A half-step is a grouped sum over the cells,
joined back to them and written.  Documents get their cell's probability by a plain join.

Topic: documents carry none, so by default it is the form of the text (table,
list, note, long, article); any column can be given instead.  Targets default to
the observed shares raised to TEMPER and normalised, which lifts rare sources,
languages and topics; tables (value, share) can be given instead.

Defined cases: null source or lang is the group ''.  Null text counts as empty;
documents without tokens carry no weight in the fit and share their cell's
probability (0 if a cell has no tokens at all and no factor).  Values without a
target keep their observed share before all shares are normalised.  The draw
depends on doc_id alone (on the text where it is null), so repeated rows stay or
go together.  A column named topic in the input is ignored unless given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import SPACE_CLASS
from lexis.session import written

TEMPER = 0.9
ROUNDS = 8
SEED = 17
DIMS = ("source", "lang", "topic")
_BLANKS = " \t\n\x0b\x0c\r"


def word_total(text: Column) -> Column:
    """Number of words of a text (the tokens of the mixture)."""
    plain = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(_BLANKS))
    return F.when(plain == "", F.lit(0)).otherwise(F.size(F.split(plain, SPACE_CLASS + "+"))).cast("bigint")


def form(text: Column, words: Column) -> Column:
    """Form of a text: table, list, note, long or article."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return (F.when((bars >= 3) & (bars * 10 >= words), "table").when((lines >= 3) & (lines * 12 >= words), "list")
            .when(words < 60, "note").when(words >= 1500, "long").otherwise("article"))


def draw(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Uniform number in [0, 1) from the first 52 bits of a digest."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text.cast("string"), F.lit("")))))
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13)
    return F.conv(digest, 16, 10).cast("double") / F.lit(float(16 ** 13))


def tempered(cells: DataFrame, dim: str, given: DataFrame | None = None) -> DataFrame:
    """(value, share): target shares of a dimension, adding up to one."""
    seen = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").cast("double").alias("n"))
    total = seen.agg(F.sum("n")).first()[0] or 1.0
    share = F.col("n") / F.lit(total)
    if given is None:
        seen = seen.select("value", F.when(share > 0, F.pow(share, F.lit(TEMPER))).otherwise(F.lit(0.0)).alias("share"))
    else:
        want = given.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), F.col("share").alias("want"))
        seen = seen.join(want, "value", "left").select("value", F.coalesce("want", share).cast("double").alias("share"))
    whole = seen.agg(F.sum("share")).first()[0] or 1.0
    return seen.select("value", (F.col("share") / F.lit(whole)).alias("share"))


def fitted(cells: DataFrame, targets: dict | None = None, rounds: int = ROUNDS) -> DataFrame:
    """The cells with their factors ``f_<dim>``, which fit the tokens to the target shares, one
    dimension after the other, ``rounds`` times.  Factors stay in the cells: a half-step is one
    grouped sum, joined back."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    held = cells.select(*DIMS, "tokens")
    for dim in DIMS:
        share = tempered(cells, dim, (targets or {}).get(dim)).toDF(dim, "share_" + dim)
        held = held.join(share, dim).withColumn("f_" + dim, F.lit(1.0))
    held = written(held, "factors")
    for _ in range(rounds):
        for dim in DIMS:
            weight = F.col("tokens").cast("double")
            for other in DIMS:
                if other != dim:
                    weight = weight * F.col("f_" + other)
            now = held.groupBy(dim).agg(F.sum(weight).alias("now"), F.max("share_" + dim).alias("share"))
            factor = F.when(F.col("now") > 0, F.col("share") * total / F.col("now")).otherwise(F.lit(0.0))
            held = written(held.drop("f_" + dim).join(now.select(dim, factor.alias("f_" + dim)), dim), "factors")
    return held


def rake(cells: DataFrame, targets: dict | None = None, rounds: int = ROUNDS) -> dict:
    """Factor tables {dim: (value, factor)} of the fitted cells."""
    held = fitted(cells, targets, rounds)
    return {d: held.select(F.col(d).alias("value"), F.col("f_" + d).alias("factor")).distinct() for d in DIMS}


def calibrated(docs: DataFrame, columns: list, topic: Column | None = None, targets: dict | None = None,
               seed: int = SEED) -> DataFrame:
    """``columns`` of every row, then _source, _lang, _topic, _tokens,
    _probability and _u."""
    text = F.col("text")
    rows = docs.select(
        *columns, F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"), word_total(text).alias("_tokens"),
        draw(F.col("doc_id"), text, seed).alias("_u"),
        (topic if topic is not None else form(text, word_total(text))).cast("string").alias("_topic"))
    rows = rows.withColumn("_topic", F.coalesce("_topic", F.lit("")))
    cells = rows.groupBy(*[F.col("_" + d).alias(d) for d in DIMS]).agg(F.sum("_tokens").alias("tokens"))
    cells = written(cells, "cells")
    product = fitted(cells, targets)
    weight = F.col("f_source") * F.col("f_lang") * F.col("f_topic")
    product = written(product.select(*[F.col(d).alias("_" + d) for d in DIMS], "tokens", weight.alias("_w")), "weights")
    top = product.where("tokens > 0").agg(F.max("_w")).first()[0] or 1.0
    odds = product.select(*["_" + d for d in DIMS], F.least(F.col("_w") / F.lit(top), F.lit(1.0)).alias("_probability"))
    return rows.join(odds, ["_" + d for d in DIMS], "left")


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """Per row: doc_id, source, lang, topic, n_tokens, probability, kept."""
    out = calibrated(docs, ["doc_id"], **settings)
    return out.select("doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"),
                      F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
                      F.round("_probability", 6).alias("probability"), (F.col("_u") < F.col("_probability")).alias("kept"))


def sample_mixture(docs: DataFrame, **settings) -> DataFrame:
    """The sampled rows of ``docs`` with topic, n_tokens and probability."""
    own = [F.col(c) for c in docs.columns if c not in ("topic", "n_tokens", "probability")]
    out = calibrated(docs, own, **settings).where(F.col("_u") < F.col("_probability"))
    names = [c for c in docs.columns if c not in ("topic", "n_tokens", "probability")]
    return out.select(*names, F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
                      F.round("_probability", 6).alias("probability"))


def oracle() -> str:
    """The same mixture as one DuckDB statement: each half-step is a CTE."""
    words = "len(regexp_extract_all(coalesce(text, ''), '[^ ' || chr(9) || '-' || chr(13) || ']+'))"
    steps = ["""
d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
             %s AS n_tokens FROM documents),
e AS (SELECT *, length(text) - length(replace(text, '|', '')) AS bars,
             length(text) - length(replace(text, chr(10), '')) + 1 AS lines FROM d),
r AS (SELECT doc_id, source, lang, n_tokens,
             CASE WHEN bars >= 3 AND bars * 10 >= n_tokens THEN 'table' WHEN lines >= 3 AND lines * 12 >= n_tokens THEN 'list'
                  WHEN n_tokens < 60 THEN 'note' WHEN n_tokens >= 1500 THEN 'long' ELSE 'article' END AS topic,
             CAST(CAST('0x' || substr(md5('%d:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / %r AS u FROM e),
c0 AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens, CAST(sum(n_tokens) AS DOUBLE) AS w FROM r GROUP BY ALL),
n AS (SELECT sum(tokens) AS total FROM c0)""" % (words, SEED, float(16 ** 13))]
    for dim in DIMS:
        steps.append(f"""
t_{dim} AS (SELECT {dim}, share / sum(share) OVER () AS share FROM (
  SELECT {dim}, pow(sum(tokens) / (SELECT total FROM n), {TEMPER}) AS share FROM c0 GROUP BY {dim}))""")
    at = 0
    for _ in range(ROUNDS):
        for dim in DIMS:
            steps.append(f"""
c{at + 1} AS (SELECT source, lang, topic, tokens,
  w * share * (SELECT total FROM n) / sum(w) OVER (PARTITION BY {dim}) AS w FROM c{at} JOIN t_{dim} USING ({dim}))""")
            at += 1
    steps.append(f"""
p AS (SELECT source, lang, topic, least((w / tokens) / max(w / tokens) OVER (), 1.0) AS probability FROM c{at} WHERE tokens > 0)""")
    return "WITH" + ",".join(steps) + """
SELECT doc_id, source, lang, topic, n_tokens, round(probability, 6) AS probability, u < probability AS kept
FROM r JOIN p USING (source, lang, topic)"""
