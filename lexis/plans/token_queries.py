"""Queries for tokenising and token-level normalisation (F11-F16, P4-P6,
J3, J4, U3).  Inputs are the documents with the shared noise suffix."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import text as T
from lexis.functions.stem import stem_column
from lexis.operators import tokens as K
from lexis.plans.registry import register, table
from lexis.plans.text_queries import NOISE_SQL, noisy_documents, sql_clean, sql_normalize_prefix
from lexis.session import written


def _sql_tokens(text_expr: str, source: str = "documents") -> str:
    return f"""
    SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM (
      SELECT doc_id, unnest(range(0, len(a))) AS pos, unnest(a) AS token
      FROM (SELECT doc_id, regexp_split_to_array({text_expr}, '\\s+') AS a FROM {source}))
    WHERE token <> ''"""


def _stop_sql() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in K.stopword_list())


def _sql_prefix_tokens() -> str:
    return _sql_tokens(sql_normalize_prefix(NOISE_SQL))


def _sql_filtered() -> str:
    return (f"SELECT * FROM ({_sql_prefix_tokens()}) WHERE length(token) >= 2 "
            f"AND token NOT IN ({_stop_sql()})")


def _sql_lemma_map(vocab_sql: str) -> str:
    cands = ["SELECT token, -1 AS rule, token AS cand FROM v"]
    for i, (suf, repl) in enumerate(K.NOUN_RULES):
        cands.append(f"SELECT token, {i}, substr(token, 1, length(token) - {len(suf)}) || '{repl}' "
                     f"FROM v WHERE suffix(token, '{suf}')")
    union = " UNION ALL ".join(cands)
    return f"""
    WITH v AS ({vocab_sql}),
    c AS ({union}),
    f AS (SELECT c.* FROM c JOIN v ON v.token = c.cand),
    r AS (SELECT token, cand, row_number() OVER (PARTITION BY token ORDER BY length(cand), rule) AS rn FROM f)
    SELECT v.token, coalesce(r.cand, v.token) AS lemma FROM v LEFT JOIN r ON r.token = v.token AND r.rn = 1"""


def _prefix_tokens(spark, sf_dir):
    d = noisy_documents(spark, sf_dir).select("doc_id", T.normalize_prefix(F.col("text")).alias("t"))
    return K.tokenize(d, "t", "doc_id")


@register("tokenize", _sql_tokens(sql_clean("text")))
def q_tokenize(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", T.clean_text(F.col("text")).alias("t"))
    return K.tokenize(d, "t", "doc_id")


@register("tokens_min_length",
          f"SELECT * FROM ({_sql_prefix_tokens()}) WHERE length(token) >= 2")
def q_tokens_min_length(spark, sf_dir):
    return K.min_length(_prefix_tokens(spark, sf_dir), 2)


@register("tokens_stopwords", _sql_filtered())
def q_tokens_stopwords(spark, sf_dir):
    return K.remove_stopwords(K.min_length(_prefix_tokens(spark, sf_dir), 2))


@register("stopword_union", f"""
SELECT token, count(*) AS occurrences FROM ({_sql_prefix_tokens()})
WHERE token IN ({_stop_sql()}) GROUP BY token
""")
def q_stopword_union(spark, sf_dir):
    """Occurrences of each word of the union stop list (standard + extra)
    in the corpus."""
    stop = K.stopwords_frame(spark)
    toks = _prefix_tokens(spark, sf_dir)
    return toks.join(F.broadcast(stop), "token", "left_semi").groupBy("token").agg(
        F.count(F.lit(1)).alias("occurrences"))


@register("lemmatize_rules", _sql_lemma_map(f"SELECT DISTINCT token FROM ({_sql_filtered()})"))
def q_lemmatize_rules(spark, sf_dir):
    toks = K.remove_stopwords(K.min_length(_prefix_tokens(spark, sf_dir), 2))
    return K.lemma_rules(toks.select("token").distinct())


@register("lemmatize_lookup", f"""
WITH t AS ({_sql_filtered()}),
m AS ({_sql_lemma_map("SELECT DISTINCT token FROM t")})
SELECT t.doc_id, t.pos, coalesce(m.lemma, t.token) AS token FROM t LEFT JOIN m ON m.token = t.token
""")
def q_lemmatize_lookup(spark, sf_dir):
    """The token stream with each token replaced through a lemma table
    (here the rule-derived table of the same corpus).  The prepared texts and
    their distinct tokens are written, since both are read several times."""
    d = noisy_documents(spark, sf_dir).select("doc_id", T.normalize_prefix(F.col("text")).alias("t"))
    toks = K.remove_stopwords(K.min_length(K.tokenize(written(d, "prepared"), "t", "doc_id"), 2))
    mapping = K.lemma_rules(written(toks.select("token").distinct(), "tokens"))
    return K.apply_lookup(toks, mapping, "token", "lemma").select("doc_id", "pos", "token")


@register("stem_tokens")
def q_stem_tokens(spark, sf_dir):
    """Porter2 stem of every distinct surviving token (ROWS check;
    unit tests pin published vectors)."""
    toks = K.remove_stopwords(K.min_length(_prefix_tokens(spark, sf_dir), 2))
    vocab = toks.select("token").distinct()
    return vocab.select("token", stem_column(F.col("token")).alias("stem"))


@register("normalize_text", f"""
WITH t AS ({_sql_filtered()})
SELECT d.doc_id, coalesce(j.text, '') AS text
FROM documents d LEFT JOIN (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS text FROM t GROUP BY doc_id) j
ON j.doc_id = d.doc_id
""")
def q_normalize_text(spark, sf_dir):
    """F15 with lemma and stem off (stop words and short tokens removed)."""
    d = noisy_documents(spark, sf_dir)
    return K.normalize_text(d, "text", "doc_id", lemmatize=False, stem=False).select("doc_id", "text")


@register("normalize_text_full")
def q_normalize_text_full(spark, sf_dir):
    """F15 with every step on (ROWS check)."""
    d = noisy_documents(spark, sf_dir)
    return K.normalize_text(d, "text", "doc_id").select("doc_id", "text")
