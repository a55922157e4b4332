"""Queries for the scalar text functions.

The driver's documents contain no URLs, hashtags, contractions or emoji, so
the cleaning queries append the same noise on both sides (Spark and oracle)
before applying the operator; otherwise the check would prove nothing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import text as T
from lexis.plans.registry import register, table

# Fixed noise suffix shared by the Spark queries and the oracle SQL.
NOISE_HEAD = " See HTTP://x.co/"
NOISE_TAIL = " @céo #bullish can't 100% naïve 📈 1️⃣ www.Example.org/a?b=1"
NOISE_SQL = (
    "(text || ' See HTTP://x.co/' || cast(doc_id AS varchar) || "
    "' @céo #bullish can''t 100% naïve 📈 1️⃣ www.Example.org/a?b=1')"
)

# DuckDB (RE2) spellings of the same patterns.
SQL_URL = r"'https?://\S+|www\.\S+', ' ', 'gi'"
SQL_MENTION = r"'@[\p{L}\p{N}_]+', ' ', 'g'"
SQL_HASHTAG = r"'#[\p{L}\p{N}_]+', ' ', 'g'"
SQL_NON_LETTER = r"'[^a-z\s]', ' ', 'g'"
SQL_EMOJI = f"'{T.EMOJI_PATTERN}', '', 'g'"


def sql_clean(expr: str) -> str:
    """Oracle form of F7."""
    s = f"regexp_replace(coalesce(CAST({expr} AS varchar), ''), {SQL_URL})"
    s = f"regexp_replace({s}, {SQL_MENTION})"
    s = f"regexp_replace({s}, {SQL_HASHTAG})"
    s = f"regexp_replace(lower({s}), {SQL_NON_LETTER})"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


def sql_contractions(expr: str) -> str:
    s = expr
    for pat, repl in T.CONTRACTIONS:
        s = f"regexp_replace({s}, '{pat.replace(chr(39), chr(39) * 2)}', '{repl}', 'gi')"
    return s


def sql_normalize_prefix(expr: str) -> str:
    s = sql_contractions(f"lower(coalesce(CAST({expr} AS varchar), ''))")
    s = f"regexp_replace({s}, {SQL_EMOJI})"
    s = f"regexp_replace({s}, '[^\\x{{0}}-\\x{{7F}}]', '', 'g')"
    return f"regexp_replace({s}, {SQL_NON_LETTER})"


def noisy_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.concat(F.col("text"), F.lit(NOISE_HEAD), F.col("doc_id").cast("string"),
                 F.lit(NOISE_TAIL)).alias("text"),
    )


def _one(name, fn_col, sql_expr):
    sql = f"SELECT doc_id, {sql_expr} AS out FROM documents"

    @register(name, sql)
    def q(spark, sf_dir):
        d = noisy_documents(spark, sf_dir)
        return d.select("doc_id", fn_col(F.col("text")).alias("out"))

    return q


_one("strip_urls", T.strip_urls, f"regexp_replace({NOISE_SQL}, {SQL_URL})")
_one("strip_mentions", T.strip_mentions, f"regexp_replace({NOISE_SQL}, {SQL_MENTION})")
_one("strip_hashtags", T.strip_hashtags, f"regexp_replace({NOISE_SQL}, {SQL_HASHTAG})")
_one("letters_only", lambda c: T.letters_only(F.lower(c)),
     f"regexp_replace(lower({NOISE_SQL}), {SQL_NON_LETTER})")
_one("collapse_space", T.collapse_space,
     f"trim(regexp_replace({NOISE_SQL}, '\\s+', ' ', 'g'))")
_one("clean_text", T.clean_text, sql_clean(NOISE_SQL))
_one("expand_contractions", T.expand_contractions, sql_contractions(NOISE_SQL))
_one("strip_emoji", T.strip_emoji, f"regexp_replace({NOISE_SQL}, {SQL_EMOJI})")
_one("ascii_only", T.ascii_only,
     f"regexp_replace({NOISE_SQL}, '[^\\x{{0}}-\\x{{7F}}]', '', 'g')")
_one("normalize_prefix", T.normalize_prefix, sql_normalize_prefix(NOISE_SQL))


@register("coalesce_text", """
SELECT doc_id, coalesce(CAST(n_chars AS varchar), '') AS n_chars_text,
       coalesce(CAST(text AS varchar), '') AS text
FROM documents
""")
def q_coalesce_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.coalesce_text(F.col("n_chars")).alias("n_chars_text"),
                    T.coalesce_text(F.col("text")).alias("text"))


@register("text_lengths", r"""
SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS char_count,
       CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '')) AS BIGINT) AS word_count
FROM documents
""")
def q_text_lengths(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.char_count(F.col("text")).cast("bigint").alias("char_count"),
                    T.word_count(F.col("text")).cast("bigint").alias("word_count"))


@register("slugify", """
SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug
FROM part
""")
def q_slugify(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", T.slugify(F.col("p_name")).alias("slug"))


@register("argmax_scores", """
SELECT vec_id, label, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS prediction
FROM embeddings
""")
def q_argmax_scores(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", T.argmax(F.col("embedding")).cast("int").alias("prediction"))
