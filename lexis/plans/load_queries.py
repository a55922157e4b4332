"""Queries for loading, dedup, label codes, renumbering, CSV round trip
(S1-S4, W1-W3, J6, M3) and the dataset profile (A1-A9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.operators import profile as P
from lexis.operators import rows as R
from lexis.plans.registry import register, table
from lexis.session import scratch_path
from lexis.sources import files as S

DEDUP_SQL = """
SELECT * FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)
"""


@register("dedup_first", f"SELECT doc_id, text, lang FROM ({DEDUP_SQL})")
def q_dedup_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return R.dedup_first(d, "text", "doc_id")


@register("reindex", """
SELECT row_number() OVER (ORDER BY lang, doc_id) - 1 AS row_id, doc_id, lang FROM documents
""")
def q_reindex(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return R.dense_index(d, ["lang", "doc_id"], "row_id").select("row_id", "doc_id", "lang")


LABEL_DIM_SQL = "(SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_id FROM (SELECT DISTINCT lang FROM documents))"


@register("encode_labels", f"""
SELECT d.doc_id, d.lang, l.label_id FROM documents d JOIN {LABEL_DIM_SQL} l USING (lang)
""")
def q_encode_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    out, _ = R.encode_labels(d, "lang")
    return out.select("doc_id", "lang", "label_id")


@register("decode_labels", f"""
SELECT d.doc_id, l.label_id, l.lang AS decoded_label
FROM documents d JOIN {LABEL_DIM_SQL} l USING (lang)
""")
def q_decode_labels(spark, sf_dir):
    """Label -> code -> class name again (decode is the inverse of encode)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    enc, labels = R.encode_labels(d, "lang")
    return R.decode_labels(enc.select("doc_id", "label_id"), labels, "label_id", "decoded_label")


@register("load_labeled", f"""
WITH d AS ({DEDUP_SQL})
SELECT row_number() OVER (ORDER BY d.doc_id) - 1 AS row_id, d.doc_id, d.text, d.lang, l.label_id
FROM d JOIN (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_id
             FROM (SELECT DISTINCT lang FROM d)) l USING (lang)
""")
def q_load_labeled(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out, _ = S.load_labeled_text(d, "text", "lang", order_col="doc_id")
    return out.select("row_id", "doc_id", "text", "lang", "label_id")


NA_SQL = ", ".join("'" + s.replace("'", "''") + "'" for s in S.NA_STRINGS)


@register("csv_roundtrip", f"""
SELECT doc_id, CASE WHEN text IN ({NA_SQL}) THEN NULL ELSE text END AS text,
       CASE WHEN lang IN ({NA_SQL}) THEN NULL ELSE lang END AS lang, n_chars
FROM documents
""")
def q_csv_roundtrip(spark, sf_dir):
    """Write documents as CSV (quotes, commas and newlines inside texts),
    read them back with the pandas NA semantics."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    path = scratch_path(spark, "csv_roundtrip")
    S.write_csv_table(d, path)
    return S.read_csv_table(spark, path, "doc_id bigint, text string, lang string, n_chars bigint")


@register("dataset_overview", """
SELECT count(*) AS rows, CAST(5 AS BIGINT) AS columns,
       CAST(count(*) - count(DISTINCT text) - max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_texts,
       CAST(sum((doc_id IS NULL)::INT + (text IS NULL)::INT + (lang IS NULL)::INT + (source IS NULL)::INT
                + (n_chars IS NULL)::INT) AS BIGINT) AS total_missing,
       round_even(sum(8 + coalesce(strlen(text), 0) + coalesce(strlen(lang), 0)
                      + coalesce(strlen(source), 0) + 8) / 1024.0, 1) AS data_kb
FROM documents
""")
def q_dataset_overview(spark, sf_dir):
    return P.dataset_overview(table(spark, sf_dir, "documents"), "text")


def _col_sql(name, dtype):
    return (f"SELECT '{name}' AS \"column\", '{dtype}' AS dtype, "
            f"CAST(count(*) - count({name}) AS BIGINT) AS missing, "
            f"round_even((count(*) - count({name})) * 100.0 / count(*), 2) AS missing_pct, "
            f"CAST(count(DISTINCT {name}) AS BIGINT) AS \"unique\" FROM documents")


@register("column_profile", " UNION ALL ".join(
    _col_sql(n, t) for n, t in [("doc_id", "bigint"), ("text", "string"), ("lang", "string"),
                                ("source", "string"), ("n_chars", "bigint")]))
def q_column_profile(spark, sf_dir):
    return P.column_profile(table(spark, sf_dir, "documents"))


@register("class_distribution", """
SELECT lang, count(*) AS count,
       round_even(count(*) / (SELECT count(*) FROM documents)::DOUBLE * 100.0, 2) AS percentage
FROM documents WHERE lang IS NOT NULL GROUP BY lang
""")
def q_class_distribution(spark, sf_dir):
    return P.class_distribution(table(spark, sf_dir, "documents"), "lang")


_LEN_SQL = r"""
WITH l AS (
  SELECT lang, length(coalesce(text, ''))::DOUBLE AS c,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> ''))::DOUBLE AS w
  FROM documents)
SELECT 'overall_mean' AS stat, round_even(avg(c), 1) AS char_count, round_even(avg(w), 1) AS word_count FROM l
UNION ALL SELECT 'overall_min', round_even(min(c), 1), round_even(min(w), 1) FROM l
UNION ALL SELECT 'overall_max', round_even(max(c), 1), round_even(max(w), 1) FROM l
UNION ALL SELECT 'mean[' || lang || ']', round_even(avg(c), 1), round_even(avg(w), 1)
          FROM l WHERE lang IS NOT NULL GROUP BY lang
"""


@register("text_length_profile", _LEN_SQL)
def q_text_length_profile(spark, sf_dir):
    return P.text_length_profile(table(spark, sf_dir, "documents"), "text", "lang")
