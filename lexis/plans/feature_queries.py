"""Queries for splits (K1, K2, O5, S7), TF-IDF (A10, A11, T1-T6, J5, P7),
relational Naive Bayes (C6) and accuracy (A12).

Documents are cleaned with the stage-1 cleaner; the label is ``lang``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import text as T
from lexis.operators import naive_bayes as NB
from lexis.operators import split as SP
from lexis.operators import tfidf as TF
from lexis.operators.rows import encode_labels
from lexis.plans.registry import register, table
from lexis.plans.text_queries import sql_clean
from lexis.session import scratch_path, written
from lexis.sources.files import write_split_dataset

SEED = 42
TEST_SIZE = 0.25
MIN_DF, MAX_DF = 2e-5, 0.70


def split_sql(source: str, label: str, id_col: str, test_size: float, seed=SEED, salt: str = "",
              names=("train", "test")) -> str:
    """Oracle form of K1 (plain window ranking, exact integer quotas)."""
    prefix = f"{seed}:{salt}:" if salt else f"{seed}:"
    return f"""
    SELECT * EXCLUDE (rn, quota, k), CASE WHEN rn <= quota THEN '{names[0]}' ELSE '{names[1]}' END AS split FROM (
      WITH d AS (SELECT *, md5('{prefix}' || CAST({id_col} AS VARCHAR)) AS k FROM {source}),
      c AS (SELECT {label} AS lab, count(*) AS cnt FROM d GROUP BY {label}),
      t AS (SELECT sum(cnt) AS n, sum(cnt) - CAST(ceil(CAST({float(test_size)!r} AS DOUBLE) * sum(cnt)) AS BIGINT) AS n_train FROM c),
      q0 AS (SELECT lab, (cnt * n_train) // n AS fl, (cnt * n_train) % n AS rem, n_train FROM c, t),
      q AS (SELECT lab, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, lab)
                                  <= n_train - sum(fl) OVER () THEN 1 ELSE 0 END AS quota FROM q0)
      SELECT d.*, row_number() OVER (PARTITION BY d.{label} ORDER BY d.k, d.{id_col}) AS rn, q.quota
      FROM d JOIN q ON q.lab = d.{label})"""


SPLIT_SQL = split_sql("(SELECT doc_id, lang FROM documents)", "lang", "doc_id", TEST_SIZE)


@register("stratified_split", f"SELECT doc_id, lang, split FROM ({SPLIT_SQL})")
def q_stratified_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return SP.stratified_split(d, "lang", "doc_id", test_size=TEST_SIZE, seed=SEED)


_FIRST = split_sql("(SELECT doc_id, lang FROM documents)", "lang", "doc_id", 0.1, salt="test",
                   names=("rest", "test"))
_SECOND = split_sql(f"(SELECT doc_id, lang FROM ({_FIRST}) WHERE split = 'rest')", "lang", "doc_id",
                    0.2, salt="val", names=("train", "validation"))
THREE_SQL = (f"SELECT doc_id, lang, split FROM ({_SECOND}) UNION ALL "
             f"SELECT doc_id, lang, split FROM ({_FIRST}) WHERE split = 'test'")


@register("three_way_split", THREE_SQL)
def q_three_way_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return SP.three_way_split(d, "lang", "doc_id", test_size=0.1, validation_size=0.2, seed=SEED)


@register("split_dataset_counts", f"""
SELECT split, lang, count(*) AS n FROM ({THREE_SQL}) GROUP BY split, lang
""")
def q_split_dataset_counts(spark, sf_dir):
    """Write the three splits as a partitioned dataset, read it back and
    count per split and class (the read prunes by partition)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    s = SP.three_way_split(d, "lang", "doc_id", test_size=0.1, validation_size=0.2, seed=SEED)
    path = write_split_dataset(s, scratch_path(spark, "splits"))
    back = spark.read.parquet(path)
    return back.groupBy("split", "lang").agg(F.count(F.lit(1)).alias("n"))


@register("shuffled_batches", """
SELECT doc_id, row_number() OVER (ORDER BY md5('42:shuffle:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS shuffle_pos,
       (row_number() OVER (ORDER BY md5('42:shuffle:' || CAST(doc_id AS VARCHAR)), doc_id) - 1) // 32 AS batch
FROM documents
""")
def q_shuffled_batches(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return SP.shuffled_batches(d, "doc_id", batch_size=32, seed=SEED).select(
        "doc_id", "shuffle_pos", "batch")


# --- TF-IDF ----------------------------------------------------------------

TOK_SQL = (f"SELECT doc_id, unnest(regexp_extract_all(lower({sql_clean('text')}), "
           f"'[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents")
TF_SQL = f"SELECT doc_id, term, count(*) AS tf FROM ({TOK_SQL}) GROUP BY doc_id, term"


def _clean_tf(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", T.clean_text(F.col("text")).alias("text"))
    return TF.term_frequency(TF.terms(d, "text", "doc_id"), "doc_id")


@register("term_frequency", TF_SQL)
def q_term_frequency(spark, sf_dir):
    return _clean_tf(spark, sf_dir)


@register("document_frequency", f"SELECT term, count(*) AS df FROM ({TF_SQL}) GROUP BY term")
def q_document_frequency(spark, sf_dir):
    return TF.document_frequency(_clean_tf(spark, sf_dir))


def _vocab_sql(tf_sql: str, n_sql: str) -> str:
    return f"""
    SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM
      (SELECT term, count(*) AS df FROM ({tf_sql}) GROUP BY term), ({n_sql})
    WHERE df >= 2e-5 * n AND df <= 7e-1 * n"""


ALL_N = "SELECT count(*)::DOUBLE AS n FROM documents"


@register("vocab_df_band", f"SELECT term, df FROM ({_vocab_sql(TF_SQL, ALL_N)})")
def q_vocab_df_band(spark, sf_dir):
    tf = _clean_tf(spark, sf_dir)
    n = table(spark, sf_dir, "documents").count()
    return TF.fit(tf, n, min_df=MIN_DF, max_df=MAX_DF).vocab.select("term", "df")


@register("idf_table", f"""
SELECT term, idf, row_number() OVER (ORDER BY term) - 1 AS term_index FROM ({_vocab_sql(TF_SQL, ALL_N)})
""")
def q_idf_table(spark, sf_dir):
    tf = _clean_tf(spark, sf_dir)
    n = table(spark, sf_dir, "documents").count()
    return TF.fit(tf, n, min_df=MIN_DF, max_df=MAX_DF, index=True).vocab.select(
        "term", "idf", "term_index")


def _weights_sql(tf_sql: str, vocab_sql: str) -> str:
    return f"""
    SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM
      (SELECT tf.doc_id, tf.term, tf.tf * v.idf AS raw FROM ({tf_sql}) tf JOIN ({vocab_sql}) v USING (term))"""


@register("tfidf_fit_transform", _weights_sql(TF_SQL, _vocab_sql(TF_SQL, ALL_N)))
def q_tfidf_fit_transform(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", T.clean_text(F.col("text")).alias("text"))
    w, _ = TF.fit_transform(d, "text", "doc_id", min_df=MIN_DF, max_df=MAX_DF)
    return w


SPLIT_TEXT_SQL = split_sql("(SELECT doc_id, lang FROM documents)", "lang", "doc_id", TEST_SIZE)
TRAIN_TF_SQL = (f"SELECT tf.* FROM ({TF_SQL}) tf JOIN ({SPLIT_TEXT_SQL}) s USING (doc_id) "
                f"WHERE s.split = 'train'")
TRAIN_N = f"SELECT count(*)::DOUBLE AS n FROM ({SPLIT_TEXT_SQL}) WHERE split = 'train'"
HOLDOUT_TF_SQL = (f"SELECT tf.* FROM ({TF_SQL}) tf JOIN ({SPLIT_TEXT_SQL}) s USING (doc_id) "
                  f"WHERE s.split = 'test'")


def split_documents(spark, sf_dir, label_ids: bool = False):
    """Cleaned documents with their split (and label code), materialised, and
    the class names."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", T.clean_text(F.col("text")).alias("text"))
    d = written(d, "cleaned")
    labels = []
    if label_ids:
        d, labels = encode_labels(d, "lang")
    return written(SP.stratified_split(d, "lang", "doc_id", test_size=TEST_SIZE, seed=SEED), "split"), labels


def split_tf(s, keep=("split",)):
    return TF.counted_terms(s, "text", "doc_id", keep)


@register("tfidf_transform_holdout",
          _weights_sql(HOLDOUT_TF_SQL, _vocab_sql(TRAIN_TF_SQL, TRAIN_N)))
def q_tfidf_transform_holdout(spark, sf_dir):
    """T5: fit on the train split, weight the test split with the train
    vocabulary and idf (unseen test terms dropped)."""
    s, _ = split_documents(spark, sf_dir)
    tf = split_tf(s)
    n_train = s.where(F.col("split") == "train").count()
    model = TF.fit(tf.where(F.col("split") == "train"), n_train, min_df=MIN_DF, max_df=MAX_DF)
    return TF.transform(tf.where(F.col("split") == "test"), model, "doc_id")


_ALL_VOCAB = _vocab_sql(TF_SQL, ALL_N)


@register("tfidf_vectors", f"""
WITH w AS ({_weights_sql(TF_SQL, _ALL_VOCAB)}),
i AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index FROM ({_ALL_VOCAB}))
SELECT doc_id, list(term_index ORDER BY term_index) AS indices, list(round(weight, 6) ORDER BY term_index) AS weights
FROM w JOIN i USING (term) GROUP BY doc_id
""")
def q_tfidf_vectors(spark, sf_dir):
    """The weights as sparse vectors, with the whole vocabulary."""
    d = table(spark, sf_dir, "documents").select("doc_id", T.clean_text(F.col("text")).alias("text"))
    tf = TF.counted_terms(d, "text", "doc_id")
    model = TF.fit(tf, d.count(), min_df=MIN_DF, max_df=MAX_DF, index=True)
    rows = TF.sparse_rows(TF.transform(tf, model, "doc_id", index=True), "doc_id")
    return rows.withColumn("weights", F.transform("weights", lambda w: F.round(w, 6)))


# --- relational Naive Bayes + accuracy -------------------------------------

NB_SQL = f"""
WITH s AS ({SPLIT_TEXT_SQL}),
lab AS (SELECT s.doc_id, s.split, l.label_id FROM s JOIN
        (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS label_id FROM (SELECT DISTINCT lang FROM s)) l
        USING (lang)),
vocab AS ({_vocab_sql(TRAIN_TF_SQL, TRAIN_N)}),
tf AS (SELECT tf.*, s.split FROM ({TF_SQL}) tf JOIN s USING (doc_id)),
w0 AS (SELECT tf.doc_id, tf.split, tf.term, tf.tf * v.idf AS raw FROM tf JOIN vocab v USING (term)),
wn AS (SELECT doc_id, split, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM w0),
fc AS (SELECT l.label_id, wn.term, sum(wn.weight) AS fc FROM wn JOIN lab l USING (doc_id)
       WHERE wn.split = 'train' GROUP BY l.label_id, wn.term),
vsize AS (SELECT count(*)::DOUBLE AS v FROM vocab),
cls AS (SELECT label_id, count(*)::DOUBLE AS nc FROM lab WHERE split = 'train' GROUP BY label_id),
csum AS (SELECT label_id, sum(fc) AS s FROM fc GROUP BY label_id),
sc AS (SELECT c.label_id, ln(c.nc / (SELECT sum(nc) FROM cls)) AS prior,
              ln(coalesce(csum.s, 0) + vsize.v) AS lnorm
       FROM cls c LEFT JOIN csum USING (label_id), vsize),
test AS (SELECT doc_id, label_id FROM lab WHERE split = 'test'),
wd AS (SELECT doc_id, sum(weight) AS w FROM wn WHERE split = 'test' GROUP BY doc_id),
part AS (SELECT wn.doc_id, fc.label_id, sum(wn.weight * ln(fc.fc + 1)) AS p
         FROM wn JOIN fc USING (term) WHERE wn.split = 'test' GROUP BY wn.doc_id, fc.label_id),
score AS (SELECT t.doc_id, c.label_id,
                 c.prior - c.lnorm * coalesce(wd.w, 0) + coalesce(part.p, 0) AS s
          FROM test t CROSS JOIN sc c LEFT JOIN wd ON wd.doc_id = t.doc_id
          LEFT JOIN part ON part.doc_id = t.doc_id AND part.label_id = c.label_id),
pred AS (SELECT doc_id, label_id AS prediction FROM
         (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, label_id) AS rn FROM score)
         WHERE rn = 1)
SELECT t.doc_id, CAST(t.label_id AS INTEGER) AS label_id, CAST(p.prediction AS INTEGER) AS prediction
FROM test t JOIN pred p USING (doc_id)
"""


def nb_parts(spark, sf_dir):
    """Documents with split and label, their weights under the train
    vocabulary, class sums of the train weights, vocabulary size and class
    names: what Naive Bayes needs for any smoothing."""
    keep = ("split", "label_id")
    s, labels = split_documents(spark, sf_dir, label_ids=True)
    tf = split_tf(s, keep)
    train = F.col("split") == "train"
    model = TF.fit(tf.where(train), s.where(train).count(), min_df=MIN_DF, max_df=MAX_DF)
    weights = written(TF.transform(tf, model, "doc_id", keep), "weights")
    return s, weights, NB.class_sums(weights.where(train)), model.size, labels


def nb_predictions(spark, sf_dir):
    s, weights, fc, size, labels = nb_parts(spark, sf_dir)
    nb = NB.fit(fc, s.where(F.col("split") == "train"), size, num_classes=len(labels))
    test = s.where(F.col("split") == "test").select("doc_id", "label_id")
    return NB.predict(nb, weights.where(F.col("split") == "test"), test, "doc_id")


@register("clf_naive_bayes_sql", NB_SQL)
def q_clf_naive_bayes_sql(spark, sf_dir):
    return nb_predictions(spark, sf_dir).select("doc_id", "label_id", "prediction")


@register("accuracy", f"""
SELECT round(avg(CASE WHEN prediction = label_id THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy,
       count(*) AS n_test FROM ({NB_SQL})
""")
def q_accuracy(spark, sf_dir):
    p = nb_predictions(spark, sf_dir)
    return p.agg(F.round(F.avg((F.col("prediction") == F.col("label_id")).cast("double")), 6)
                 .alias("accuracy"), F.count(F.lit(1)).alias("n_test"))
