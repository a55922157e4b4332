"""Queries for the classifier suite (C1-C11), ranking (O1, O2, U2, F21),
persistence and scoring (S4-S6) and the classical pipeline (M1).

Each classifier query prepares its own features (documents labelled by ``lang``,
deduplicated, normalised, 25 % test), so none depends on what ran before it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.operators import classify as C
from lexis.operators import evaluate as EV
from lexis.operators import naive_bayes as NB
from lexis.plans import pipeline as PL
from lexis.plans.feature_queries import (SEED, SPLIT_TEXT_SQL, TEST_SIZE, TF_SQL, TRAIN_N, TRAIN_TF_SQL, _vocab_sql,
                                         nb_parts)
from lexis.plans.registry import register, table
from lexis.session import scratch_path
from lexis.sources.files import read_csv_table, write_csv_table


# The queries fit every model as far as the library does by default.
PARAMS = C.SuiteParams()


def prepared(spark, sf_dir) -> PL.Prepared:
    return PL.prepare_classification(table(spark, sf_dir, "documents"), "text", "lang", "doc_id",
                                     test_size=TEST_SIZE, seed=SEED)


def _clf_query(key: str, name: str):
    @register(key)
    def q(spark, sf_dir):
        return PL.fit_and_predict(prepared(spark, sf_dir), name, PARAMS)[1]

    q.__doc__ = f"{name}: test-split predictions (doc_id, label_id, prediction)."
    return q


for _key, _name in (("clf_random_forest", "Random Forest"),
                    ("clf_gradient_boosting", "Gradient Boosting"),
                    ("clf_adaboost", "AdaBoost"),
                    ("clf_decision_tree", "Decision Tree"),
                    ("clf_linear_svm", "Linear Support Vector Machine"),
                    ("clf_rbf_svm", "Support Vector Machine"),
                    ("clf_naive_bayes", "Naive Bayes"),
                    ("clf_mlp", "Multilayer Perceptron"),
                    ("clf_boosted_d5", "LightGBM-style boosting"),
                    ("clf_boosted_d6", "XGBoost-style boosting")):
    _clf_query(_key, _name)


@register("suite_ranking")
def q_suite_ranking(spark, sf_dir):
    """All models, ranked by test accuracy (ties: suite order)."""
    return PL.run_suite(prepared(spark, sf_dir), params=PARAMS)[0]


@register("pipeline_ml")
def q_pipeline_ml(spark, sf_dir):
    """M1 end to end: the ranking, with the folder name under which each model
    was saved (S5)."""
    ranked = PL.run_pipeline(table(spark, sf_dir, "documents"), "text", "lang", "doc_id", test_size=TEST_SIZE, seed=SEED,
                             params=PARAMS, out_dir=scratch_path(spark, "models"))
    from lexis.functions.text import slugify

    return ranked.withColumn("folder", slugify(F.col("model")))


def saved_model(spark, sf_dir, name: str, prep=None) -> PL.TextModel:
    """One suite member fitted, saved and loaded again."""
    prep = prep or prepared(spark, sf_dir)
    out = scratch_path(spark, "saved")
    PL.save_models({name: PL.fit_and_predict(prep, name)[0]}, prep, out)
    return PL.load_model(spark, out, name)


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """S5 + S6: save Naive Bayes and its features, load both and score the raw
    texts of the test split again; both predictions must agree."""
    prep = prepared(spark, sf_dir)
    model, pred = PL.fit_and_predict(prep, "Naive Bayes")
    out = scratch_path(spark, "roundtrip")
    PL.save_models({"Naive Bayes": model}, prep, out)
    docs = table(spark, sf_dir, "documents").join(prep.test.select("doc_id"), "doc_id", "left_semi")
    again = PL.score_texts(docs, PL.load_model(spark, out, "Naive Bayes"), "text", "doc_id")
    return pred.join(again.select("doc_id", F.col("prediction").alias("reloaded_prediction")), "doc_id")


@register("score_new_text")
def q_score_new_text(spark, sf_dir):
    """Texts the model never saw (the conversations table), scored with a
    saved model; output class names."""
    conv = table(spark, sf_dir, "conversations").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("doc_id"),
        "text")
    return PL.score_texts(conv, saved_model(spark, sf_dir, "Naive Bayes"), "text", "doc_id")


# --- SQL-checkable ranking over relational Naive Bayes variants -------------

ALPHAS = (1.0, 0.5, 0.1)


def _nb_multi_sql() -> str:
    alphas = ", ".join(f"({i}, {a!r}::DOUBLE)" for i, a in enumerate(ALPHAS))
    return f"""
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
al AS (SELECT * FROM (VALUES {alphas}) t(pos, a)),
cls AS (SELECT label_id, count(*)::DOUBLE AS nc FROM lab WHERE split = 'train' GROUP BY label_id),
csum AS (SELECT label_id, sum(fc) AS s FROM fc GROUP BY label_id),
sc AS (SELECT al.pos, al.a, c.label_id, ln(c.nc / (SELECT sum(nc) FROM cls)) AS prior,
              ln(coalesce(csum.s, 0) + al.a * vsize.v) - ln(al.a) AS lnorm
       FROM cls c LEFT JOIN csum USING (label_id), vsize, al),
test AS (SELECT doc_id, label_id FROM lab WHERE split = 'test'),
wd AS (SELECT doc_id, sum(weight) AS w FROM wn WHERE split = 'test' GROUP BY doc_id),
part AS (SELECT al.pos, wn.doc_id, fc.label_id, sum(wn.weight * (ln(fc.fc + al.a) - ln(al.a))) AS p
         FROM wn JOIN fc USING (term), al WHERE wn.split = 'test' GROUP BY al.pos, wn.doc_id, fc.label_id),
score AS (SELECT c.pos, t.doc_id, c.label_id,
                 c.prior - c.lnorm * coalesce(wd.w, 0) + coalesce(part.p, 0) AS s
          FROM test t CROSS JOIN sc c LEFT JOIN wd ON wd.doc_id = t.doc_id
          LEFT JOIN part ON part.doc_id = t.doc_id AND part.label_id = c.label_id AND part.pos = c.pos),
pred AS (SELECT pos, doc_id, label_id AS prediction FROM
         (SELECT *, row_number() OVER (PARTITION BY pos, doc_id ORDER BY s DESC, label_id) AS rn FROM score)
         WHERE rn = 1),
major AS (SELECT label_id FROM cls ORDER BY nc DESC, label_id LIMIT 1),
res AS (
  SELECT 'Naive Bayes (alpha=' || CAST(al.a AS VARCHAR) || ')' AS model, al.pos AS position,
         round(avg(CASE WHEN p.prediction = t.label_id THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy
  FROM pred p JOIN test t USING (doc_id) JOIN al ON al.pos = p.pos GROUP BY al.a, al.pos
  UNION ALL
  SELECT 'Majority class', {len(ALPHAS)},
         round(avg(CASE WHEN t.label_id = (SELECT label_id FROM major) THEN 1.0 ELSE 0.0 END)::DOUBLE, 6)
  FROM test t)
SELECT model, accuracy, CAST(position AS INTEGER) AS position FROM res"""


RESULTS_SQL = _nb_multi_sql()
RANK_SQL = (f"SELECT model, accuracy, position, CAST(row_number() OVER (ORDER BY accuracy DESC, position) "
            f"AS INTEGER) AS rank FROM ({RESULTS_SQL})")


def nb_results(spark, sf_dir):
    """Accuracy of relational Naive Bayes at several smoothing values and of
    the majority-class baseline: ``(model, accuracy, position)``."""
    s, weights, fc, size, labels = nb_parts(spark, sf_dir)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test").select("doc_id", "label_id")
    test_weights = weights.where(F.col("split") == "test")
    preds = []
    for i, a in enumerate(ALPHAS):
        nb = NB.fit(fc, train, size, alpha=a, num_classes=len(labels))
        preds.append(NB.predict(nb, test_weights, test, "doc_id").select(
            "label_id", "prediction", F.lit(f"Naive Bayes (alpha={a})").alias("model"), F.lit(i).alias("position")))
    major = train.groupBy("label_id").count().orderBy(F.desc("count"), "label_id").first()[0]
    preds.append(test.select("label_id", F.lit(major).alias("prediction"), F.lit("Majority class").alias("model"),
                             F.lit(len(ALPHAS)).alias("position")))
    allp = preds[0]
    for p in preds[1:]:
        allp = allp.unionByName(p)
    acc = allp.groupBy("model", "position").agg(
        F.round(F.avg((F.col("prediction") == F.col("label_id")).cast("double")), 6).alias("accuracy"))
    return acc.select("model", "accuracy", F.col("position").cast("int").alias("position"))


@register("rank_models", RANK_SQL)
def q_rank_models(spark, sf_dir):
    return EV.rank_results(nb_results(spark, sf_dir))


EXTERNAL = ("Transformer (validation, external)", 0.8768)


@register("rank_models_with_external", f"""
SELECT model, accuracy, position, CAST(row_number() OVER (ORDER BY accuracy DESC, position) AS INTEGER) AS rank
FROM (SELECT model, accuracy, position FROM ({RESULTS_SQL})
      UNION ALL SELECT '{EXTERNAL[0]}', {EXTERNAL[1]!r}::DOUBLE, {len(ALPHAS) + 1})
""")
def q_rank_models_with_external(spark, sf_dir):
    """Append an externally measured result, then re-rank."""
    return EV.rank_results(EV.append_external(nb_results(spark, sf_dir), *EXTERNAL))


@register("accuracy_chart_rows", f"""
SELECT model, accuracy, position, rank, format('{{:.2f}}%', accuracy * 100.0) AS label FROM ({RANK_SQL})
""")
def q_accuracy_chart_rows(spark, sf_dir):
    """ranked results with bar labels."""
    return EV.chart_rows(EV.rank_results(nb_results(spark, sf_dir)))


@register("results_roundtrip", RANK_SQL)
def q_results_roundtrip(spark, sf_dir):
    """Ranked results written as one CSV file with header, read back."""
    ranked = EV.rank_results(nb_results(spark, sf_dir))
    path = write_csv_table(ranked.select("model", "accuracy", "position", "rank"),
                           scratch_path(spark, "results"), single_file=True)
    return read_csv_table(spark, path, "model string, accuracy double, position int, rank int")
