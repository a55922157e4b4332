import random

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexis.operators import classify as C
from lexis.operators.evaluate import append_external, rank_results, results_frame


def toy(spark, n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lab = i % 2
        base = 0.0 if lab == 0 else 5.0
        rows.append((i, Vectors.dense([abs(base + rnd.random()) for _ in range(4)]), float(lab)))
    return spark.createDataFrame(rows, ["id", "features", "label"])


def test_suite_members():
    assert len(C.SUITE_ORDER) >= 7
    assert "Random Forest" in C.SUITE_ORDER and "Naive Bayes" in C.SUITE_ORDER


def test_each_model_scores_toy_data(spark):
    train, test = toy(spark, 40, 1), toy(spark, 10, 2)
    p = C.SuiteParams(trees=10, tree_depth=5, boost_rounds=3, ada_rounds=3, svm_iter=10,
                      mlp_hidden=5, mlp_iter=20)
    for name in C.SUITE_ORDER:
        model = C.fit_model(name, train, 4, 2, p)
        acc = C.accuracy(model.transform(test))
        assert acc >= 0.8, name  # two well separated clouds


def test_ranking_is_stable(spark):
    r = rank_results(results_frame(spark, [("A", 0.5), ("B", 0.9), ("C", 0.7), ("D", 0.7)]))
    assert [x["model"] for x in r.orderBy("rank").collect()] == ["B", "C", "D", "A"]
    r2 = rank_results(append_external(results_frame(spark, [("A", 0.5)]), "T", 0.8768))
    assert [x["model"] for x in r2.orderBy("rank").collect()] == ["T", "A"]


def test_adaboost_separates(spark):
    train = toy(spark, 40, 3)
    m = C.AdaBoost(rounds=3, num_classes=2).fit(train)
    assert len(m.stumps) >= 1
    assert C.accuracy(m.transform(toy(spark, 10, 4))) == 1.0


def test_adaboost_reweights_over_rounds(spark):
    # three classes, each stump can isolate only one of them: reaching full
    # accuracy needs several rounds with correctly renormalised weights
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType

    rows = []
    for i in range(30):
        c = i % 3
        rows.append((Vectors.dense([1.0 if c == 0 else 0.0, 1.0 if c == 1 else 0.0]), float(c)))
    schema = StructType([StructField("features", VectorUDT()), StructField("label", DoubleType())])
    df = spark.createDataFrame(rows, schema)
    m = C.AdaBoost(rounds=4, num_classes=3).fit(df)
    assert len(m.stumps) >= 2
    assert all(a > 0 for a in m.alphas)
    assert C.accuracy(m.transform(df)) == 1.0


def test_defaults_are_full():
    p = C.SuiteParams()
    assert (p.trees, p.tree_depth, p.boost_rounds, p.ada_rounds, p.svm_iter, p.mlp_iter) == (100, 30, 100, 50, 1000, 1000)


def test_queries_fit_whole_models():
    from lexis.plans import model_queries

    assert model_queries.PARAMS == C.SuiteParams()


WORDS = {"good": "profits soared record gains wolves", "bad": "losses layoffs heavy decline axes", "flat": "unchanged steady session gases"}


def _labelled(spark, n=48):
    rnd = random.Random(8)
    rows = []
    for i in range(n):
        label = sorted(WORDS)[i % 3]
        rows.append((i, f"{rnd.choice(['The', 'Our'])} {' '.join(rnd.choices(WORDS[label].split(), k=6))} number{i}", label))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


SMALL = C.SuiteParams(trees=5, tree_depth=4, boost_rounds=2, ada_rounds=4, svm_iter=10, mlp_hidden=6, mlp_iter=60, leaf_rows=2)


def test_every_model_saves_loads_and_scores_alike(spark, tmp_path):
    """All models: scored alone, in a batch and after loading, a text gets
    the prediction it had when the model was made."""
    from lexis.plans import pipeline as PL

    df = _labelled(spark)
    prep = PL.prepare_classification(df, "text", "lang", "doc_id", fold=64)
    ranked, models = PL.run_suite(prep, params=SMALL)
    assert set(models) == set(C.SUITE_ORDER)
    accuracy = {r["model"]: r["accuracy"] for r in ranked.collect()}
    assert all(a >= 0.6 for a in accuracy.values()), accuracy
    PL.save_models(models, prep, str(tmp_path / "m"))
    test = df.join(prep.test.select("doc_id"), "doc_id", "left_semi").cache()
    first = test.orderBy("doc_id").limit(1)
    for name in C.SUITE_ORDER:
        rows = prep.features.vectors(prep.test, name)
        made = {r["doc_id"]: int(r["prediction"]) for r in models[name].transform(rows).select("doc_id", "prediction").collect()}
        loaded = PL.load_model(spark, str(tmp_path / "m"), name)
        again = {r["doc_id"]: r for r in PL.score_texts(test, loaded, "text", "doc_id").collect()}
        assert {i: r["prediction"] for i, r in again.items()} == made, name
        assert all(r["predicted_label"] == prep.labels[r["prediction"]] for r in again.values())
        alone = PL.score_texts(first, loaded, "text", "doc_id").collect()
        assert [r["prediction"] for r in alone] == [made[r["doc_id"]] for r in alone], name


def test_pipeline_options(spark):
    from lexis.plans import pipeline as PL

    prep = PL.prepare_classification(_labelled(spark), "text", "lang", "doc_id", use_idf=False,
                                     normalizer={"lemmatize": False, "stem": False, "remove_stop": False, "min_token_length": 4})
    words = {r["term"] for r in prep.features.vocabulary.vocab.collect()}
    assert "soared" in words and "the" not in words and prep.features.lexicon is None
    assert {r["idf"] for r in prep.features.vocabulary.vocab.collect()} == {1.0}
