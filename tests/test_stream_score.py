import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexis.operators import classify as C
from lexis.operators.tokens import lemma_rules
from lexis.plans import pipeline as PL
from lexis.streaming import score as SC
from lexis.streaming import stream as ST

MODELS = ("Naive Bayes", "Linear Support Vector Machine", "Multilayer Perceptron")
PARAMS = C.SuiteParams(svm_iter=20, mlp_hidden=6, mlp_iter=25, trees=2)
TEXTS = ("profits soared wolves gases", "heavy losses axes layoffs", "unchanged matches policies shares")


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    rows = [(i, f"The {TEXTS[i % 3]} n{i % 5} {'Boxes' if i % 2 else 'box'}!", "abc"[i % 3]) for i in range(36)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    prep = PL.prepare_classification(df, "text", "lang", "doc_id", drop_duplicates=False)
    models = {name: PL.fit_and_predict(prep, name, PARAMS)[0] for name in MODELS}
    out = str(tmp_path_factory.mktemp("saved") / "m")
    PL.save_models(models, prep, out)
    return df, {name: PL.load_model(spark, out, name) for name in MODELS}


def new_texts(spark):
    rows = [(1, "Wolves soared, profits and gases"), (2, "axes axe losses losses"), (None, "policies unchanged"), (2, "policy shares box"),
            (3, None), (4, ""), (5, "12 ;; 34"), (6, "nothing known hereabouts"), (7, "loss " * 3000), (8, "men women shes matchess")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def found(df):
    return sorted(((r["doc_id"] is None, r["doc_id"], r["prediction"], r["predicted_label"]) for r in df.collect()),
                  key=str)


def test_rows_are_scored_as_by_joins(spark, trained):
    df, models = trained
    every = new_texts(spark).unionByName(df.select("doc_id", "text"))
    for name, model in models.items():
        rows = SC.score_rows(every, model, "text")
        assert rows.columns == ["doc_id", "prediction", "predicted_label"]
        assert found(rows) == found(PL.score_texts(every, model, "text", "doc_id")), name


def test_one_streaming_query_gives_the_rows_of_a_batch(spark, trained, tmp_path):
    """Several micro-batches into a file sink; no job of a batch of its own."""
    df, models = trained
    every = new_texts(spark).unionByName(df.select("doc_id", "text"))
    for i in range(3):
        every.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ST.read_text_stream(spark, str(tmp_path / "in"), "doc_id bigint, text string", max_files_per_trigger=1)
    model = models["Naive Bayes"]
    scored = SC.score_rows(stream, model, "text")
    assert scored.isStreaming
    out = ST.run_to_parquet(scored, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert found(spark.read.parquet(out)) == found(PL.score_texts(every, model, "text", "doc_id"))


def test_lemmas_as_by_the_rules_table(spark):
    words = ["wolves", "wolf", "boxes", "box", "gases", "gas", "men", "man", "policies", "policy", "classes", "class", "bus", "s", "ss",
             "axes", "axe", "matches", "unknowns"]
    lexicon = [w for w in words if w not in ("unknowns", "axes")]
    want = lemma_rules(spark.createDataFrame([(w,) for w in words], "token string"),
                       spark.createDataFrame([(w,) for w in lexicon], "token string"))
    assert SC.lemmas(words, pa.array(lexicon)) == {r["token"]: r["lemma"] for r in want.collect() if r["token"] != r["lemma"]}


def test_weights_of_rows():
    s = SC.weighted(pa.array([["a", "b", "a", "x"], [], None, ["b"]]), pa.array(["a", "b"]), np.array([1.0, 3.0]))
    assert s.n == 4 and s.row_of.tolist() == [0, 0, 3] and s.terms.tolist() == [0, 1, 1]
    assert np.allclose(s.values, [2 / 13 ** 0.5, 3 / 13 ** 0.5, 1.0])


def test_too_large_or_other_models_are_refused(spark, trained, monkeypatch):
    df, models = trained
    monkeypatch.setattr(SC, "MAX_WORDS", 3)
    with pytest.raises(ValueError, match="more than 3"):
        SC.score_rows(df, models["Naive Bayes"], "text")
    with pytest.raises(ValueError, match="score_stream"):
        SC.fitted(object())


def test_other_columns_stay_and_former_predictions_go(spark, trained):
    df, models = trained
    more = df.select("doc_id", "lang", F.lit(9.5).alias("prediction"), "text")
    out = SC.score_rows(more, models["Naive Bayes"], "text")
    assert out.columns == ["doc_id", "lang", "prediction", "predicted_label"]
    assert out.where("predicted_label = lang").count() == 36
    assert SC.score_rows(more.limit(0), models["Naive Bayes"], "text").count() == 0


@pytest.mark.parametrize("parts", [0, 3])
def test_streams_of_a_table_in_one_file_or_in_a_folder(spark, tmp_path, parts):
    import os

    from lexis.functions.text import clean_text
    from lexis.plans.catalog import QUERIES

    rows = spark.createDataFrame([(i, f"See http://x.y/{i} and @you {i}", "en", "s", 9) for i in range(20)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    to, table = str(tmp_path / "made"), str(tmp_path / "documents.parquet")
    rows.repartition(max(1, parts)).write.parquet(to)
    if parts:
        os.rename(to, table)
    else:
        part = next(f for f in os.listdir(to) if f.startswith("part-"))
        os.rename(os.path.join(to, part), table)
    (tmp_path / "documents.parquet2").mkdir()  # a neighbour that a loose pattern would match
    got = QUERIES["stream_clean_text"](spark, str(tmp_path)).collect()
    want = rows.select("doc_id", clean_text(F.col("text")).alias("text")).collect()
    assert len(got) == 20 and {tuple(r) for r in got} == {tuple(r) for r in want}
