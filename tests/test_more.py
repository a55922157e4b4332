from pyspark.sql import functions as F

from lexis.operators import tokens as K
from lexis.operators.profile import dataset_overview, text_length_profile
from lexis.sources.files import read_csv_table, write_csv_table

SF1 = "/root/testdata/sf0.001"


def test_lemma_rules_shortest_candidate_in_lexicon(spark):
    vocab = spark.createDataFrame([(w,) for w in ["companies", "company", "buses", "bus", "buse",
                                                  "wolves", "wolf", "glass", "men", "man", "churches", "church", "cats"]],
                                  "token string")
    got = {r["token"]: r["lemma"] for r in K.lemma_rules(vocab).collect()}
    assert got["companies"] == "company"
    assert got["buses"] == "bus"          # "bus" (ses->s) is shorter than "buse" (s->"")
    assert got["wolves"] == "wolf"
    assert got["men"] == "men"            # same length: the word itself wins the tie
    assert got["churches"] == "church"
    assert got["cats"] == "cats"          # "cat" is not in the lexicon
    assert got["glass"] == "glass"


def test_stopwords_union_contains_extras():
    words = set(K.stopword_list())
    assert {"rt", "amp", "will", "the", "and"} <= words


def test_csv_na_strings_become_null(spark, tmp_path):
    df = spark.createDataFrame([(1, "NA"), (2, "ok, \"quoted\"\nline"), (3, "")], "id bigint, t string")
    path = write_csv_table(df, str(tmp_path / "c"))
    back = {r["id"]: r["t"] for r in read_csv_table(spark, path, "id bigint, t string").collect()}
    assert back == {1: None, 2: 'ok, "quoted"\nline', 3: None}


def test_profile_with_nulls(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), ("x y", None), ("x y", "b")],
                               "t string, l string")
    r = dataset_overview(df, "t").first()
    assert r["duplicate_texts"] == 2 and r["total_missing"] == 3
    rows = {x["stat"]: x["word_count"] for x in text_length_profile(df, "t", "l").collect()}
    assert rows["overall_mean"] == 1.0 and rows["mean[a]"] == 0.0 and "mean[None]" not in rows


def test_model_roundtrip_same_predictions(spark):
    from lexis.plans.model_queries import q_model_roundtrip

    rows = q_model_roundtrip(spark, SF1).collect()
    assert rows and all(r["prediction"] == r["reloaded_prediction"] for r in rows)
