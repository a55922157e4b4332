from lexis.operators import tokens as K

SHAPE = "doc_id bigint, text string"


def test_null_and_repeated_ids_are_lemmatised(spark):
    rows = [(1, "wolves axes"), (None, "wolves axes"), (None, "foxes"), (2, "wolf axe fox"), (2, "axes axes"), (3, None)]
    lexicon = spark.createDataFrame([("wolf",), ("axe",), ("fox",)], "word string")
    out = K.normalize_text(spark.createDataFrame(rows, SHAPE), "text", "doc_id", stem=False, lexicon=lexicon)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "wolf axe"), (None, "wolf axe"), (None, "fox"), (2, "wolf axe fox"), (2, "axe axe"), (3, "")], key=str)


def test_table_with_two_lemmas_of_a_token(spark):
    table = spark.createDataFrame([("axes", "axis"), ("axes", "axe"), ("axes", "axe"), ("wolves", "wolf")], "token string, lemma string")
    df = spark.createDataFrame([(1, "axes wolves axes")], SHAPE)
    out = K.normalize_text(df, "text", "doc_id", stem=False, lemma_table=table)
    assert out.first()["text"] == "axe wolf axe"
    assert sorted(r["token"] for r in K.apply_lookup(K.tokenize(df, "text", "doc_id"), table).collect()) == ["axe", "axe", "wolf"]


def test_features_of_null_and_repeated_ids(spark):
    """Every row keeps its own features."""
    from lexis.operators import tfidf as TF
    from lexis.plans.pipeline import TextFeatures

    df = spark.createDataFrame([(None, "aa bb"), (None, "cc"), (5, "aa"), (5, "zz"), (6, None)], SHAPE)
    vocab = spark.createDataFrame([("aa", 1, 1.0, 0), ("bb", 1, 1.0, 1), ("cc", 1, 1.0, 2)],
                                  "term string, df bigint, idf double, term_index bigint")
    f = TextFeatures(TF.TfidfModel(vocab, 3), 3, {}, None, None)
    found = sorted((r["doc_id"] or 0, list(r["indices"] or [])) for r in f.sparse(df, "text", "doc_id").collect())
    assert found == [(0, [0, 1]), (0, [2]), (5, []), (5, [0]), (6, [])]
