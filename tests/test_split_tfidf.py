import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexis.operators import split as SP
from lexis.operators import tfidf as TF

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("bad", [0, 1, 1.5])
def test_test_size_rejected(bad):
    with pytest.raises(ValueError):
        SP.check_test_size(bad)


def test_quotas_fixture():
    q = SP.train_quotas({"de": 129, "en": 620, "es": 106, "fr": 145}, 0.25)
    assert {k: c - q[k] for k, c in {"de": 129, "en": 620, "es": 106, "fr": 145}.items()} == \
        {"de": 32, "en": 155, "es": 27, "fr": 36}


def test_split_counts_and_bucketed_rank(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    s = SP.stratified_split(d, "lang", "doc_id", test_size=0.25, seed=42)
    counts = {r["lang"]: r["count"] for r in s.where("split = 'test'").groupBy("lang").count().collect()}
    assert counts == {"de": 32, "en": 155, "es": 27, "fr": 36}
    # same membership as a plain per-class window ranking
    q = SP.train_quotas({r[0]: r[1] for r in d.groupBy("lang").count().collect()}, 0.25)
    w = Window.partitionBy("lang").orderBy(SP.split_key("doc_id", 42), "doc_id")
    plain = d.withColumn("r", F.row_number().over(w)).collect()
    expect = {r["doc_id"]: ("train" if r["r"] <= q[r["lang"]] else "test") for r in plain}
    got = {r["doc_id"]: r["split"] for r in s.collect()}
    assert got == expect


def test_three_way(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    s = SP.three_way_split(d, "lang", "doc_id", test_size=0.1, validation_size=0.2)
    c = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert c["test"] == 100 and c["validation"] == 180 and c["train"] == 720


def test_tfidf_long_form_and_vectors_agree(spark):
    docs = spark.createDataFrame(
        [(0, "apple banana apple"), (1, "banana cherry"), (2, "cherry cherry date"), (3, "x")],
        "id bigint, t string")
    w, model = TF.fit_transform(docs, "t", "id", min_df=0.0, max_df=1.0)
    long = {(r["id"], r["term"]): r["weight"] for r in w.collect()}
    n = 4
    idf = {t: math.log((1 + n) / (1 + df)) + 1 for t, df in
           {"apple": 1, "banana": 2, "cherry": 2, "date": 1}.items()}
    raw = {"apple": 2 * idf["apple"], "banana": idf["banana"]}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert abs(long[(0, "apple")] - raw["apple"] / norm) < 1e-12
    assert not any(k[0] == 3 for k in long)  # no term -> zero vector
    tf = TF.term_frequency(TF.terms(docs, "t", "id"), "id")
    model = TF.fit(tf, n, min_df=0.0, max_df=1.0, index=True)
    rows = TF.sparse_rows(TF.transform(tf, model, "id", index=True), "id")
    vocab = {r["term_index"]: r["term"] for r in model.vocab.collect()}
    assert [vocab[i] for i in sorted(vocab)] == ["apple", "banana", "cherry", "date"]
    for r in TF.vectors(rows, len(vocab)).collect():
        v = r["features"].toArray()
        assert all(abs(v[i] - long.get((r["id"], term), 0.0)) < 1e-12 for i, term in vocab.items())
    for r in TF.vectors(rows, len(vocab), fold=2).collect():  # every term is in one of two slots
        v = r["features"].toArray()
        want = [sum(long.get((r["id"], term), 0.0) for i, term in vocab.items() if i % 2 == slot) for slot in (0, 1)]
        assert abs(v[0] - want[0]) < 1e-12 and abs(v[1] - want[1]) < 1e-12


def test_empty_vocabulary_raises(spark):
    docs = spark.createDataFrame([(0, "aa bb"), (1, "aa cc")], "id bigint, t string")
    tf = TF.term_frequency(TF.terms(docs, "t", "id"), "id")
    with pytest.raises(ValueError):
        TF.fit(tf, 2, min_df=5, max_df=1.0)


@pytest.mark.parametrize("again", [False, True])
def test_counted_terms_as_by_shuffle_and_written_once(spark, again):
    """A row's terms are counted inside it; repeated ids are added up."""
    rows = [(1, "b a b  c B", "x"), (2, "", "x"), (3, None, "y"), (4, "zz " * 5000 + "yy", "y"), (None, "aa aa bb", "y")]
    rows += [(1, "bb aa", "x"), (1, "aa", "y"), (None, "aa", "y")] if again else []
    d = spark.createDataFrame(rows, "id bigint, t string, s string")
    want = TF.term_frequency(TF.terms(d, "t", "id", ("s",)), "id", ("s",))
    got = TF.counted_terms(d, "t", "id", ("s",))
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and "regexp_extract_all" not in plan  # fit and transform don't count anew


def test_lookup_joins_only_values_that_differ(spark):
    from lexis.operators import tokens as K

    toks = spark.createDataFrame([(1, 0, "cats"), (1, 1, "cat"), (2, 0, "dogs"), (2, 1, "x"), (2, 2, "n")], "id int, pos int, token string")
    table = spark.createDataFrame([("cats", "cat"), ("cat", "cat"), ("dogs", "dog"), ("dogs", "dig"), ("x", "x"), ("n", None)],
                                  "token string, lemma string")
    out = K.apply_lookup(toks, table)
    assert sorted(tuple(r) for r in out.select("id", "pos", "token").collect()) == \
        [(1, 0, "cat"), (1, 1, "cat"), (2, 0, "dig"), (2, 1, "x"), (2, 2, "n")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(token" not in plan
