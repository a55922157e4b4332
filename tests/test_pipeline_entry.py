import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from lexis.streaming import stream as ST


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["model", "accuracy", "position", "rank"]


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_clean_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(0, "Hi @x http://a.b THERE")], "doc_id bigint, text string") \
        .write.parquet(str(src))
    out = ST.run_to_parquet(ST.clean_stream(ST.read_text_stream(spark, str(src), "doc_id bigint, text string"),
                                            "text"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(out).first()["text"] == "hi there"


def test_sequences_fixed_length(spark):
    from lexis.operators import sequences as Q

    df = spark.createDataFrame([(0, "a b a"), (1, ""), (2, " ".join(["w"] * 300))], "id bigint, t string")
    vocab = Q.build_vocabulary(Q.positioned_tokens(df, "t", "id"))
    rows = {r["id"]: r for r in Q.encode_sequences(df, "t", "id", vocab, 8).collect()}
    assert all(len(r["input_ids"]) == 8 and len(r["attention_mask"]) == 8 for r in rows.values())
    assert rows[1]["input_ids"] == [0, 2, 1, 1, 1, 1, 1, 1]
    ids = {r["token"]: r["token_id"] for r in vocab.collect()}
    assert rows[0]["input_ids"][:5] == [0, ids["a"], ids["b"], ids["a"], 2]
    assert rows[2]["attention_mask"] == [1] * 8


def test_queries_load_without_a_jvm():
    """A fresh process with nothing but the zipped pyspark on its path, no
    SparkContext and no jars folder."""
    import glob
    import subprocess
    import sys

    import pyspark

    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = glob.glob(f"{lib}/pyspark.zip") + glob.glob(f"{lib}/py4j-*.zip")
    root = os.path.dirname(os.path.abspath(E.__file__))
    code = ("import __spark_entry__ as e; from pyspark import SparkContext; "
            "print(len(e.queries()), len(e.oracle_sql()), SparkContext._active_spark_context)")
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120,
                          env=os.environ | {"PYTHONPATH": ":".join(zips)})
    assert done.returncode == 0, done.stderr[-2000:]
    n, m, context = done.stdout.split()[-3:]
    assert int(n) >= 68 and int(m) >= 51 and context == "None"


def test_first_rows_in_table_order(spark):
    """A preview is the first rows of the ordering column."""
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id bigint, t string")
    assert [r["t"] for r in df.orderBy("id").limit(2).collect()] == ["a", "b"]


def test_stream_scores_like_a_batch(spark, tmp_path):
    from lexis.operators import classify as C
    from lexis.plans import pipeline as PL

    rows = [(i, ("profits soared wolves" if i % 2 else "heavy losses axes") + f" n{i}", "ab"[i % 2]) for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    prep = PL.prepare_classification(df, "text", "lang", "doc_id")
    model = PL.fit_and_predict(prep, "Naive Bayes", C.SuiteParams())[0]
    PL.save_models({"Naive Bayes": model}, prep, str(tmp_path / "m"))
    loaded = PL.load_model(spark, str(tmp_path / "m"), "Naive Bayes")
    for i in range(3):
        df.where(F.col("doc_id") % 3 == i).select("doc_id", "text").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ST.read_text_stream(spark, str(tmp_path / "in"), "doc_id bigint, text string", max_files_per_trigger=1)
    ST.score_stream(stream, lambda b: PL.score_texts(b, loaded, "text", "doc_id"), str(tmp_path / "out"), str(tmp_path / "ck"))
    streamed = {r["doc_id"]: r["predicted_label"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {r["doc_id"]: r["predicted_label"] for r in PL.score_texts(df, loaded, "text", "doc_id").collect()}
    assert streamed == batch and len(streamed) == 24


def test_pipeline_sequences_same_as_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    rel = con.sql(E.oracle_sql()["pipeline_sequences"])
    want = sorted(tuple(r) for r in rel.fetchall())
    got = E.queries()["pipeline_sequences"](spark, sf).select(rel.columns).collect()
    assert want and sorted(tuple(r) for r in got) == want
