import pytest
from pyspark.sql import functions as F

from lexis.operators.rows import decode_labels, dedup_first, dense_index, encode_labels
from lexis.sources.files import load_labeled_csv, load_labeled_text


def test_load_drops_duplicates_and_encodes(spark, sample_frame):
    df, labels = load_labeled_text(sample_frame, "Sentence", "Sentiment", order_col="row_id")
    rows = df.orderBy("row_id").collect()
    assert len(rows) == 3
    assert labels == ["negative", "neutral", "positive"]
    assert [r["row_id"] for r in rows] == [0, 1, 2]
    assert {r["Sentiment"]: r["label_id"] for r in rows} == {"negative": 0, "neutral": 1, "positive": 2}
    assert all(isinstance(r["label_id"], int) for r in rows)


def test_load_csv(spark, sample_csv):
    df, labels = load_labeled_csv(spark, sample_csv)
    assert df.count() == 3
    assert set(labels) == {"negative", "neutral", "positive"}
    kept = {r["Sentence"] for r in df.collect()}
    assert "Profits soared to a record high this quarter!" in kept


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_labeled_csv(spark, str(tmp_path / "nope.csv"))


def test_missing_columns_raise(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("foo,bar\n1,2\n")
    with pytest.raises(KeyError) as e:
        load_labeled_csv(spark, str(p))
    assert "Sentence" in str(e.value) and "Sentiment" in str(e.value)


def test_dedup_keeps_first_and_groups_nulls(spark):
    df = spark.createDataFrame([(0, None), (1, "a"), (2, None), (3, ""), (4, "a"), (5, "")],
                               "id bigint, t string")
    kept = sorted(r["id"] for r in dedup_first(df, "t", "id").collect())
    assert kept == [0, 1, 3]


def test_dense_index_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id"))
    out = dense_index(df.repartition(7), ["k"], "rid").collect()
    assert sorted((r["k"], r["rid"]) for r in out) == [(i, i) for i in range(5000)]


def test_decode_is_inverse_of_encode(spark, sample_frame):
    enc, labels = encode_labels(sample_frame, "Sentiment")
    dec = decode_labels(enc, labels, "label_id", "back").collect()
    assert all(r["back"] == r["Sentiment"] for r in dec)


def test_null_labels_rejected(spark):
    df = spark.createDataFrame([(0, "x", None), (1, "y", "a")], "id bigint, t string, l string")
    with pytest.raises(ValueError):
        encode_labels(df, "l")
