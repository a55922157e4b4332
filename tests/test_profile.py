import pytest

from lexis.operators.profile import (class_distribution, column_profile, dataset_overview,
                                     summarize_dataset, text_length_profile)


def test_overview(spark, sample_frame):
    df = sample_frame.drop("row_id")
    r = dataset_overview(df, "Sentence").first()
    assert r["rows"] == 4 and r["duplicate_texts"] == 1
    assert r["columns"] == 2 and r["total_missing"] == 0


def test_column_profile(spark, sample_frame):
    rows = {r["column"]: r for r in column_profile(sample_frame.drop("row_id")).collect()}
    assert rows["Sentence"]["unique"] == 3 and rows["Sentiment"]["unique"] == 3
    assert rows["Sentence"]["dtype"] == "string" and rows["Sentence"]["missing_pct"] == 0.0


def test_class_distribution(spark, sample_frame):
    rows = class_distribution(sample_frame, "Sentiment").collect()
    assert [(r["Sentiment"], r["count"], r["percentage"]) for r in rows] == [
        ("negative", 2, 50.0), ("neutral", 1, 25.0), ("positive", 1, 25.0)]
    assert abs(sum(r["percentage"] for r in rows) - 100.0) < 1e-9


def test_text_lengths(spark, sample_frame):
    rows = {r["stat"]: (r["char_count"], r["word_count"])
            for r in text_length_profile(sample_frame, "Sentence", "Sentiment").collect()}
    assert rows == {
        "overall_mean": (44.5, 7.0), "overall_min": (41.0, 6.0), "overall_max": (46.0, 8.0),
        "mean[negative]": (46.0, 7.0), "mean[neutral]": (41.0, 6.0), "mean[positive]": (45.0, 8.0),
    }


def test_unknown_column(spark, sample_frame):
    with pytest.raises(KeyError):
        summarize_dataset(sample_frame, "nope", "Sentiment")


def test_distinct_values_of_any_type(spark):
    df = spark.sql("""select * from values
        (1, 0.0D, 'a', true, array(1, null), cast('2024-01-01' as date), X'00ff', timestamp_seconds(0), 1.50),
        (2, -0.0D, 'a', true, array(1, null), cast('2024-01-01' as date), X'00fe', timestamp_seconds(0.000001), 1.50),
        (3, 1.5D, '', null, array(1), null, X'00ff', timestamp_seconds(0), 2.50),
        (null, null, null, null, null, null, null, null, null)
        as t(i, d, s, b, a, day, x, ts, n)""")
    profile = column_profile(df)
    rows = {r["column"]: (r["missing"], r["unique"]) for r in profile.collect()}
    assert rows == {"i": (1, 3), "d": (1, 2), "s": (1, 2), "b": (2, 1), "a": (1, 2), "day": (2, 1), "x": (1, 2),
                    "ts": (1, 2), "n": (1, 2)}
    assert "Expand" not in profile._jdf.queryExecution().executedPlan().toString()
    assert {r["unique"] for r in column_profile(df.limit(0)).collect()} == {0}
