import pytest
from pyspark.sql import functions as F

from lexis.operators import sequences as Q

TEXTS = [(1, "b a b c"), (2, None), (None, "a a new"), (3, ""), (2, "  c\t b  "), (4, "a b c a b c a b c"), (None, None)]


def frame(spark):
    return spark.createDataFrame(TEXTS, "id bigint, text string").withColumn("side", F.lit("x"))


def expected(max_length):
    """By hand."""
    ids = {"a": 4, "b": 5, "c": 6}
    out = []
    for i, text in TEXTS:
        body = [ids.get(w, 3) for w in (text or "").split()][:max_length - 2]
        seq = [0, *body, 2]
        fill = max_length - len(seq)
        out.append((i, "x", seq + [1] * fill, [1] * len(seq) + [0] * fill))
    return sorted(out, key=str)


@pytest.mark.parametrize("words", [Q.BROADCAST_WORDS, 0])
@pytest.mark.parametrize("max_length", [2, 5, 12])
def test_both_ways_give_the_rows_worked_by_hand(spark, monkeypatch, words, max_length):
    """Null and repeated ids, null, empty and long texts, unknown words."""
    monkeypatch.setattr(Q, "BROADCAST_WORDS", words)
    df = frame(spark)
    vocab = spark.createDataFrame([("a", 4), ("b", 5), ("c", 6)], "token string, token_id int")
    out = Q.encode_sequences(df, "text", "id", vocab, max_length, keep=("side",))
    assert sorted((tuple(r) for r in out.collect()), key=str) == expected(max_length)


def test_empty_vocabulary_and_no_rows(spark):
    none = spark.createDataFrame([], "token string, token_id int")
    out = Q.encode_sequences(frame(spark), "text", "id", none, 4).collect()
    assert len(out) == len(TEXTS) and all(set(r["input_ids"]) <= {0, 1, 2, 3} for r in out)
    assert Q.encode_sequences(frame(spark).limit(0), "text", "id", none, 4).count() == 0


def test_no_shuffle_of_texts_with_a_small_vocabulary(spark):
    vocab = spark.createDataFrame([("a", 4)], "token string, token_id int")
    plan = Q.encode_sequences(frame(spark), "text", "id", vocab, 8)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan
