import random

import pyarrow as pa
from pyspark.sql import functions as F

from lexis.functions import stem as S
from lexis.functions.text import clean_text
from lexis.operators import tokens as K
from lexis.plans import pipeline as PL


def test_stem_of_one_word_is_the_column_form(spark):
    rnd = random.Random(3)
    ends = [x[0] if isinstance(x, tuple) else x for x in (*S.STEP2, *S.STEP3, *S.STEP4)] + [
        "", "'s", "'", "ing", "ed", "edly", "ingly", "eedly", "eed", "ies", "ied", "sses", "y", "e", "ll", "us", "ss", "s"]
    words = {"".join(rnd.choice("abdeilnotuysxw'") for _ in range(rnd.randint(0, 6))) + rnd.choice(ends) for _ in range(3000)}
    df = spark.createDataFrame([(w,) for w in sorted({*words, *S.EXCEPTIONS, *S.AFTER_1A})], "w string")
    assert [r for r in df.select("w", S.stem_column(F.col("w")).alias("s")).collect() if S.stem_word(r.w) != r.s] == []


def test_every_distinct_word_is_stemmed_once(spark, monkeypatch):
    """The kernel gives the texts of the column form."""
    met = []
    monkeypatch.setattr(K, "_STEMS", {})
    monkeypatch.setattr(K, "stem_word", lambda w: met.append(w) or S.stem_word(w))
    rows = [["profits", "axes", "profits", "only"], None, [], ["foxes", "profits", "running", "gains"], ["only"]] * 3
    lemmas = [["axes"], None, [], ["foxes", "gains"], []] * 3
    to = {"axes": "axe", "foxes": "fox", "gains": "only"}
    kind = pa.list_(pa.string())
    out = K.finished_texts(True, ["onli", "run"])(pa.array(rows, kind), pa.array([x or [] for x in lemmas], kind),
                                                  pa.array([[to[w] for w in x or []] for x in lemmas], kind))
    assert out.to_pylist() == ["profit axe profit", "", "", "fox profit", ""] * 3
    assert len(met) == len(set(met))


def test_tokens_are_prepared_once(spark, monkeypatch):
    """Lexicon and texts come from the same written tokens, and words are stemmed in a kernel."""
    tables, write = [], K.written

    def noted(df, name):
        tables.append((name, df.columns))
        return write(df, name)

    monkeypatch.setattr(K, "written", noted)
    rows = [(i, f"Wolves running, {w} axes foxes of the wolf", "ab"[i % 2]) for i, w in enumerate("one two three four five six seven eight".split())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    prep = PL.prepare_classification(df, "text", "lang", "doc_id", min_df=1, max_df=100)
    assert [name for name, _ in tables].count("tokens") == 1
    words = {r["term"] for r in prep.features.vocabulary.vocab.collect()}
    assert {"wolf", "run", "fox"} <= words and "wolv" not in words
    out = K.normalize_text(df, "text", "doc_id")
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()


def test_plain_texts_are_split_as_they_are(spark):
    texts = ["can't stop", "a bb  ccc", "", None, "Ünder the bridge", "tab\there", " lead the end ", "x yy", "don t won't Kelvin"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", clean_text(F.col("t")).alias("c"))
    got = df.select(K.token_array(F.col("t"), remove_stop=False), K.token_array(F.col("c"), remove_stop=False)).collect()
    assert [r[0] for r in got] == [["can", "not", "stop"], ["bb", "ccc"], [], [], ["nder", "the", "bridge"], ["tab", "here"],
                                   ["lead", "the", "end"], ["xyy"], ["don", "will", "not", "kelvin"]]
    assert [r[1] for r in got][1:4] == [["bb", "ccc"], [], []]
