import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s0", len(t) if t is not None else None) for i, t in rows], SHAPE)

    return make


@pytest.fixture(scope="session")
def prose():
    """Random prose of n words."""
    def make(n, seed):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(["ba", "ke", "li", "mo", "nu", "ra", "so", "ti"]) for _ in range(rng.randint(1, 4)))
                        for _ in range(n))

    return make


@pytest.fixture(scope="session")
def clashing():
    """Adds columns named like the operators' own."""
    from pyspark.sql import functions as F

    def add(df):
        for c in ("score", "kept", "n", "cls", "bands", "line", "pos", "key", "topic", "probability", "words", "unit",
                  "leaf", "start", "m", "h", "y", "g", "r", "rank", "keep", "doc", "tid", "value", "w", "p", "segment",
                  "rule", "verdict", "url_length", "held_out"):
            df = df.withColumn(c, F.lit("clash"))
        return df

    return add
