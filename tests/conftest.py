import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SENTENCES = [
    (0, "Profits soared to a record high this quarter!", "positive"),
    (1, "The company reported heavy losses and layoffs.", "negative"),
    (2, "Shares were unchanged during the session.", "neutral"),
    (3, "The company reported heavy losses and layoffs.", "negative"),
]


@pytest.fixture(scope="session")
def spark():
    from lexis.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="lexis-tests")
    yield s


@pytest.fixture()
def sample_frame(spark):
    return spark.createDataFrame(SENTENCES, "row_id bigint, Sentence string, Sentiment string")


@pytest.fixture()
def sample_csv(tmp_path, spark):
    import csv

    path = tmp_path / "data.csv"
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["Sentence", "Sentiment"])
        for _, s, l in SENTENCES:
            w.writerow([s, l])
    return str(path)
