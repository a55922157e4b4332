import random

import numpy as np
import pytest

from lexis.operators import boost as B
from lexis.operators import trees as T


@pytest.fixture(scope="module")
def train(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(90):
        idx = sorted(rnd.sample(range(14), rnd.randint(0, 6)))
        rows.append((float((i + (idx[0] if idx else 0)) % 3), idx, [round(rnd.random() + 0.1, 2) for _ in idx]))
    return spark.createDataFrame(rows, "label double, indices array<int>, weights array<double>").cache()


MODELS = {"friedman": lambda: B.Boosting("friedman", 3, rounds=3, rate=0.2, depth=3),
          "leaf-wise": lambda: B.Boosting("leaf-wise", 3, rounds=3, rate=0.2, leaves=6, least_rows=5),
          "second-order": lambda: B.Boosting("second-order", 3, rounds=3, rate=0.2, depth=3),
          "tree": lambda: T.Forest(1, 8, 3, None, "all", False),
          "adaboost": lambda: B.AdaBoost(6, 1.0, 3)}


def facts(m):
    if isinstance(m, B.AdaBoostModel):
        return m.stumps, np.round(m.alphas, 9).tolist()
    return m.term.tolist(), m.threshold.tolist(), m.left.tolist(), np.round(m.value, 9).tolist()


@pytest.mark.parametrize("name", list(MODELS))
def test_state_on_the_driver_gives_the_same_models(train, name, monkeypatch):
    """With rows' state on the driver no pass shuffles; beyond MAX_HELD the passes by shuffle grow the same trees."""
    monkeypatch.setattr(T, "PART_WEIGHTS", 60)
    passes, search = [], T.look_for_splits
    monkeypatch.setattr(T, "look_for_splits", lambda *a, **b: passes.append(1) or search(*a, **b))
    held = facts(MODELS[name]().fit(train))
    assert not passes
    monkeypatch.setattr(T, "MAX_HELD", 0)
    assert facts(MODELS[name]().fit(train)) == held and passes
