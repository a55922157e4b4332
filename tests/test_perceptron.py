import numpy as np
import pyarrow as pa
import pytest

from lexis.operators import classify as C
from lexis.operators.perceptron import BLOCK, Adam, Gradient, Perceptron, PerceptronModel, Weights, gradient
from lexis.operators.trees import Batch

DDL = "label double, indices array<int>, weights array<double>"


def sparse(n, width, seed, classes=3):
    """Rows of up to six terms, some empty; rows with labels 0, 1, 2."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        terms = sorted(rng.choice(width, size=int(rng.integers(0, 7)), replace=False).tolist())
        rows.append((float(i % classes), [int(t) for t in terms], [float(x) for x in rng.normal(size=len(terms))]))
    return rows


def batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                                       pa.array([r[2] for r in rows], pa.list_(pa.float64()))],
                                      ["label", "indices", "weights"])


def summed(rows, w):
    g = Gradient(w)
    g.add(Batch(batch(rows), "weights"), np.array([r[0] for r in rows], int))
    return g


def test_gradient_equals_finite_differences():
    rows, w = sparse(40, 9, 1), Weights.start(9, 5, 3, 2)
    g = summed(rows, w)
    assert g.n == 40
    for x, slope in zip(w.arrays, (g.w1, g.b1, g.w2, g.b2)):
        for at in np.ndindex(x.shape):
            kept, step = x[at], 1e-6
            x[at] = kept + step
            up = summed(rows, w).loss
            x[at] = kept - step
            down = summed(rows, w).loss
            x[at] = kept
            assert abs((up - down) / (2 * step) - slope[at]) < 1e-5, at


def test_gradient_of_all_tasks_equals_that_of_one_batch(spark):
    """Terms in several blocks, rows in several tasks."""
    width = 2 * BLOCK + 100
    rows = sparse(200, width, 3) + [(1.0, [BLOCK - 1, BLOCK, 2 * BLOCK], [1.0, 2.0, 3.0])] * 5
    w = Weights.start(width, 4, 3, 5)
    df = spark.createDataFrame(rows, DDL).repartition(7)
    for found in (gradient(df, w), gradient(df, w, 50)):  # the second in two steps
        _same(found, summed(rows, w))


def _same(found, want):
    assert found.n == want.n == 205 and abs(found.loss - want.loss) < 1e-9
    for a, b in ((found.w1, want.w1), (found.b1, want.b1), (found.w2, want.w2), (found.b2, want.b2)):
        assert np.abs(a - b).max() < 1e-10


def test_first_step_of_adam_is_the_rate_against_the_sign():
    x = np.array([1.0, -2.0, 0.5])
    Adam([x], 0.1).step([x], [np.array([3.0, -0.01, 0.0])])
    assert np.allclose(x, [0.9, -1.9, 0.5], atol=1e-6)


def test_learns_what_no_linear_model_can(spark, tmp_path):
    """Exclusive or of two terms, with rows that have neither; the loss falls
    and a saved model predicts the same."""
    corners = [(0.0, [], []), (1.0, [0], [1.0]), (1.0, [1], [1.0]), (0.0, [0, 1], [1.0, 1.0])]
    df = spark.createDataFrame(corners * 12, DDL)
    model = Perceptron(2, 2, units=16, max_iter=150, rate=0.05).fit(df)
    assert model.losses[-1] < 0.1 < model.losses[0]
    assert C.accuracy(model.transform(df)) == 1.0
    model.save(str(tmp_path / "m"), spark)
    again = PerceptronModel.load(str(tmp_path / "m"), spark)
    assert all((a == b).all() for a, b in zip(model.weights.arrays, again.weights.arrays))


def test_whole_vocabulary_in_one_text(spark):
    """Class marks stand at far ends of a wide vocabulary: no term is folded
    into another's place."""
    width = 3 * BLOCK
    rows = [(float(i % 3), sorted({(i % 3) * BLOCK + 7, 100 + i}), [1.0, 0.3] if i % 3 else [1.0, 1.0]) for i in range(60)]
    df = spark.createDataFrame([(a, b, c[:len(b)]) for a, b, c in rows], DDL)
    model = Perceptron(3, width, units=8, max_iter=60, rate=0.05).fit(df)
    assert C.accuracy(model.transform(df)) == 1.0


def test_defined_cases(spark):
    empty = spark.createDataFrame([], DDL)
    with pytest.raises(ValueError, match="no rows"):
        Perceptron(2, 3, units=2).fit(empty)
    with pytest.raises(ValueError, match="more than 5 weights"):
        Perceptron(2, 3, units=2, max_weights=5).fit(empty)
    one = spark.createDataFrame([(0.0, [1], [1.0]), (0.0, None, None), (0.0, [], [])], DDL)
    model = Perceptron(1, 3, units=2, max_iter=3).fit(one)
    assert [r["prediction"] for r in model.transform(one).collect()] == [0.0] * 3
    assert model.transform(empty).count() == 0


def test_ends_when_the_loss_falls_no_more(spark):
    df = spark.createDataFrame([(0.0, [0], [1.0]), (1.0, [0], [1.0])], DDL)  # nothing to learn
    model = Perceptron(2, 1, units=2, max_iter=500, tol=0.5, patience=3).fit(df)
    assert len(model.losses) < 10


def test_a_first_layer_in_a_table_gives_the_same_model(spark, monkeypatch, tmp_path):
    """Weights too many to broadcast: the same losses, weights and predictions, parts and blocks cut small, with
    a term that no row has, rows without terms, and a caller's column called ``part``."""
    from pyspark.sql import functions as F

    from lexis.operators import perceptron as P

    df = spark.createDataFrame(sparse(120, 50, 3) + [(2.0, None, None)], DDL).withColumn("part", F.lit("mine"))
    fit = lambda: Perceptron(3, 60, units=4, max_iter=5, rate=0.05).fit(df)
    want = fit()
    with monkeypatch.context() as m:
        m.setattr(P, "SHARED", 0)
        m.setattr(P, "PART", 40)  # more parts than cores
        m.setattr(P, "GROUP_CELLS", 4 * 10 * 7)  # blocks of a few terms
        found = fit()
        found.save(str(tmp_path / "m"), spark)
        again = PerceptronModel.load(str(tmp_path / "m"), spark)
        assert found.layer and again.layer and found.layer.size < 60 and found.size == again.size == 240
        assert np.allclose(found.losses, want.losses, rtol=1e-12, atol=0)
        for a, b, c in zip(want.weights.arrays, found.weights.arrays, again.weights.arrays):
            assert np.allclose(a, b, rtol=0, atol=1e-9) and (b == c).all()
        rows = lambda model: sorted(map(str, model.transform(df).collect()))
        assert rows(found) == rows(again) == rows(want)
        assert found.transform(df.limit(0)).count() == 0
        assert Perceptron(3, 60, units=4, max_iter=50, tol=9.0, patience=2).fit(df).losses[2:] != []
        with pytest.raises(ValueError, match="no rows"):
            Perceptron(2, 3, units=2).fit(df.limit(0))
