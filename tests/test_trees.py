import heapq
import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from lexis.operators import boost as B
from lexis.operators import classify as C
from lexis.operators import tfidf as TF
from lexis.operators import trees as T

SPARSE = "id int, label double, indices array<int>, weights array<double>"


def sample(n, classes=3, width=12, seed=1, per_row=5):
    """Rows whose weights lean on the class; weights take few values."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        c = i % classes
        idx = sorted(rnd.sample(range(width), per_row))
        rows.append((i, float(c), idx, [rnd.choice([0.1, 0.2, 0.5, 1.0]) + (0.3 if j % classes == c else 0) for j in idx]))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(sample(240), SPARSE).cache()


def predictions(model, df):
    return {r["id"]: r["prediction"] for r in model.transform(df).select("id", "prediction").collect()}


def test_tree_and_forest_equal_spark_ml(spark, rows):
    from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier

    vectors = TF.vectors(rows, 12)
    theirs = DecisionTreeClassifier(maxDepth=9).fit(vectors)
    own = T.Forest(1, 9, 3, 12, "all", False).fit(rows)
    assert predictions(own, rows) == predictions(theirs, vectors)
    assert own.term[0] == theirs._call_java("rootNode").split().featureIndex()
    other = spark.createDataFrame(sample(90, seed=5), SPARSE)
    assert predictions(own, other) == predictions(theirs, TF.vectors(other, 12))
    theirs = RandomForestClassifier(numTrees=3, maxDepth=4, featureSubsetStrategy="all", bootstrap=False).fit(vectors)
    assert predictions(T.Forest(3, 4, 3, 12, "all", False).fit(rows), rows) == predictions(theirs, vectors)


def test_dense_vectors_and_depth_limits(spark, rows):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    rnd = random.Random(4)
    df = spark.createDataFrame([(i, float(i % 2), Vectors.dense([rnd.choice([0.0, 1.0, 2.0, 4.0]) + i % 2, rnd.random()]))
                                for i in range(25)], ["id", "label", "features"])
    theirs = DecisionTreeClassifier(maxDepth=5).fit(df)
    assert predictions(T.Forest(1, 5, 2, 2, "all", False).fit(df), df) == predictions(theirs, df)
    stump = T.Forest(1, 1, 3, 12, "all", False).fit(rows)
    assert len(stump.tree) == 3 and len(T.Forest(1, 0, 3, 12).fit(rows).tree) == 1


def test_forest_on_a_wide_vocabulary(spark):
    """Every term of 200,000 counts by itself; nothing is folded."""
    rnd = random.Random(2)
    data = []
    for i in range(300):
        c = i % 3
        own = sorted({c + 3 * rnd.randrange(10) for _ in range(4)} | {30 + rnd.randrange(199_970) for _ in range(20)})
        data.append((i, float(c), own, [1.0] * len(own)))
    df = spark.createDataFrame(data, SPARSE)
    tree = T.Forest(1, 30, 3, 200_000, "all", False).fit(df)
    assert C.accuracy(tree.transform(df)) > 0.95
    forest = T.Forest(20, 30, 3, 200_000).fit(df)
    assert len(set(forest.tree.tolist())) == 20 and C.accuracy(forest.transform(df)) > 0.6
    copies = T.poisson_copies(np.arange(20000), 3, 7)
    assert abs(copies.mean() - 1) < 0.02 and abs((copies == 0).mean() - math.exp(-1)) < 0.02


def test_cells_travel_packed_each_part_by_itself():
    """A pass hands on one row for the cells of a part, not one row a cell."""
    data = T.Binned(None, None, 4, 3)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(40)), pa.array([i % 2 for i in range(40)], pa.int32()),
         pa.array([[i % 7, 7 + i % 11] for i in range(40)], pa.list_(pa.int32())),
         pa.array([[1 + i % 3, 1] for i in range(40)], pa.list_(pa.int16()))], ["row", "label", "terms", "bins"])
    nodes = T.Nodes()
    root = nodes.add(0, 0)

    def look(batch, sparse, arrays):
        stats = np.zeros((batch.num_rows, 1, 2))
        stats[np.arange(batch.num_rows), 0, batch.column("label").to_numpy()] = 1
        return np.zeros((batch.num_rows, 1), np.int64), stats

    run, _ = T.sum_cells(data, look, nodes, [root], 2, T.Subset())
    made = list(run([batch]))
    assert sum(b.num_rows for b in made) <= 2 * data.parts  # cells and totals
    found, totals = {}, []
    for node, term, bin_, stats in T.unpacked(made, 2):
        for t, b, s in zip(term.tolist(), bin_.tolist(), stats.tolist()):
            if t < 0:
                totals.append(s)
            else:
                assert (t, b) not in found
                found[t, b] = s
    want: dict = {}
    for i in range(40):
        for cell in ((i % 7, 1 + i % 3), (7 + i % 11, 1)):
            want.setdefault(cell, [0.0, 0.0])[i % 2] += 1
    assert found == want and totals == [[20.0, 20.0]] * data.parts


def test_weights_dealt_by_term_meet_the_facts_of_their_rows(spark, rows, monkeypatch):
    """Every weight is in one piece; a part has the whole sums of its cells, so that no cells travel."""
    monkeypatch.setattr(T, "PART_WEIGHTS", 300)
    data = T.binned(rows, 32)
    assert data.parts == 5 and T.binned(rows, 32) is data and T.binned(rows, 16) is not data
    nodes = T.Nodes()
    front = [nodes.add(0, 0), nodes.add(1, 0)]

    def look(batch, sparse, arrays):
        stats = np.ones((batch.num_rows, 2, 2))
        stats[:, 0, 0] = batch.column("label").to_numpy()
        stats[:, 1, 1] = batch.column("row").to_numpy() % 7
        return np.tile([0, 1], (batch.num_rows, 1)), stats

    pieces = data.by_term().unionByName(data.rows.mapInArrow(*T.row_facts(look, nodes, front)).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(4))))).toArrow()
    found, total, sums = {}, [], T.sums_of_part(data, nodes, front)
    for p in range(5):
        part = pieces.filter(pa.compute.equal(pieces["part"], p)).sort_by([("block", "ascending"), ("kind", "ascending")])
        cells: dict = {}
        for node, term, bin_, stats in sums(part.to_batches(max_chunksize=3), 2):
            for n, t, b, s in zip(node.tolist(), term.tolist(), bin_.tolist(), stats):
                cells[n, t, b] = cells.get((n, t, b), 0) + s
        total.append({n: cells.pop((n, -1, 0)).tolist() for n in front})
        assert not cells.keys() & found.keys()
        found |= cells
    want, whole = {}, {0: np.zeros(2), 1: np.zeros(2)}
    for r in data.rows.collect():
        for n, s in ((0, [r["label"], 1.0]), (1, [1.0, r["row"] % 7])):
            whole[n] += s
            for t, b in zip(r["terms"], r["bins"]):
                want[n, t, b] = want.get((n, t, b), 0) + np.array(s)
    assert {k: v.tolist() for k, v in found.items()} == {k: v.tolist() for k, v in want.items()}
    assert total == [{n: s.tolist() for n, s in whole.items()}] * 5
    # a part must not meet other rows than those it was made from
    short = part.set_column(part.schema.get_field_index("n"), "n", pa.array([n + k for n, k in zip(
        part["n"].to_pylist(), part["kind"].to_pylist())], pa.int32()))
    with pytest.raises(RuntimeError, match="met the rows"):
        list(sums(short.to_batches(), 2))


@pytest.mark.parametrize("name", ["AdaBoost", "Decision Tree", "Random Forest"])
def test_several_partitions_give_the_same_model(spark, rows, name, monkeypatch):
    def grown():
        m = C.fit_model(name, rows, 12, 3, C.SuiteParams(trees=4, tree_depth=5, ada_rounds=5))
        return (m.stumps, np.round(m.alphas, 9).tolist()) if name == "AdaBoost" else (m.term.tolist(), m.threshold.tolist())

    one = grown()
    monkeypatch.setattr(T, "PART_WEIGHTS", 100)
    monkeypatch.setattr(T, "FLUSH", 64)
    assert grown() == one


def test_weights_of_a_class_of_terms():
    batch = pa.RecordBatch.from_arrays(
        [pa.array([list(range(i, 60, 1 + i % 4)) for i in range(30)], pa.list_(pa.int32())),
         pa.array([[1] * len(range(i, 60, 1 + i % 4)) for i in range(30)], pa.list_(pa.int16()))], ["terms", "bins"])
    sparse, subset = T.Batch(batch), T.Subset(5, 2, 3)
    node, use = np.arange(30) % 4, np.arange(30) % 3 > 0
    want = np.flatnonzero(use[sparse.row_of] & (subset.of_terms(sparse.terms) == subset.of_nodes(node)[sparse.row_of]))
    assert len(want) and T.ByClass(sparse, subset).weights(node, use).tolist() == want.tolist()


def test_bins_by_halving_and_quantiles_of_frequent_terms_only(spark):
    cuts = [[], [0.5]] + [[i / 7 for i in range(1, n)] for n in (5, 13, 16, 32)]
    df = spark.createDataFrame([(c, k / 14) for c in cuts for k in range(70)], "cuts array<double>, weight double")
    for r in df.select("cuts", "weight", T.bin_of(F.col("cuts"), F.col("weight"), 32).alias("bin")).collect():
        assert r["bin"] == sum(c < r["weight"] for c in r["cuts"])
    entries = spark.createDataFrame([(t, float(1 + i % (5 + t))) for t in range(4) for i in range(3 + 10 * t)], "term int, weight double")
    for r in T.cut_points(entries, 8).collect():
        values = sorted({float(1 + i % (5 + r["term"])) for i in range(3 + 10 * r["term"])})
        if len(values) < 8:
            assert r["cuts"] == [(a + b) / 2 for a, b in zip([0.0, *values], values)]
        else:
            assert r["cuts"] == sorted(set(r["cuts"])) and len(r["cuts"]) < 8


def test_many_values_go_to_quantile_bins(spark):
    rnd = random.Random(9)
    df = spark.createDataFrame([(i, float(x > 0.37), [0], [x]) for i in range(2000) for x in [rnd.random() + 1e-6]], SPARSE)
    data = T.binned(df, 16)
    cuts = data.cuts.first()["cuts"]
    assert 10 <= len(cuts) <= 15 and cuts == sorted(cuts)
    assert C.accuracy(T.Forest(1, 1, 2, 1, "all", False, bins=16).fit(df).transform(df)) > 0.95
    with pytest.raises(ValueError, match="not negative"):
        T.binned(df.withColumn("weights", F.array(F.lit(-1.0))))


def test_empty_rows_and_one_class(spark):
    df = spark.createDataFrame([(0, 0.0, [], []), (1, 0.0, None, None), (2, 0.0, [3], [0.5])], SPARSE)
    for name in C.SPARSE:
        model = C.fit_model(name, df, 5, 2, C.SuiteParams(trees=2, boost_rounds=2, ada_rounds=2, svm_dims=8))
        assert predictions(model, df) == {0: 0.0, 1: 0.0, 2: 0.0}, name


def log_loss(model, rows):
    total = 0.0
    for _, label, idx, w in rows:
        scores = model.start.copy()
        for t in sorted(set(model.tree.tolist())):
            node = int(np.flatnonzero(model.tree == t)[0])
            while model.left[node] >= 0:
                x = dict(zip(idx, w)).get(int(model.term[node]), 0.0)
                node = int(model.right[node] if x > model.threshold[node] else model.left[node])
            scores += model.value[node]
            # trees of a round are added together
            if t % len(scores) == len(scores) - 1:
                losses.setdefault(t // len(scores), 0.0)
                losses[t // len(scores)] -= math.log(B.softmax(scores[None, :])[0][int(label)])
    return total


losses: dict = {}


@pytest.mark.parametrize("kind", ["friedman", "leaf-wise", "second-order"])
def test_several_partitions_give_the_same_trees(spark, rows, kind, monkeypatch):
    def grown():
        m = B.Boosting(kind, 3, rounds=3, rate=0.2, depth=3, leaves=6, least_rows=5).fit(rows)
        return m.term.tolist(), m.threshold.tolist(), np.round(m.value, 9).tolist()

    one = grown()
    monkeypatch.setattr(T, "PART_WEIGHTS", 100)
    monkeypatch.setattr(T, "FLUSH", 64)
    assert grown() == one


@pytest.mark.parametrize("kind", ["friedman", "leaf-wise", "second-order"])
def test_log_loss_falls_in_every_round(spark, rows, kind):
    """Thirteen rounds, so that scores are written once in between."""
    model = B.Boosting(kind, 3, rounds=13, rate=0.2, depth=3, leaves=6, least_rows=5).fit(rows)
    losses.clear()
    log_loss(model, sample(240))
    falling = [losses[r] for r in range(13)]
    assert all(a > b for a, b in zip(falling, falling[1:])) and falling[0] < 240 * math.log(3)
    assert C.accuracy(model.transform(rows)) > 0.8


BY_HAND = [(0, 0.0, [0], [1.0]), (1, 0.0, [0], [1.0]), (2, 0.0, [0], [1.0]), (3, 1.0, [1], [1.0]), (4, 1.0, [], []), (5, 0.0, [1], [1.0])]


def test_first_trees_by_hand(spark):
    """Four rows of class 0 and two of class 1.  Term 0 separates {0, 1, 2} from {3, 4, 5}."""
    df = spark.createDataFrame(BY_HAND, SPARSE)
    # friedman: p = (2/3, 1/3) at first; g of class 0 is 1/3 for its rows, -2/3 for the others.
    # rows with term 0: sum g = 1, sum |g|(1-|g|) = 3 * 2/9; leaf = 1/2 * 1 / (2/3) = 0.75
    m = B.Boosting("friedman", 2, rounds=1, rate=1.0, depth=1).fit(df)
    assert m.term[0] == 0 and m.threshold[0] == 0.5
    assert m.value[m.right[0]][0] == pytest.approx(0.75)
    # the others: g = -2/3, -2/3, 1/3: sum -1, curvature 3 * 2/9
    assert m.value[m.left[0]][0] == pytest.approx(-0.75)
    # second order: p = 1/2, g = +-1/2, h = 2 * 1/4 each; leaf of the rows with term 0: 1.5 / (1.5 + 1)
    m = B.Boosting("second-order", 2, rounds=1, rate=1.0, depth=1, lam=1.0).fit(df)
    assert m.value[m.right[0]][0] == pytest.approx(1.5 / 2.5) and m.value[m.left[0]][0] == pytest.approx(-0.5 / 2.5)
    # gain 1/2 (1.5^2/2.5 + 0.5^2/2.5 - 1^2/4) = 0.375; a larger gamma leaves the root alone
    assert len(B.Boosting("second-order", 2, rounds=1, depth=1, gamma=0.374).fit(df).tree) == 6
    assert len(B.Boosting("second-order", 2, rounds=1, depth=1, gamma=0.376).fit(df).tree) == 2
    # leaf-wise: least rows of a leaf
    assert len(B.Boosting("leaf-wise", 2, rounds=1, least_rows=3).fit(df).tree) == 6
    assert len(B.Boosting("leaf-wise", 2, rounds=1, least_rows=4).fit(df).tree) == 2


def test_best_first_growth_equals_one_split_at_a_time():
    """Random gains: waves of passes choose what strict best-first growth chooses."""
    for seed in range(30):
        def gain(path, seed=seed):
            return random.Random(f"{seed}{path}").random() * 0.8 ** len(path)

        nodes, paths, passes = T.Nodes(), {}, []
        root = nodes.add(0, 0, np.ones(3))
        paths[root] = ""

        def look(front):
            passes.append(len(front))
            for i in front:
                if i not in paths:
                    parent = next(j for j in paths if i in (nodes.left[j], nodes.right[j]))
                    paths[i] = paths[parent] + ("l" if nodes.left[parent] == i else "r")
                nodes.best[i] = (gain(paths[i]), 1, 0, np.ones(3) / 2)

        class Any:
            may_split = staticmethod(lambda total: True)

        B.grow_by_leaf(look, nodes, [root], 12, Any())
        heap, want = [(-gain(""), "")], set()
        while len(want) < 11:
            _, p = heapq.heappop(heap)
            want.add(p)
            for c in "lr":
                heapq.heappush(heap, (-gain(p + c), p + c))
        assert {paths[i] for i in paths if nodes.left[i] >= 0} == want
        assert len(passes) < 11


def test_leaf_wise_goes_deeper_than_depth_wise(spark, rows):
    leafy = B.Boosting("leaf-wise", 3, rounds=1, leaves=5, least_rows=5).fit(rows)
    flat = B.Boosting("second-order", 3, rounds=1, depth=2).fit(rows)

    def depths(m, t):
        out, front = [], [(int(np.flatnonzero(m.tree == t)[0]), 0)]
        while front:
            i, d = front.pop()
            if m.left[i] >= 0:
                front += [(int(m.left[i]), d + 1), (int(m.right[i]), d + 1)]
            else:
                out.append(d)
        return sorted(out)

    assert all(len(depths(leafy, t)) == 5 for t in range(3)) and all(max(depths(flat, t)) == 2 for t in range(3))
    assert max(max(depths(leafy, t)) for t in range(3)) > 2


def test_adaboost_votes_in_one_projection(spark, rows):
    model = C.AdaBoost(rounds=8, num_classes=3).fit(rows)
    plan = model.transform(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Exchange" not in plan
    found = predictions(model, rows)
    for i, _, idx, w in sample(240):
        votes = [0.0] * 3
        for (term, cut, below, above), a in zip(model.stumps, model.alphas):
            votes[above if dict(zip(idx, w)).get(term, 0.0) > cut else below] += a
        assert found[i] == votes.index(max(votes))
    # the first stump is Spark ML's
    from pyspark.ml.classification import DecisionTreeClassifier

    first = DecisionTreeClassifier(maxDepth=1).fit(TF.vectors(rows, 12))
    assert model.stumps[0][0] == first._call_java("rootNode").split().featureIndex()


def test_vectors_without_a_python_worker(spark, rows):
    from pyspark.ml.linalg import Vectors

    made = TF.vectors(rows, 12)
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()
    want = {i: Vectors.sparse(12, idx, w) for i, _, idx, w in sample(240)}
    assert {r["id"]: r["features"] for r in made.collect()} == want
    back = {r["id"]: (r["indices"], r["weights"]) for r in TF.as_sparse(made).collect()}
    assert back == {i: (idx, w) for i, _, idx, w in sample(240)}
    dense = TF.dense_vectors(spark.createDataFrame([(1, [1.0, 0.0])], "id int, z array<double>"), "z")
    assert dense.first()["features"] == Vectors.dense([1.0, 0.0])
    assert TF.as_sparse(dense).first()["weights"] == [1.0, 0.0]
    folded = {r["id"]: dict(zip(r["indices"], r["weights"])) for r in TF.folded(rows, 5).collect()}
    for i, _, idx, w in sample(240):
        slots: dict = {}
        for j, x in zip(idx, w):
            slots[j % 5] = slots.get(j % 5, 0.0) + x
        assert folded[i] == pytest.approx(slots)


def rings(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        r, a = (0.4 if i % 2 == 0 else 1.0) + rnd.gauss(0, 0.04), rnd.random() * 2 * math.pi
        out.append((i, float(i % 2), [0, 1], [r * math.cos(a), r * math.sin(a)]))
    return out


def test_kernel_machine_separates_two_rings(spark):
    from lexis.operators import kernel as K

    train, test = spark.createDataFrame(rings(300, 1), SPARSE), spark.createDataFrame(rings(200, 2), SPARSE)
    p = C.SuiteParams(svm_dims=128, svm_iter=25)
    kernel = C.fit_model("Support Vector Machine", train, 2, 2, p)
    linear = C.fit_model("Linear Support Vector Machine", TF.vectors(train, 2), 2, 2, p)
    assert C.accuracy(kernel.transform(test)) > 0.97
    assert C.accuracy(linear.transform(TF.vectors(test, 2))) < 0.75
    mean = sum(x for r in rings(300, 1) for x in r[3]) / 600
    variance = sum((x - mean) ** 2 for r in rings(300, 1) for x in r[3]) / 600
    assert kernel.gamma == pytest.approx(1 / (2 * variance))
    # three classes: pairs vote
    three = spark.createDataFrame([(i, float(i % 3), [i % 3], [1.0 + i % 5 / 10]) for i in range(60)], SPARSE)
    model = K.KernelSvm(3, 3, dims=64, max_iter=20).fit(three)
    assert model.pairs == [(0, 1), (0, 2), (1, 2)] and C.accuracy(model.transform(three)) == 1.0


def test_random_features_approximate_the_kernel():
    import pyarrow as pa

    from lexis.operators import kernel as K

    rnd = random.Random(3)
    idx = [sorted(rnd.sample(range(1000), 6)) for _ in range(20)]
    w = [[rnd.random() for _ in x] for x in idx]
    batch = pa.RecordBatch.from_arrays([pa.array(idx, pa.list_(pa.int32())), pa.array(w)], ["indices", "weights"])
    z = K.fourier(T.Batch(batch, "weights"), 4096, 0.7, 5)
    dense = np.zeros((20, 1000))
    for i, (j, x) in enumerate(zip(idx, w)):
        dense[i, j] = x
    exact = np.exp(-0.7 * ((dense[:, None] - dense[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).max() < 0.08


def test_random_features_of_common_and_rare_terms_follow_their_formula():
    """Terms of nearly all rows, of few rows and of none: each row's features are the cosines of the sum of its
    terms' frequencies, whether they are multiplied as a dense block or cell by cell."""
    from lexis.operators import kernel as K
    from lexis.operators.trees import _mix

    rng = np.random.default_rng(4)
    n, dims, gamma, seed = 1300, 70, 0.3, 9
    rows = [sorted({0, 1, *rng.integers(2, 4000, int(rng.integers(0, 9))).tolist()}) if i % 50 else [] for i in range(n)]
    values = [rng.normal(size=len(r)).tolist() for r in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))],
                                       ["indices", "weights"])
    found = K.fourier(T.Batch(batch, "weights"), dims, gamma, seed)
    u = (_mix(np.arange(4000)[:, None], np.arange(dims)[None, :], seed, 1) + 1) / float(1 << 63)
    v = _mix(np.arange(4000)[:, None], np.arange(dims)[None, :], seed, 2) / float(1 << 63)
    normal = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v) * np.sqrt(2 * gamma)
    dense = np.zeros((n, 4000))
    for i, (r, x) in enumerate(zip(rows, values)):
        dense[i, r] = x
    phase = _mix(np.arange(dims), seed, 3) / float(1 << 63) * 2 * np.pi
    assert np.abs(found - np.sqrt(2 / dims) * np.cos(dense @ normal + phase)).max() < 1e-12


def test_a_pair_of_classes_reads_only_its_own_rows(spark):
    from lexis.operators import kernel as K

    rows = [(float(i % 3), [i % 3, 3 + i % 5], [1.0, 0.2]) for i in range(60)]
    machine = K.KernelSvm(3, 8, dims=16, max_iter=20)
    df = spark.createDataFrame(rows, "label double, indices array<int>, weights array<double>")
    features = machine.features(df, 1.0)
    plan = features.where("label in (0.0, 2.0)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [label" in plan, plan
    assert features.count() == 60 and dict(features.dtypes)["label"] == "double"
    model = machine.fit(df)
    assert model.pairs == [(0, 1), (0, 2), (1, 2)] and C.accuracy(model.transform(df)) == 1.0
