"""Boosted trees for any number of classes (C2, C8, C9) and SAMME AdaBoost (C3), grown
on sparse rows by the passes of ``trees``.

A round of boosting grows one tree per class, all of them in the same passes, on the
gradients of the multi-class log-loss: g = [label is c] - p_c, with p the softmax of a
row's scores.  The three kinds differ in what a round does:

* ``Friedman``: depth-wise, split by the difference of the children's mean gradients,
  leaves by one Newton step with the curvature sum |g| (1 - |g|), times (K - 1) / K.
* ``LeafWise``: the leaf with the largest gain is split first, up to a number of leaves;
  gain and leaves from gradient and curvature sums, with least rows and curvature per leaf.
* ``SecondOrder``: depth-wise, the same sums with a penalty on leaf values (lam) and on the
  number of leaves (gamma).

The driver holds the scores of up to ``trees.MAX_HELD`` rows x classes.  Beyond that a row's scores are
kept in a narrow table that is written every STEP rounds; in between a pass adds the values of the trees made since.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.operators import trees as T
from lexis.operators.tfidf import as_sparse
from lexis.session import cut_lineage, ship_package

STEP = 10


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Friedman:
    """Statistics (g, |g| (1 - |g|), rows)."""

    counts = False
    least_gain = 1e-12  # smaller ones are rounding errors
    least_rows = 1

    def __init__(self, classes: int):
        self.factor = (classes - 1) / classes

    def curvature(self, g, p):
        return np.abs(g) * (1 - np.abs(g))

    def may_split(self, total) -> bool:
        return total[2] >= 2

    def __call__(self, left, total):
        right = total - left
        nl, nr = left[:, 2], right[:, 2]
        with np.errstate(divide="ignore", invalid="ignore"):
            gap = left[:, 0] / nl - right[:, 0] / nr
            gain = nl * nr / (nl + nr) * gap * gap
        return np.where((nl >= 1) & (nr >= 1), gain, -np.inf)

    def leaf(self, total) -> float:
        return self.factor * total[0] / total[1] if total[1] > 1e-150 else 0.0


class Newton:
    """Statistics (g, h, rows): gain and leaf values of second order, with
    penalties lam and gamma and least rows and curvature of a leaf."""

    counts = False
    least_gain = 1e-12  # smaller ones are rounding errors

    def __init__(self, lam: float, gamma: float, least_curvature: float, least_rows: int, scale: float):
        self.lam, self.gamma, self.least_curvature, self.least_rows = lam, gamma, least_curvature, least_rows
        self.scale = scale  # of the curvature p (1 - p)

    def curvature(self, g, p):
        return np.maximum(self.scale * p * (1 - p), 1e-16)

    def may_split(self, total) -> bool:
        return total[2] >= 2 * self.least_rows and total[1] >= 2 * self.least_curvature

    def __call__(self, left, total):
        right = total - left
        allowed = (left[:, 2] >= self.least_rows) & (right[:, 2] >= self.least_rows) \
            & (left[:, 1] >= self.least_curvature) & (right[:, 1] >= self.least_curvature)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 0.5 * sum(sign * x[:, 0] ** 2 / (x[:, 1] + self.lam)
                             for x, sign in ((left, 1), (right, 1), (total, -1))) - self.gamma
        return np.where(allowed, gain, -np.inf)

    def leaf(self, total) -> float:
        return total[0] / (total[1] + self.lam) if total[1] + self.lam > 0 else 0.0


def grow_by_depth(look, nodes: T.Nodes, roots: list, depth: int, score) -> None:
    """All trees level by level."""
    front = roots
    for _ in range(depth):
        if not front:
            return
        look(front)
        front = [c for i in front if nodes.best[i] is not None for c in nodes.split(i)]
        front = [i for i in front if score.may_split(nodes.total[i])]


def best_first(nodes: T.Nodes, root: int, leaves: int) -> list:
    """Nodes split by taking the leaf of the largest known gain each time."""
    heap, out = [], []

    def offer(i):
        if isinstance(nodes.best[i], tuple):
            heapq.heappush(heap, (-nodes.best[i][0], i))

    offer(root)
    while heap and len(out) < leaves - 1:
        _, i = heapq.heappop(heap)
        out.append(i)
        if nodes.left[i] >= 0:
            offer(nodes.left[i])
            offer(nodes.right[i])
    return out


def grow_by_leaf(look, nodes: T.Nodes, roots: list, leaves: int, score) -> None:
    """All trees best-first.  A pass looks at the children of every node that best-first
    growth would split as far as gains are known.  Gains still unknown can only take
    splits away from the known ones, so every node that the whole growth splits is looked at,
    and only a few passes are needed, not one per split."""
    front = roots
    while front:
        look(front)
        chosen = [best_first(nodes, r, leaves) for r in roots]
        front = []
        for i in (i for c in chosen for i in c if nodes.left[i] < 0):
            for child in nodes.split(i):
                if score.may_split(nodes.total[child]):
                    front.append(child)
                else:
                    nodes.best[child] = None
    kept = {i for c in chosen for i in c}
    for i in range(len(nodes.tree)):
        if nodes.left[i] >= 0 and i not in kept:
            nodes.term[i] = nodes.cut[i] = nodes.left[i] = nodes.right[i] = -1


@dataclass
class Boosting:
    """``kind``: "friedman", "leaf-wise" or "second-order"."""

    kind: str
    num_classes: int
    rounds: int = 100
    rate: float = 0.1
    depth: int = 3
    leaves: int = 31
    lam: float = 1.0
    gamma: float = 0.0
    least_rows: int = 20
    least_curvature: float = 1e-3
    bins: int = 255

    def score(self):
        k = self.num_classes
        if self.kind == "friedman":
            return Friedman(k)
        if self.kind == "leaf-wise":
            return Newton(0.0, 0.0, self.least_curvature, self.least_rows, k / (k - 1))
        if self.kind == "second-order":
            return Newton(self.lam, self.gamma, 1.0, 1, 2.0)
        raise ValueError(f"unknown kind of boosting: {self.kind!r}")

    def fit(self, train: DataFrame) -> T.TreeModel:
        ship_package(train.sparkSession)
        k, score = self.num_classes, self.score()
        data = T.binned(train, self.bins, score.least_rows)
        held = data.held(k)
        counts = {r["label"]: r["count"] for r in data.rows.groupBy("label").count().collect()}
        n = sum(counts.values())
        start = np.zeros(k) if self.kind == "second-order" else np.array([math.log(max(counts.get(c, 0), 1e-9) / n) for c in range(k)])
        model = {name: [] for name in ("tree", "term", "cut", "left", "right", "value", "fixed")}
        state, since = None, 0
        scores = np.tile(start, (held.n, 1)) if held else None

        def scores_of(batch, sparse, recent):
            base = np.tile(start, (batch.num_rows, 1)) if "scores" not in batch.schema.names else \
                batch.column("scores").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            return recent.scores(sparse) + base if recent is not None else base

        def recent_trees():
            """The trees made since scores were last written, in bins."""
            if since == len(model["tree"]):
                return None
            part = {c: np.array(model[c][since:]) for c in ("tree", "term", "cut", "left", "right", "value")}
            for c in ("left", "right"):
                part[c] = np.where(part[c] >= 0, part[c] - since, -1)
            return T.TreeModel(part["tree"], part["term"], part["cut"], part["left"], part["right"], part["value"])

        for r in range(self.rounds):
            nodes, recent = T.Nodes(), None if held else recent_trees()
            roots = [nodes.add(c, 0) for c in range(k)]

            def look(batch, sparse, arrays, recent=recent):
                p = softmax(scores_of(batch, sparse, recent))
                y = batch.column("label").to_numpy()
                g = (y[:, None] == np.arange(k)[None, :]) - p
                at = sparse.route(np.tile(np.arange(k), (batch.num_rows, 1)), arrays["term"], arrays["cut"],
                                  arrays["left"], arrays["right"])
                return at, np.stack([g, score.curvature(g, p), np.ones_like(g)], axis=2)

            def search(front, nodes=nodes, look=look):
                T.look_for_splits(data, state, look, nodes, front, 3, score)

            if held:
                p = softmax(scores)
                g = (held.label[:, None] == np.arange(k)[None, :]) - p
                growth = T.Growth(held, nodes, roots, [g, score.curvature(g, p), 1.0], score)
                search = growth.search
            if self.kind == "leaf-wise":
                grow_by_leaf(search, nodes, roots, self.leaves, score)
            else:
                grow_by_depth(search, nodes, roots, self.depth, score)
            base = len(model["tree"])
            for i in range(len(nodes.tree)):
                value = np.zeros(k)
                if nodes.left[i] < 0:
                    value[nodes.tree[i]] = self.rate * score.leaf(nodes.total[i])
                model["tree"].append(r * k + nodes.tree[i])
                model["term"].append(nodes.term[i])
                model["cut"].append(nodes.cut[i])
                model["left"].append(nodes.left[i] + base if nodes.left[i] >= 0 else -1)
                model["right"].append(nodes.right[i] + base if nodes.left[i] >= 0 else -1)
                model["value"].append(value)
            if held:
                value = np.array([model["value"][base + i][nodes.tree[i]] for i in range(len(nodes.tree))])
                scores += value[growth.leaves()]
            elif (r + 1) % STEP == 0 and r + 1 < self.rounds:
                state = self._scored(data, state, scores_of, recent_trees())
                since = len(model["tree"])
        used = T.Nodes(term=model["term"], cut=model["cut"])
        return T.TreeModel(model["tree"], model["term"], T.thresholds(data, used), model["left"], model["right"],
                           model["value"], start)

    @staticmethod
    def _scored(data: T.Binned, state, scores_of, recent) -> DataFrame:
        """(row, scores), dealt out like the rows."""
        def run(batches):
            for batch in batches:
                s = scores_of(batch, T.Batch(batch), recent)
                offsets = np.arange(0, s.size + 1, s.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(s.ravel()))], ["row", "scores"])

        rows = data.rows if state is None else data.rows.join(state, "row")
        return cut_lineage(rows.mapInArrow(run, "row bigint, scores array<double>").repartition(data.parts, "row"))


# ---------------------------------------------------------------------------
# SAMME AdaBoost with decision stumps
# ---------------------------------------------------------------------------

class AdaBoostModel:
    """A table of stumps (term, threshold, class below or at it, class above
    it) with their stage weights, in order of the rounds."""

    def __init__(self, stumps: list, alphas: list, num_classes: int):
        self.stumps, self.alphas, self.num_classes = stumps, alphas, num_classes

    def transform(self, df: DataFrame, out_col: str = "prediction") -> DataFrame:
        """Vote inside the row: argmax over classes of the summed stage
        weights.  A term that the row lacks weighs 0."""
        from lexis.functions.text import argmax

        df = as_sparse(df)
        table = F.array(*[F.struct(F.lit(int(t)).alias("term"), F.lit(float(c)).alias("cut"), F.lit(int(b)).alias("below"),
                                   F.lit(int(a)).alias("above"), F.lit(float(w)).alias("alpha"))
                          for (t, c, b, a), w in zip(self.stumps, self.alphas)])

        def weight(term):
            at = F.array_position("indices", term).cast("int")
            return F.when(at > 0, F.element_at("weights", F.greatest(at, F.lit(1)))).otherwise(0.0)

        cast = F.transform(table, lambda s: F.struct(
            F.when(weight(s["term"]) > s["cut"], s["above"]).otherwise(s["below"]).alias("cls"), s["alpha"].alias("alpha")))
        votes = F.aggregate(cast, F.array_repeat(F.lit(0.0), self.num_classes), lambda total, v: F.transform(
            total, lambda x, i: x + F.when(i == v["cls"], v["alpha"]).otherwise(0.0)))
        return df.withColumn(out_col, argmax(votes).cast("double"))

    def save(self, path: str, spark: SparkSession) -> None:
        rows = [(i, *s, float(a), self.num_classes) for i, (s, a) in enumerate(zip(self.stumps, self.alphas))]
        spark.createDataFrame(rows, "round int, term int, cut double, below int, above int, alpha double, classes int") \
            .write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "AdaBoostModel":
        rows = spark.read.parquet(path).orderBy("round").collect()
        return cls([(r["term"], r["cut"], r["below"], r["above"]) for r in rows], [r["alpha"] for r in rows], rows[0]["classes"])


class AdaBoost:
    """SAMME: stump on weighted rows; err = weighted error; alpha = rate * (ln((1-err)/err)
    + ln(K-1)); wrong rows' weights grow by exp(alpha); stop when err = 0 (the stump is
    perfect and gets weight 1) or err >= 1 - 1/K.

    A round is one pass: a row's weight follows from the stumps so far and is made in
    the pass; error and totals follow from the sums of the stump's two leaves."""

    def __init__(self, rounds: int = 50, learning_rate: float = 1.0, num_classes: int = 2, bins: int = 32):
        self.rounds, self.rate, self.k, self.bins = rounds, learning_rate, num_classes, bins

    def fit(self, train: DataFrame) -> AdaBoostModel:
        ship_package(train.sparkSession)
        k, data = self.k, T.binned(train, self.bins)
        stumps, alphas, scale = [], [], 0.0  # stumps in bins; scale: log of the weights' mean

        def look(batch, sparse, arrays):
            y = batch.column("label").to_numpy()
            grown = np.full(len(y), -scale)
            rows = np.arange(len(y))
            for (term, cut, below, above), alpha in zip(stumps, alphas):
                cls = np.where(sparse.value(rows, np.full(len(y), term)) > cut, above, below)
                grown += alpha * (cls != y)
            stats = np.zeros((len(y), 1, k + 1))
            stats[rows, 0, y] = np.exp(grown)
            stats[:, 0, k] = 1
            return np.zeros((len(y), 1), np.int64), stats

        held = data.held(1)
        grown = np.zeros(held.n) if held else None
        for _ in range(self.rounds):
            nodes = T.Nodes()
            root = nodes.add(0, 0)
            if held:
                weight = np.exp(grown - scale)
                growth = T.Growth(held, nodes, [root], [
                    *((weight * (held.label == c))[:, None] for c in range(k)), 1.0], T.Gini(counted=True))
                growth.search([root])
            else:
                T.look_for_splits(data, None, look, nodes, [root], k + 1, T.Gini(counted=True))
            total = nodes.total[root][:k]
            if nodes.best[root] is None:  # no split: everything is of the largest class
                term, cut, left = 0, 1 << 30, total
            else:
                _, term, cut, left = nodes.best[root]
                left = left[:k]
            right = np.maximum(total - left, 0)
            below, above = int(left.argmax()), int(right.argmax())
            err = 1 - (left[below] + right[above]) / total.sum()
            perfect = err <= 1e-12
            if perfect or err >= 1 - 1 / k:
                if perfect or not stumps:
                    stumps.append((term, cut, below, above))
                    alphas.append(1.0)
                break
            alpha = self.rate * (math.log((1 - err) / err) + math.log(k - 1))
            stumps.append((term, cut, below, above))
            alphas.append(alpha)
            if held:
                above_cut = np.unpackbits(growth.right[root], count=held.n) if nodes.best[root] is not None else np.zeros(held.n)
                grown += alpha * (np.where(above_cut, above, below) != held.label)
            # right rows keep their weight, wrong ones grow: the mean weight grows by
            scale += math.log(1 - err + err * math.exp(alpha))
        nodes = T.Nodes(term=[s[0] if s[1] < 1 << 30 else -1 for s in stumps], cut=[s[1] for s in stumps])
        at = T.thresholds(data, nodes)
        at = [c if t >= 0 else math.inf for c, t in zip(at, nodes.term)]
        return AdaBoostModel([(t, c, b, a) for (t, _, b, a), c in zip(stumps, at)], alphas, k)
