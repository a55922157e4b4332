"""Classifier suite.

Estimators take training rows with a double ``label`` and either sparse rows (``indices``,
``weights``) or a ``features`` vector; fitted models add a double ``prediction``.

Every model takes the whole vocabulary.  Trees, forest, boosting, AdaBoost, the kernel
machine and the perceptron work on sparse rows (``trees``, ``boost``, ``kernel``,
``perceptron``); the linear machine and Naive Bayes are Spark ML's and take vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.operators.boost import AdaBoost, AdaBoostModel, Boosting
from lexis.operators.kernel import KernelSvm, KernelSvmModel
from lexis.operators.perceptron import Perceptron, PerceptronModel
from lexis.operators.trees import Forest, TreeModel

SUITE_ORDER = (
    "Random Forest", "Gradient Boosting", "AdaBoost", "Decision Tree",
    "Support Vector Machine", "Linear Support Vector Machine", "Naive Bayes", "Multilayer Perceptron",
    "LightGBM-style boosting", "XGBoost-style boosting",
)
# Models on sparse rows, with the class that loads them; the others take vectors.
SPARSE = {"Random Forest": TreeModel, "Gradient Boosting": TreeModel, "Decision Tree": TreeModel,
          "LightGBM-style boosting": TreeModel, "XGBoost-style boosting": TreeModel, "AdaBoost": AdaBoostModel,
          "Support Vector Machine": KernelSvmModel, "Multilayer Perceptron": PerceptronModel}
PARALLEL = 4  # binary models of a one-vs-rest estimator trained at the same time


@dataclass
class SuiteParams:
    seed: int = 42
    trees: int = 100
    tree_depth: int = 30
    tree_bins: int = 32
    boost_rounds: int = 100
    boost_bins: int = 255
    leaf_rows: int = 20  # least rows of a leaf in leaf-wise boosting
    ada_rounds: int = 50
    svm_iter: int = 1000
    svm_c: float = 1.0
    svm_tol: float = 1e-3  # the usual stopping tolerance of a support vector machine
    svm_dims: int = 1024  # random Fourier features of the kernel machine
    mlp_hidden: int = 100
    mlp_iter: int = 1000  # most steps; training ends when the loss falls no more
    mlp_rate: float = 0.02


def build_estimator(name: str, num_features: int, num_classes: int, p: SuiteParams,
                    num_rows: int | None = None):
    """One unfitted estimator of the suite.  ``num_rows`` (training rows)
    turns the linear machine's C into Spark's ``regParam = 1 / (C * n)``."""
    from pyspark.ml.classification import LinearSVC, NaiveBayes, OneVsRest

    if name == "Random Forest":
        return Forest(p.trees, p.tree_depth, num_classes, num_features, "sqrt", True, p.tree_bins, p.seed)
    if name == "Decision Tree":
        return Forest(1, p.tree_depth, num_classes, num_features, "all", False, p.tree_bins, p.seed)
    if name == "Gradient Boosting":
        return Boosting("friedman", num_classes, p.boost_rounds, 0.1, depth=3, bins=p.boost_bins)
    if name == "LightGBM-style boosting":
        return Boosting("leaf-wise", num_classes, p.boost_rounds, 0.1, leaves=31, least_rows=p.leaf_rows,
                        bins=p.boost_bins)
    if name == "XGBoost-style boosting":
        return Boosting("second-order", num_classes, p.boost_rounds, 0.3, depth=6, lam=1.0, bins=p.boost_bins)
    if name == "Support Vector Machine":
        return KernelSvm(num_classes, num_features, p.svm_c, None, p.svm_dims, p.svm_iter, p.svm_tol, p.seed)
    if name == "Linear Support Vector Machine":
        reg = 1.0 / (p.svm_c * num_rows) if num_rows else 0.0
        # no feature standardisation, as in a plain SVC on TF-IDF (and it
        # converges several times faster on sparse, L2-normalised rows)
        return OneVsRest(classifier=LinearSVC(maxIter=p.svm_iter, tol=p.svm_tol, regParam=reg,
                                              standardization=False),
                         parallelism=min(num_classes, PARALLEL))
    if name == "Naive Bayes":
        return NaiveBayes(smoothing=1.0, modelType="multinomial")
    if name == "Multilayer Perceptron":
        return Perceptron(num_classes, num_features, p.mlp_hidden, p.mlp_iter, p.mlp_rate, seed=p.seed)
    if name == "AdaBoost":
        return AdaBoost(p.ada_rounds, 1.0, num_classes, p.tree_bins)
    raise KeyError(f"unknown classifier {name!r}")


# ---------------------------------------------------------------------------
# Train every model, score, accuracy
# ---------------------------------------------------------------------------

def fit_model(name: str, train: DataFrame, num_features: int, num_classes: int,
              params: SuiteParams | None = None):
    rows = train.count() if name == "Linear Support Vector Machine" else None
    est = build_estimator(name, num_features, num_classes, params or SuiteParams(), rows)
    return est.fit(train)


def accuracy(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> float:
    """A12 as a number (one aggregate job)."""
    r = pred.agg(F.avg((F.col(pred_col).cast("double") == F.col(label_col).cast("double"))
                       .cast("double"))).first()[0]
    return float(r) if r is not None else float("nan")
