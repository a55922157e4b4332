"""Support vector machine with an RBF kernel (C5) by random Fourier features, one-vs-one.

exp(-gamma |x - y|^2) is the mean of cos(w.x + b) cos(w.y + b) over w ~ N(0, 2 gamma) and a
uniform phase b (Rahimi and Recht, 2007); ``dims`` of these cosines replace the kernel.
The frequencies of a term follow from its number and the seed, so no width x dims matrix
exists anywhere: a batch makes those of the terms it holds.  On the cosines a linear machine
is fitted by Spark ML for every pair of classes, on the rows of the two, and the pairs vote;
ties go to the smaller class.  The cosines are written once, by class, so a pair reads its own
two, and PARALLEL pairs are fitted at the same time.

gamma = 1 / (width * Var X), the variance over all cells of the sparse matrix; C is per row.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.operators.tfidf import as_sparse, dense_vectors
from lexis.operators.trees import Batch, _mix, _stir
from lexis.session import ship_package

CHUNK = 64  # frequencies made at a time
SLICE = 512  # terms whose frequencies are made at a time: what fits a core's cache
CELLS = 4096  # cells multiplied at a time, likewise
ROWS = 512  # rows of a dense block of common terms
COMMON = 4096  # most terms of that block
DENSE = 0.005  # share of the rows from which on a term is common
PARALLEL = 3  # pairs of classes fitted at the same time
_START = np.uint64(0x9E3779B97F4A7C15)


def frequencies(terms: np.ndarray, first: int, count: int, seed: int) -> np.ndarray:
    """Standard normal numbers of each term for dimensions first ... first +
    count - 1, by the Box-Muller transform of hashed uniforms."""
    out = np.empty((len(terms), count))
    for b in range(0, count, CHUNK):
        dim = np.arange(first + b, first + min(count, b + CHUNK))[None, :]
        for a in range(0, len(terms), SLICE):
            h = _stir(_START, terms[a:a + SLICE, None], dim, seed)
            u = (_mix(1, h=h) + 1) / float(1 << 63)
            v = _mix(2, h=h) / float(1 << 63)
            out[a:a + SLICE, b:b + CHUNK] = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)
    return out


def fourier(sparse: Batch, dims: int, gamma: float, seed: int) -> np.ndarray:
    """Rows x dims random Fourier features of a batch of sparse rows.  Terms of many rows
    are multiplied as a dense block, the others cell by cell."""
    out = np.zeros((sparse.n, dims))
    terms, place, count = np.unique(sparse.terms, return_inverse=True, return_counts=True)
    common = np.argsort(-count, kind="stable")[:COMMON]
    common = common[count[common] > max(1, DENSE * sparse.n)]
    slot = np.full(len(terms), -1)
    slot[common] = np.arange(len(common))
    cell = slot[place]
    if len(common):
        normal = frequencies(terms[common], 0, dims, seed) * np.sqrt(2 * gamma)
        dense = cell >= 0
        row, column, value = sparse.row_of[dense], cell[dense], sparse.values[dense]
        begin = np.searchsorted(row, np.arange(0, sparse.n + ROWS, ROWS))
        for k, a in enumerate(range(0, sparse.n, ROWS)):
            part, block = slice(begin[k], begin[k + 1]), np.zeros((min(ROWS, sparse.n - a), len(common)))
            np.add.at(block, (row[part] - a, column[part]), value[part])
            out[a:a + ROWS] = block @ normal
    rest = cell < 0
    row, value = sparse.row_of[rest], sparse.values[rest]
    rare, place = np.unique(place[rest], return_inverse=True)
    step = max(1, int(CELLS * sparse.n / max(1, len(row))))
    begin = np.searchsorted(row, np.arange(sparse.n + 1))
    for first in range(0, dims if len(rare) else 0, CHUNK):
        width = min(CHUNK, dims - first)
        normal = frequencies(terms[rare], first, width, seed) * np.sqrt(2 * gamma)
        for a in range(0, sparse.n, step):
            b = min(sparse.n, a + step)
            part = slice(begin[a], begin[b])
            products = normal[place[part]] * value[part][:, None]
            filled = np.flatnonzero(np.diff(begin[a:b + 1]))
            if len(filled):
                out[a + filled, first:first + width] += np.add.reduceat(products, begin[a + filled] - begin[a], axis=0)
    phase = _mix(np.arange(dims), seed, 3) / float(1 << 63) * 2 * np.pi
    out += phase
    np.cos(out, out=out)
    out *= np.sqrt(2 / dims)
    return out


def scale_gamma(rows: DataFrame, width: int) -> float:
    """1 / (width * variance of all cells, zeros included)."""
    r = as_sparse(rows).select(F.aggregate("weights", F.lit(0.0), lambda a, x: a + x).alias("s"),
                               F.aggregate("weights", F.lit(0.0), lambda a, x: a + x * x).alias("q")) \
        .agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.count(F.lit(1)).alias("n")).first()
    cells = (r["n"] or 0) * width
    if not cells:
        raise ValueError("no rows to fit")
    variance = r["q"] / cells - (r["s"] / cells) ** 2
    return 1.0 / (width * variance) if variance > 0 else 1.0


class KernelSvmModel:
    """Coefficients per pair of classes over the random features."""

    def __init__(self, dims, gamma, seed, num_classes, pairs, coefficients, intercepts):
        self.dims, self.gamma, self.seed, self.k = dims, gamma, seed, num_classes
        self.pairs = [tuple(p) for p in pairs]
        self.coefficients, self.intercepts = np.asarray(coefficients, float), np.asarray(intercepts, float)

    def votes(self, sparse: Batch) -> np.ndarray:
        out = np.zeros((sparse.n, self.k))
        if self.pairs:
            margin = fourier(sparse, self.dims, self.gamma, self.seed) @ self.coefficients.T + self.intercepts
            for i, (a, b) in enumerate(self.pairs):
                out[:, b] += margin[:, i] > 0
                out[:, a] += margin[:, i] <= 0
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` to sparse rows."""
        from pyspark.sql.types import DoubleType, StructField, StructType

        ship_package(df.sparkSession)
        df = as_sparse(df)
        model = df.sparkSession.sparkContext.broadcast(self)

        def run(batches):
            for batch in batches:
                best = model.value.votes(Batch(batch, "weights")).argmax(axis=1).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best)], [*batch.schema.names, "prediction"])

        return df.mapInArrow(run, StructType([*df.schema.fields, StructField("prediction", DoubleType())]))

    def save(self, path: str, spark: SparkSession) -> None:
        rows = [(a, b, c.tolist(), float(i)) for (a, b), c, i in zip(self.pairs, self.coefficients, self.intercepts)]
        rows = rows or [(-1, -1, [], 0.0)]
        spark.createDataFrame([(*r, self.dims, float(self.gamma), self.seed, self.k) for r in rows],
                              "a int, b int, coefficients array<double>, intercept double, dims int, gamma double, seed int, "
                              "classes int").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "KernelSvmModel":
        rows = spark.read.parquet(path).orderBy("a", "b").collect()
        r, rows = rows[0], [r for r in rows if r["a"] >= 0]
        return cls(r["dims"], r["gamma"], r["seed"], r["classes"], [(x["a"], x["b"]) for x in rows],
                   [x["coefficients"] for x in rows], [x["intercept"] for x in rows])


@dataclass
class KernelSvm:
    num_classes: int
    num_features: int
    c: float = 1.0
    gamma: float | None = None  # None: scale_gamma
    dims: int = 1024
    max_iter: int = 1000
    tol: float = 1e-3
    seed: int = 42

    def features(self, rows: DataFrame, gamma: float) -> DataFrame:
        """(label, features) with dense vectors of random features, written once in folders by label."""
        dims, seed = self.dims, self.seed

        def run(batches):
            for batch in batches:
                z = fourier(Batch(batch, "weights"), dims, gamma, seed)
                offsets = np.arange(0, z.size + 1, dims, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(z.ravel()))], ["label", "z"])

        rows = as_sparse(rows).select(F.col("label").cast("double").alias("label"), "indices", "weights")
        return dense_vectors(rows.mapInArrow(run, "label double, z array<double>"), "z", "features", ["label"])

    def fit(self, train: DataFrame) -> KernelSvmModel:
        from pyspark.ml.classification import LinearSVC

        ship_package(train.sparkSession)
        train = as_sparse(train).select("label", "indices", "weights")
        gamma = self.gamma if self.gamma is not None else scale_gamma(train, self.num_features)
        rows = self.features(train, gamma)
        counts = {int(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}
        pairs = list(combinations(sorted(counts), 2))

        def one(pair):
            a, b = pair
            two = rows.where(F.col("label").isin(float(a), float(b))).select(
                "features", (F.col("label") == float(b)).cast("double").alias("label"))
            model = LinearSVC(maxIter=self.max_iter, tol=self.tol, regParam=1.0 / (self.c * (counts[a] + counts[b])),
                              standardization=False).fit(two)
            return model.coefficients.toArray(), model.intercept

        if not pairs:  # one class: its own pair always votes for it
            only = next(iter(counts), 0)
            return KernelSvmModel(self.dims, gamma, self.seed, self.num_classes, [(only, only)], np.zeros((1, self.dims)), [0.0])
        with ThreadPool(min(PARALLEL, len(pairs))) as pool:
            fitted = pool.map(inheritable_thread_target(train.sparkSession)(one), pairs, 1)
        return KernelSvmModel(self.dims, gamma, self.seed, self.num_classes, pairs, *zip(*fitted))
