"""Multilayer perceptron (C7) on the whole vocabulary: one layer of rectified units, softmax
output, Adam on the mean log-loss plus ``alpha`` / 2 * |weights|^2 / rows.

A step is one pass over the sparse rows.  A task adds up the first layer's gradient for the
terms it meets and hands on blocks of BLOCK terms; Spark adds the blocks of all tasks by
shuffle, in two steps if there are many tasks.

Up to SHARED numbers the first layer is broadcast and stepped on the driver, and rows are dealt
out once, in no more parts than the cluster has cores (each part costs one set of blocks).
A larger one is a table of blocks with Adam's means and never whole anywhere: rows are dealt out
in parts of some PART terms, a part gets the weights of the terms it holds by a join, the
parts' gradients meet the table's blocks in a second join, and the stepped table is written.
A step moves the distinct terms of the parts, summed over the parts, twice, and the table; a block has fewer terms the more parts there are, so a group stays within GROUP_CELLS
numbers.  Two tables are kept at a time.  The output layer and the intercepts (units x classes)
stay on the driver.

Weights grow with the vocabulary, not with the rows: a vocabulary of terms in at least the share
``min_df`` of the texts has at most (mean distinct terms of a text) / ``min_df`` terms.  Their
number is checked against ``max_weights``; beyond it ``fit`` raises an error before any pass,
and a higher ``min_df`` or fewer units is the user's choice.

Defined cases: rows without terms are scored from the intercepts; terms outside the fitted
width are an error of the caller; without rows ``fit`` raises an error; a single class is
always predicted.  Ties go to the smaller class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.operators.tfidf import as_sparse
from lexis.operators.trees import Batch
from lexis.session import scratch_path, ship_package, written

BLOCK = 2_048  # terms of a gradient block
CELLS = 1 << 16  # matrix cells multiplied at a time
GROUP = 32  # parts of a block added up in one step
REST = -1  # the block that holds the loss and all gradients but the first layer's
SHARED = 1 << 22  # numbers of a first layer that is broadcast (32 MB)
PART = 1 << 19  # terms of the rows of a part, where the weights are a table
GROUP_CELLS = 1 << 23  # numbers that all parts together hand on for a block (64 MB)
DECAY, DECAY_SQUARE, EPSILON = 0.9, 0.999, 1e-8  # Adam's usual constants


def _spread(inputs: int, outputs: int) -> float:
    """Start weights are uniform within sqrt(6 / (inputs + outputs)) of a layer."""
    return np.sqrt(6 / (inputs + outputs))


@dataclass
class Weights:
    """First layer (width x units), its intercepts, output layer, its intercepts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    @classmethod
    def start(cls, width: int, units: int, classes: int, seed: int) -> "Weights":
        return cls(cls.start_rows(0, width, width, units, seed), *cls.start_rest(width, units, classes, seed))

    @staticmethod
    def start_rows(first: int, last: int, width: int, units: int, seed: int) -> np.ndarray:
        """Start weights of the terms first ... last - 1: their place in the generator's numbers
        follows from the term, so they are the same in whatever blocks they are made."""
        rng, a = np.random.Generator(np.random.PCG64(seed).advance(first * units)), _spread(width, units)
        return rng.uniform(-a, a, (last - first, units))

    @staticmethod
    def start_rest(width: int, units: int, classes: int, seed: int) -> tuple:
        rng = np.random.Generator(np.random.PCG64(seed).advance(width * units))
        a, b = _spread(width, units), _spread(units, classes)
        return rng.uniform(-a, a, units), rng.uniform(-b, b, (units, classes)), rng.uniform(-b, b, classes)

    @property
    def arrays(self) -> tuple:
        return self.w1, self.b1, self.w2, self.b2


def products(rows, matrix: np.ndarray) -> np.ndarray:
    """Sparse rows (n, row_of in order, terms, values) times a width x k matrix."""
    out = np.zeros((rows.n, matrix.shape[1]))
    for a in range(0, len(rows.terms), CELLS):
        part = slice(a, a + CELLS)
        of = rows.row_of[part]
        begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        out[of[begin]] += np.add.reduceat(matrix[rows.terms[part]] * rows.values[part][:, None], begin, axis=0)
    return out


def hidden(rows, w: Weights) -> np.ndarray:
    """Activations of the rectified units, rows x units."""
    return np.maximum(products(rows, w.w1) + w.b1, 0.0)


def probabilities(h: np.ndarray, w: Weights) -> np.ndarray:
    scores = h @ w.w2 + w.b2
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Gradient:
    """Sums over rows: log-loss, number of rows and the gradient of the loss."""

    def __init__(self, w: Weights):
        self.w, self.loss, self.n = w, 0.0, 0
        self.w1, self.b1, self.w2, self.b2 = (np.zeros_like(x) for x in w.arrays)
        self.seen = np.zeros(len(self.w1), bool)

    def add(self, rows: Batch, labels: np.ndarray) -> None:
        if not rows.n:
            return
        h = hidden(rows, self.w)
        p = probabilities(h, self.w)
        at = np.arange(rows.n), labels
        self.loss -= float(np.log(np.maximum(p[at], 1e-300)).sum())
        self.n += rows.n
        p[at] -= 1.0  # from here on: d loss / d scores
        self.w2 += h.T @ p
        self.b2 += p.sum(axis=0)
        back = (p @ self.w.w2.T) * (h > 0)
        self.b1 += back.sum(axis=0)
        order = np.argsort(rows.terms, kind="stable")
        for a in range(0, len(order), CELLS):
            cells = order[a:a + CELLS]
            terms = rows.terms[cells]
            begin = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]])
            self.w1[terms[begin]] += np.add.reduceat(back[rows.row_of[cells]] * rows.values[cells][:, None], begin, axis=0)
            self.seen[terms[begin]] = True

    def rest(self) -> np.ndarray:
        """All but the first layer's gradient."""
        return np.concatenate([[self.loss, self.n], self.b1, self.w2.ravel(), self.b2])

    def take_rest(self, numbers: np.ndarray) -> None:
        units, classes = self.w2.shape
        self.loss, self.n = float(numbers[0]), int(numbers[1])
        self.b1, w2, self.b2 = np.split(numbers[2:], [units, units + units * classes])
        self.w2 = w2.reshape(units, classes)

    def blocks(self):
        """(block, terms, numbers): what this task hands on."""
        terms = np.flatnonzero(self.seen)
        for part in np.split(terms, np.flatnonzero(np.diff(terms // BLOCK)) + 1):
            if len(part):
                yield int(part[0] // BLOCK), part, self.w1[part].ravel()
        yield REST, np.zeros(0, np.int64), self.rest()


_DDL = "block int, task int, terms array<bigint>, numbers array<double>"


def _rows(blocks, task: int, kind=pa.RecordBatch):
    """One Arrow row a block: memory is that of a block at a time."""
    for block, terms, numbers in blocks:
        yield kind.from_arrays(
            [pa.array([block], pa.int32()), pa.array([task], pa.int32()), pa.array([terms], pa.list_(pa.int64())),
             pa.array([numbers], pa.list_(pa.float64()))], ["block", "task", "terms", "numbers"])


def _add_up(key, table):
    """Parts of one block added up in order of their tasks."""
    block = key[0].as_py()
    table = table.sort_by("task")
    total, seen = None, np.zeros(BLOCK, bool)
    for terms, numbers in zip(table.column("terms"), table.column("numbers")):
        terms, numbers = (x.values.to_numpy(zero_copy_only=False) for x in (terms, numbers))
        if block == REST:
            total = numbers if total is None else total + numbers
            continue
        numbers, place = numbers.reshape(len(terms), -1), terms - block * BLOCK
        if total is None:
            total = np.zeros((BLOCK, numbers.shape[1]))
        total[place] += numbers
        seen[place] = True
    here = np.flatnonzero(seen)
    numbers = total if block == REST else total[here].ravel()
    return next(_rows([(block, here + max(block, 0) * BLOCK, numbers)], key[-1].as_py() if len(key) > 1 else 0, pa.Table))


def gradient(rows: DataFrame, w: Weights, tasks: int = 1) -> Gradient:
    """The summed gradient over all rows (label, indices, weights), which are
    in about ``tasks`` partitions."""
    shared = rows.sparkSession.sparkContext.broadcast(w)

    def run(batches):
        from pyspark import TaskContext

        own = Gradient(shared.value)
        for batch in batches:
            own.add(Batch(batch, "weights"), batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64))
        yield from _rows(own.blocks(), TaskContext.get().partitionId())

    parts = rows.select("label", "indices", "weights").mapInArrow(run, _DDL)
    if tasks > GROUP:  # in two steps, so that no group holds the parts of all tasks
        several = F.floor(F.col("task") / int(np.ceil(np.sqrt(tasks)))).cast("int")
        parts = parts.withColumn("several", several).groupBy("block", "several").applyInArrow(_add_up, _DDL)
    total = Gradient(w)
    units = w.w2.shape[0]
    for r in parts.groupBy("block").applyInArrow(_add_up, _DDL).toArrow().to_batches():
        for i in range(r.num_rows):
            block = r.column("block")[i].as_py()
            numbers = r.column("numbers")[i].values.to_numpy(zero_copy_only=False)
            if block == REST:
                total.take_rest(numbers)
            else:
                terms = r.column("terms")[i].values.to_numpy(zero_copy_only=False)
                total.w1[terms] = numbers.reshape(len(terms), units)
    shared.destroy()
    return total


class Adam:
    """Steps of the method of Kingma and Ba (2015)."""

    def __init__(self, arrays, rate: float, t: int = 0, mean=None, square=None):
        """``t`` steps were made; ``mean`` and ``square`` are what they left."""
        self.rate, self.t = rate, t
        self.mean = mean or [np.zeros_like(x) for x in arrays]
        self.square = square or [np.zeros_like(x) for x in arrays]

    def step(self, arrays, slopes) -> None:
        self.t += 1
        rate = self.rate * np.sqrt(1 - DECAY_SQUARE ** self.t) / (1 - DECAY ** self.t)
        for x, g, m, s in zip(arrays, slopes, self.mean, self.square):
            m *= DECAY
            m += (1 - DECAY) * g
            s *= DECAY_SQUARE
            s += (1 - DECAY_SQUARE) * g * g
            x -= rate * m / (np.sqrt(s) + EPSILON)


# ---------------------------------------------------------------------------
# A first layer that is a table of blocks
# ---------------------------------------------------------------------------

# A row is a term, so that Spark's readers never hold much at a time: a part's gradient of the
# term, or the weights that a part needs.
_PIECES = "block int, part int, term int, numbers binary"
# A row of the written table: a term's weights and Adam's means; or (without them) the block's
# share of the loss, or the sums of REST.
_BLOCKS = "block int, term int, w binary, mean binary, square binary"
_LAYER = _BLOCKS + ", numbers binary"


def _packed(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as one binary value each."""
    x = np.ascontiguousarray(x, np.float64)
    ends = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * 8)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x)])


def _matrix(column: pa.ChunkedArray, units: int) -> np.ndarray:
    """The matrix whose rows were ``_packed``."""
    parts = [np.zeros((0, units))]
    for x in column.chunks:
        if len(x):
            ends = np.frombuffer(x.buffers()[1], np.int32)[x.offset:x.offset + len(x) + 1]
            parts.append(np.frombuffer(x.buffers()[2], np.float64, (ends[-1] - ends[0]) // 8, ends[0]).reshape(-1, units))
    return np.concatenate(parts)


def _table(ddl: str, n: int, **columns) -> pa.Table:
    """``n`` rows; columns not given are null, single numbers stand in all rows."""
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    out = {}
    for name, kind in (f.split() for f in ddl.split(", ")):
        x = columns.get(name)
        out[name] = pa.repeat(pa.scalar(x, kinds[kind]), n) if x is None or isinstance(x, int) else pa.array(x, kinds[kind]) \
            if isinstance(x, np.ndarray) else x
    return pa.table(out)


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _block(blocks: pa.Table, units: int, *names):
    """The first term of a block, and the matrices of its columns in order of the terms."""
    terms = _ints(blocks, "term")
    order = np.argsort(terms)
    return (terms[order[0]] if len(terms) else 0), *(_matrix(blocks.column(x), units)[order] for x in names)


def _needs(dealt: DataFrame, size: int) -> DataFrame:
    """(block, part, term): the distinct terms of every part."""
    rows = dealt.select("part", F.explode("indices").alias("term")).distinct()
    return rows.select(F.floor(F.col("term") / size).cast("int").alias("block"), "part", "term")


def _hand_out(layer: DataFrame, needs: DataFrame, units: int) -> DataFrame:
    """The weights that every part needs (_PIECES)."""
    def run(key, blocks, parts):
        first, w = _block(blocks, units, "w")
        term = _ints(parts, "term")
        return _table(_PIECES, len(term), block=key[0].as_py(), part=_ints(parts, "part"), term=term, numbers=_packed(w[term - first]))

    return layer.select("block", "term", "w").groupBy("block").cogroup(needs.groupBy("block")).applyInArrow(run, _PIECES)


class _Part:
    """The rows of a part, their terms numbered anew, and the weights of those."""

    def __init__(self, pieces: pa.Table, rest: tuple):
        terms = _ints(pieces, "term")
        order = np.argsort(terms)
        self.terms = terms[order]
        self.weights = Weights(_matrix(pieces.column("numbers"), rest[1].shape[0])[order], *rest)

    def batches(self, rows: pa.Table):
        for batch in rows.to_batches():
            found = Batch(batch, "weights")
            found.terms = np.searchsorted(self.terms, found.terms)
            yield batch, found


def _backward(dealt: DataFrame, pieces: DataFrame, rest: tuple, size: int) -> DataFrame:
    """The gradient of every part (_PIECES)."""
    def run(key, rows, own):
        part, number = _Part(own, rest), key[0].as_py()
        g = Gradient(part.weights)
        for batch, found in part.batches(rows):
            g.add(found, batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64))
        return pa.concat_tables([
            _table(_PIECES, len(part.terms), block=part.terms // size, part=number, term=part.terms, numbers=_packed(g.w1)),
            _table(_PIECES, 1, block=REST, part=number, numbers=_packed(g.rest()[None, :]))])

    return dealt.groupBy("part").cogroup(pieces.select("part", "term", "numbers").groupBy("part")).applyInArrow(run, _PIECES)


def _stepped(layer: DataFrame, pieces: DataFrame, t: int, n: int, alpha: float, rate: float, units: int) -> DataFrame:
    """The layer after step ``t`` + 1 (_LAYER)."""
    def run(key, blocks, pieces):
        block, part = key[0].as_py(), _ints(pieces, "part")
        if block == REST:
            rest = np.stack([np.frombuffer(x, np.float64) for x in pieces.column("numbers").to_pylist()])
            return _table(_LAYER, 1, block=REST, numbers=_packed(rest[np.argsort(part)].sum(axis=0)[None, :]))
        first, w, mean, square = _block(blocks, units, "w", "mean", "square")
        term, slope = _ints(pieces, "term"), np.zeros_like(w)
        order = np.lexsort((part, term))
        if len(order):
            term = term[order]
            begin = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
            slope[term[begin] - first] = np.add.reduceat(_matrix(pieces.column("numbers"), units)[order], begin, axis=0)
        squares = np.array([[(w ** 2).sum()]])
        Adam((w,), rate, t, [mean], [square]).step((w,), [(slope + alpha * w) / n])
        return pa.concat_tables([
            _table(_LAYER, len(w), block=block, term=np.arange(first, first + len(w)), w=_packed(w), mean=_packed(mean), square=_packed(square)),
            _table(_LAYER, 1, block=block, numbers=_packed(squares))])

    return layer.groupBy("block").cogroup(pieces.groupBy("block")).applyInArrow(run, _LAYER)


def _deal(rows: DataFrame, *by) -> tuple[DataFrame, int]:
    """The rows with the number of their ``part``, written; and the number of parts.  In order
    of ``by``, if given: rows of a class share terms, so its terms are needed by fewer parts."""
    cells = rows.agg(F.sum(F.size("indices"))).first()[0] or 0
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-cells // PART))
    rows = rows.repartitionByRange(parts, *by) if by else rows.repartition(parts)
    return written(rows.withColumn("part", F.spark_partition_id()), "perceptron-rows"), parts


@dataclass
class Layer:
    """A first layer in blocks of ``size`` terms: ``rows`` = (block, term, w)."""

    rows: DataFrame
    width: int
    units: int
    size: int

    def whole(self) -> np.ndarray:
        return _matrix(self.rows.orderBy("term").select("w").toArrow().column("w"), self.units)


class PerceptronModel:
    def __init__(self, weights: Weights | None, losses=(), layer: Layer | None = None, rest: tuple = ()):
        """Of ``weights``, or of a ``layer`` and the ``rest`` (b1, w2, b2)."""
        self._weights, self.losses, self.layer, self.rest = weights, list(losses), layer, rest or weights.arrays[1:]

    @property
    def size(self) -> int:
        """Numbers of the first layer."""
        return self.layer.width * self.layer.units if self.layer else self._weights.w1.size

    @property
    def weights(self) -> Weights:
        """All weights, on the driver: for callers that have checked ``size``."""
        return Weights(self.layer.whole(), *self.rest) if self.layer else self._weights

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` to sparse rows."""
        from pyspark.sql.types import DoubleType, StructField, StructType

        ship_package(df.sparkSession)
        df = as_sparse(df)
        schema = StructType([*df.schema.fields, StructField("prediction", DoubleType())])
        if self.layer:
            return self._transform_parts(df, schema)
        shared = df.sparkSession.sparkContext.broadcast(self._weights)

        def run(batches):
            for batch in batches:
                w = shared.value
                best = probabilities(hidden(Batch(batch, "weights"), w), w).argmax(axis=1).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best)], [*batch.schema.names, "prediction"])

        return df.mapInArrow(run, schema)

    def _transform_parts(self, df: DataFrame, schema) -> DataFrame:
        """The same by parts, each with the weights of its terms."""
        layer, rest = self.layer, self.rest
        names = [f"c{i}" for i in range(len(df.columns))]  # a caller's column may be called ``part``
        given = {"indices": names[df.columns.index("indices")], "weights": names[df.columns.index("weights")]}
        dealt, _ = _deal(df.toDF(*names).withColumns({k: F.col(v) for k, v in given.items()}))
        pieces = _hand_out(layer.rows, _needs(dealt, layer.size), layer.units)

        def run(key, rows, own):
            part, best = _Part(own, rest), [np.zeros(0)]
            for _, found in part.batches(rows):
                best.append(probabilities(hidden(found, part.weights), part.weights).argmax(axis=1).astype(np.float64))
            return pa.table([*(rows.column(c) for c in names), pa.array(np.concatenate(best))], schema.names)

        return dealt.groupBy("part").cogroup(pieces.groupBy("part")).applyInArrow(run, schema)

    def save(self, path: str, spark: SparkSession) -> None:
        """One row a block of the first layer and one for the rest."""
        units, classes = self.rest[1].shape
        size, width = (self.layer.size, self.layer.width) if self.layer else (BLOCK, len(self._weights.w1))
        facts = {"units": units, "classes": classes, "size": size, "width": width}
        blocks = [(REST, np.concatenate([self.rest[0], self.rest[1].ravel(), self.rest[2]]))]
        if not self.layer:
            blocks += [(a // BLOCK, self._weights.w1[a:a + BLOCK].ravel()) for a in range(0, width, BLOCK)]
        table = pa.table({"block": pa.array([b for b, _ in blocks], pa.int32()),
                          "numbers": pa.array([x for _, x in blocks], pa.list_(pa.float64()))})
        rows = spark.createDataFrame(table)
        if self.layer:
            rows = rows.unionByName(self.layer.rows.groupBy("block").applyInArrow(_as_lists(units), "block int, numbers array<double>"))
        rows.withColumns({k: F.lit(v).cast("int") for k, v in facts.items()}).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "PerceptronModel":
        saved = spark.read.parquet(path)
        ship_package(spark)
        first = saved.where(F.col("block") == REST).first()
        units, classes = first["units"], first["classes"]
        b1, w2, b2 = np.split(np.array(first["numbers"], float), [units, units + units * classes])
        rest = b1, w2.reshape(units, classes), b2
        blocks = saved.where(F.col("block") != REST).select("block", "numbers")
        if "width" in saved.columns and first["width"] * units > SHARED:
            return cls(None, (), Layer(_as_rows(blocks, first["size"], units), first["width"], units, first["size"]), rest)
        numbers = [x.values.to_numpy(zero_copy_only=False) for x in blocks.orderBy("block").toArrow().column("numbers")]
        return cls(Weights(np.concatenate(numbers).reshape(-1, units), *rest))


def _as_lists(units: int):
    def run(key, rows):
        numbers = _block(rows, units, "w")[1].ravel()
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "numbers": pa.array([numbers], pa.list_(pa.float64()))})

    return run


def _as_rows(blocks: DataFrame, size: int, units: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block, x in zip(batch.column("block").to_pylist(), batch.column("numbers")):
                w = x.values.to_numpy(zero_copy_only=False).reshape(-1, units)
                term = np.arange(block * size, block * size + len(w))
                yield from _table("block int, term int, w binary", len(w), block=block, term=term, w=_packed(w)).to_batches()

    return blocks.mapInArrow(run, "block int, term int, w binary")


@dataclass
class Perceptron:
    num_classes: int
    num_features: int
    units: int = 100
    max_iter: int = 1000
    rate: float = 0.02
    alpha: float = 1e-4
    tol: float = 1e-4
    patience: int = 10  # steps without a loss lower by ``tol`` before training ends
    seed: int = 42
    max_weights: int = 1 << 28  # numbers of the first layer that may be broadcast (2 GB)

    def fit(self, train: DataFrame) -> PerceptronModel:
        if self.num_features * self.units > self.max_weights:
            raise ValueError(f"{self.num_features} terms x {self.units} units are more than {self.max_weights} weights: "
                             "raise min_df or max_weights, or take fewer units")
        ship_package(train.sparkSession)
        rows = as_sparse(train).select(F.col("label").cast("double").alias("label"), "indices", "weights")
        if self.num_features * self.units > SHARED:
            return self._fit_table(rows)
        parts = train.sparkSession.sparkContext.defaultParallelism
        rows = written(rows.repartition(parts), "perceptron-rows")
        w = Weights.start(self.num_features, self.units, self.num_classes, self.seed)
        adam, losses = Adam(w.arrays, self.rate), []
        for _ in range(self.max_iter):
            g = gradient(rows, w, parts)
            if not g.n:
                raise ValueError("no rows to fit")
            losses.append(self._loss(g, float((w.w1 ** 2).sum()), w.w2))
            if self._ended(losses):
                break
            adam.step(w.arrays, [(g.w1 + self.alpha * w.w1) / g.n, *self._rest_slopes(g, w.w2)])
        return PerceptronModel(w, losses)

    def _loss(self, g: Gradient, squares: float, w2: np.ndarray) -> float:
        return g.loss / g.n + self.alpha / 2 * (squares + float((w2 ** 2).sum())) / g.n

    def _rest_slopes(self, g: Gradient, w2: np.ndarray) -> list:
        return [g.b1 / g.n, (g.w2 + self.alpha * w2) / g.n, g.b2 / g.n]

    def _ended(self, losses: list) -> bool:
        """Whether ``patience`` steps one after another brought no loss lower by ``tol``."""
        best, idle = np.inf, 0
        for x in losses:
            idle = idle + 1 if x > best - self.tol else 0
            best = min(best, x)
        return idle >= self.patience

    def _fit_table(self, rows: DataFrame) -> PerceptronModel:
        """``fit`` with the first layer as a table."""
        spark, width, units, seed = rows.sparkSession, self.num_features, self.units, self.seed
        dealt, parts = _deal(rows, "label", F.xxhash64("indices", "weights"))
        n = dealt.count()
        if not n:
            raise ValueError("no rows to fit")
        size = max(1, min(BLOCK, GROUP_CELLS // (units * parts)))
        needs = written(_needs(dealt, size), "perceptron-needs")

        def start(batches):
            for batch in batches:
                for block in batch.column("block").to_pylist():
                    first, last = block * size, min(width, (block + 1) * size)
                    w = Weights.start_rows(first, last, width, units, seed)
                    zero = _packed(np.zeros_like(w))
                    yield from _table(_BLOCKS, last - first, block=block, term=np.arange(first, last), w=_packed(w), mean=zero,
                                      square=zero).to_batches()

        blocks = spark.range(-(-width // size)).select(F.col("id").cast("int").alias("block"))
        layer = blocks.mapInArrow(start, _BLOCKS)
        rest = Weights.start_rest(width, units, self.num_classes, seed)
        adam, losses = Adam(rest, self.rate), []
        paths = [scratch_path(spark, "perceptron-layer") for _ in range(2)]
        schema = None
        for t in range(self.max_iter):
            gradients = _backward(dealt, _hand_out(layer, needs, units), rest, size)
            new = _stepped(layer, gradients, t, n, self.alpha, self.rate, units)
            schema = schema or new.schema
            new.write.mode("overwrite").parquet(paths[t % 2])
            new = spark.read.schema(schema).parquet(paths[t % 2])
            sums = new.where(F.col("w").isNull()).select("block", "numbers").orderBy("block").toArrow()
            g, squares = Gradient(Weights(np.zeros((0, units)), *rest)), 0.0
            for block, x in zip(sums.column("block").to_pylist(), sums.column("numbers").to_pylist()):
                numbers = np.frombuffer(x, np.float64)
                if block == REST:
                    g.take_rest(numbers)
                else:
                    squares += float(numbers[0])
            losses.append(self._loss(g, squares, rest[1]))
            if self._ended(losses):
                break  # the weights whose loss this is are those before the step
            adam.step(rest, self._rest_slopes(g, rest[1]))
            layer = new.where(F.col("w").isNotNull()).select("block", "term", "w", "mean", "square")
        return PerceptronModel(None, losses, Layer(layer.select("block", "term", "w"), width, units, size), rest)
