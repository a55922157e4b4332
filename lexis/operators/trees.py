"""Trees on sparse rows of any width (C1, C3, C4) and the growth that boosting shares.

Spark ML's trees take dense statistics per node, term and bin; with a whole vocabulary
as features nearly all of them are zero.  Here a pass over the rows emits sums only for
the (node, term, bin) cells that a non-zero weight falls into, Spark adds them up by cell,
and what a node's rows without the term contribute is the node's total minus the sums of
the term.  So the cost of a pass follows the number of non-zero weights and not the width.

Plan of a pass: rows (dealt out once by row number, reliably checkpointed) -> Arrow kernel
that routes rows to open nodes -> sums by cell -> Arrow kernel that keeps the best split of each
node -> aggregate by node.  The driver sees one split per open node, never cells.  What a row needs between
passes (its node per tree, its scores) is held by the driver up to MAX_HELD rows x trees (``Held``, if nodes look at
all terms); beyond that it is a narrow table, dealt out like the rows.

How the sums come about follows from what is smaller.  If nodes look at all terms, nearly every weight
is a cell of its own: weights, packed and cut by term into parts once (``dealt_by_term``), meet each row's node
and statistics, and a part has its sums whole.  If nodes look at a small class of terms, cells are few: they
are summed in the rows' partitions and travel, many packed in a row.

Weights are put into at most ``bins`` bins per term: exactly between any two values of a
term with few of them, else by quantiles.  Ties go to the smaller term and then the
smaller cut.  A weight must not be negative; a term that a row lacks weighs 0.
"""

from __future__ import annotations

import math
import weakref
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.operators.tfidf import as_sparse
from lexis.session import cut_lineage, ship_package

FLUSH = 1 << 21  # cells a kernel holds before it hands them over
PART_WEIGHTS = 1 << 18  # non-zero weights that make a partition of their own
MOST_WEIGHTS = 1 << 22  # non-zero weights of a partition at most, beyond Spark's number of partitions
MAX_HELD = 1 << 21  # rows x trees whose nodes and statistics the driver holds and broadcasts
RETRIES = 3  # further classes of terms that a node without a split looks into


# ---------------------------------------------------------------------------
# rows with binned weights
# ---------------------------------------------------------------------------

@dataclass
class Binned:
    """``rows``: (row, label, terms, bins, block), dealt out by row into blocks; ``cuts``: (term,
    cuts), where bin b holds the weights above cut b - 1 up to cut b."""

    rows: DataFrame
    cuts: DataFrame
    bins: int
    parts: int
    made: dict = field(default_factory=dict)

    def by_term(self) -> DataFrame:
        """The weights dealt out by term, made when first asked for."""
        if "by_term" not in self.made:
            self.made["by_term"] = dealt_by_term(self)
        return self.made["by_term"]

    def held(self, trees: int):
        """The rows with their state on the driver, or None if rows x trees are more than MAX_HELD."""
        if "n" not in self.made:
            self.made["n"] = self.rows.count()
        if not 0 < self.made["n"] * trees <= MAX_HELD:
            return None
        if "held" not in self.made:
            self.made["held"] = Held(self)
        return self.made["held"]


def cut_points(entries: DataFrame, bins: int) -> DataFrame:
    """(term, cuts) of (term, weight) rows without zeros.  A term with fewer
    values than bins gets all midpoints, others quantiles."""
    places = [i / (bins - 1) for i in range(1, bins - 1)]
    facts = cut_lineage(entries.groupBy("term").agg(F.min("weight").alias("least"), F.count(F.lit(1)).alias("n")))
    # a term in fewer rows than bins has fewer values than bins
    many = cut_lineage(entries.join(facts.where(F.col("n") >= bins).select("term"), "term").groupBy("term").agg(
        F.approx_count_distinct("weight").alias("values"),
        F.percentile_approx("weight", F.array(*[F.lit(p) for p in places]), F.lit(100 * bins)).alias("quantiles")))
    facts = facts.join(many, "term", "left")
    # the estimate of the number of values is off by a few hundredths; sets stay bounded
    few = facts.where((F.col("n") < bins) | (F.col("values") <= 2 * bins)).select("term")
    sets = entries.join(few, "term").groupBy("term").agg(F.sort_array(F.collect_set("weight")).alias("set"))
    midpoints = F.transform(F.sequence(F.lit(1), F.size("set")), lambda i: (
        F.element_at("set", i) + F.when(i > 1, F.element_at("set", F.greatest(i - 1, F.lit(1)))).otherwise(0.0)) / 2)
    return facts.join(sets, "term", "left").select(
        "term", "least", F.when(F.size("set") < bins, midpoints).otherwise(
            F.array_distinct(F.concat(F.array(F.col("least") / 2), "quantiles"))).alias("cuts"))


def bin_of(cuts, weight, bins: int):
    """How many of the ascending ``cuts`` (fewer than ``bins``) are below ``weight``: long
    lists by halving."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bins.bit_length()))])

    def further(low, step):
        fits = low + step <= F.size(cuts)
        return F.when(fits & (F.element_at(cuts, F.when(fits, low + step).otherwise(1)) < weight), low + step).otherwise(low)

    return F.when(F.size(cuts) < 12, F.size(F.filter(cuts, lambda c: c < weight))).otherwise(F.aggregate(steps, F.lit(0), further))


# Rows that were binned, by the DataFrame they came from: models of a suite share them.
_MADE: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def binned(train: DataFrame, bins: int = 32, least_rows: int = 1) -> Binned:
    """Bins the sparse rows (label, indices, weights).  Terms in fewer than
    ``least_rows`` rows, which no split can use, are left out.  The same DataFrame is binned
    once for the same arguments."""
    made = _MADE.setdefault(train, {})
    key = (bins, least_rows, PART_WEIGHTS, MOST_WEIGHTS)
    if key not in made:
        made[key] = _binned(train, bins, least_rows)
    return made[key]


def _binned(train: DataFrame, bins: int, least_rows: int) -> Binned:
    base = cut_lineage(as_sparse(train).select(
        F.monotonically_increasing_id().alias("row"), F.col("label").cast("int").alias("label"), "indices", "weights"))
    held = base.agg(F.sum(F.size("indices"))).first()[0] or 0
    # a pass is many short tasks on few rows: no more of them
    # than there is work for, and so many that none holds more than MOST_WEIGHTS
    parts = min(max(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + held // MOST_WEIGHTS),
                1 + held // PART_WEIGHTS)
    entries = base.select("row", F.inline(F.arrays_zip("indices", "weights"))).toDF("row", "term", "weight") \
        .where("weight <> 0")
    if least_rows > 1:
        entries = entries.join(entries.groupBy("term").count().where(F.col("count") >= least_rows).select("term"), "term")
    cuts = cut_lineage(cut_points(entries, bins))
    if cuts.where("least < 0").limit(1).count():
        raise ValueError("trees take weights that are not negative")
    cells = entries.join(cuts.select("term", "cuts"), "term").select(
        "row", F.struct("term", bin_of(F.col("cuts"), F.col("weight"), bins).cast("smallint").alias("bin")).alias("cell"))
    lists = cells.groupBy("row").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    rows = base.select("row", "label").join(lists, "row", "left").select(
        "row", "label", F.coalesce(F.col("cells.term"), F.array().cast("array<int>")).alias("terms"),
        F.coalesce(F.col("cells.bin"), F.array().cast("array<smallint>")).alias("bins"))
    rows = rows.repartition(parts, "row").withColumn("block", F.spark_partition_id())
    return Binned(cut_lineage(rows), cuts.select("term", "cuts"), bins, parts)


# ---------------------------------------------------------------------------
# trees while they grow
# ---------------------------------------------------------------------------

@dataclass
class Nodes:
    """Growing trees on the driver: one entry per node of all trees."""

    tree: list = field(default_factory=list)
    depth: list = field(default_factory=list)
    total: list = field(default_factory=list)  # statistics; None until a root's first pass
    term: list = field(default_factory=list)  # of the split, -1: a leaf
    cut: list = field(default_factory=list)  # bins up to here go left
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    best: list = field(default_factory=list)  # (gain, term, cut, left statistics), None: no split, "new": not looked for

    def add(self, tree: int, depth: int, total=None) -> int:
        for name, value in (("tree", tree), ("depth", depth), ("total", total), ("term", -1), ("cut", -1),
                            ("left", -1), ("right", -1), ("best", "new")):
            getattr(self, name).append(value)
        return len(self.tree) - 1

    def split(self, node: int) -> tuple[int, int]:
        """Carries out the best split; returns the children."""
        _, self.term[node], self.cut[node], left = self.best[node]
        self.left[node] = self.add(self.tree[node], self.depth[node] + 1, left)
        self.right[node] = self.add(self.tree[node], self.depth[node] + 1, self.total[node] - left)
        return self.left[node], self.right[node]

    def arrays(self) -> dict:
        return {k: np.array(getattr(self, k), np.int64) for k in ("tree", "term", "cut", "left", "right")}


def _stir(h, *parts) -> np.ndarray:
    """A hash state ``h`` after more integers (arrays broadcast)."""
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = h ^ (h >> np.uint64(31))
            h = h * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(29))
    return h


def _mix(*parts, h=np.uint64(0x9E3779B97F4A7C15)) -> np.ndarray:
    """Pseudo-random 63-bit numbers from integers (arrays broadcast)."""
    return (_stir(h, *parts) >> np.uint64(1)).astype(np.int64)


def poisson_copies(rows: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """How often each row is in each tree's bootstrap sample (mean 1); depends
    on the row's number alone, so every pass sees the same."""
    cdf = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    u = _mix(rows[:, None], np.arange(trees)[None, :], seed) / float(1 << 63)
    return np.searchsorted(cdf, u).astype(np.float64)


class Batch:
    """The sparse rows of an Arrow batch."""

    def __init__(self, batch, values: str = "bins"):
        lists = batch.column("terms" if values == "bins" else "indices")
        self.n = batch.num_rows
        size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        self.row_of = np.repeat(np.arange(self.n), size)
        self.terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.values = batch.column(values).flatten().to_numpy(zero_copy_only=False)
        self.width = int(self.terms.max()) + 2 if len(self.terms) else 1
        self.keys = self.row_of * self.width + self.terms  # ascending: rows in order, terms sorted

    def value(self, rows: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """The value of each (row, term), 0 where the row lacks it."""
        if not len(self.keys):
            return np.zeros(len(rows), self.values.dtype)
        want = rows * self.width + np.minimum(terms, self.width - 1)
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.values[at], 0)

    def route(self, at: np.ndarray, term, cut, left, right) -> np.ndarray:
        """Moves every row of ``at`` (rows x trees, node numbers) down to a node without
        children."""
        at = at.copy()
        rows, cols = np.nonzero(left[at] >= 0)
        while len(rows):
            node = at[rows, cols]
            new = np.where(self.value(rows, term[node]) > cut[node], right[node], left[node])
            at[rows, cols] = new
            go = left[new] >= 0
            rows, cols = rows[go], cols[go]
        return at


def _add_up(keys: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``stats`` (rows x statistics) over equal keys, keys ascending."""
    if not len(keys):
        return keys, stats
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begin], np.add.reduceat(stats[order], begin, axis=0)


@dataclass
class Subset:
    """Which terms a node may split on: terms are dealt into ``groups`` classes
    anew in every pass, and a node takes one class (1: all terms)."""

    groups: int = 1
    turn: int = 0
    seed: int = 0

    def of_terms(self, terms):
        return _mix(terms, self.turn, self.seed) % self.groups

    def of_nodes(self, nodes):
        return _mix(nodes, self.turn, self.seed + 1) % self.groups


class ByClass:
    """The weights of a batch ordered by row and class of term, so that a tree takes the
    weights of its nodes' classes without a look at the others."""

    def __init__(self, sparse: Batch, subset: Subset):
        self.subset = subset
        keys = sparse.row_of * subset.groups + subset.of_terms(sparse.terms)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def weights(self, node: np.ndarray, use: np.ndarray) -> np.ndarray:
        """Places, ascending, of the weights that the rows in ``use`` offer their nodes."""
        rows = np.flatnonzero(use)
        want = rows * self.subset.groups + self.subset.of_nodes(node[rows])
        first = np.searchsorted(self.keys, want)
        size = np.searchsorted(self.keys, want, side="right") - first
        return np.sort(self.order[np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())])


# Cells on their way to their part: one row for many cells, whose numbers are packed as bytes.
CELLS = "part int, node binary, term binary, bin binary, stats binary"
_KINDS = (np.int32, np.int32, np.int32, np.float64)


def packed(parts, pieces) -> pa.RecordBatch:
    """A row of CELLS for each part and its (node, term, bin, stats)."""
    columns = [pa.array([np.ascontiguousarray(x[i], kind).tobytes() for x in pieces], pa.binary())
               for i, kind in enumerate(_KINDS)]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *columns], ["part", "node", "term", "bin", "stats"])


def unpacked(batches, n_stats: int):
    """(node, term, bin, stats) of each part in rows of CELLS."""
    of_part: dict = {}
    for batch in batches:
        part, *columns = batch.columns
        for i, p in enumerate(part.to_pylist()):
            of_part.setdefault(p, []).append([np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(columns, _KINDS)])
    for p in sorted(of_part):
        node, term, bin_, stats = (np.concatenate(x) for x in zip(*of_part.pop(p)))
        yield *(x.astype(np.int64) for x in (node, term, bin_)), stats.reshape(-1, n_stats)


def sum_cells(data: Binned, look, nodes: Nodes, open_nodes: list, n_stats: int, subset: Subset):
    """Kernel of a pass, and its schema: the cells (node, term, bin, stats) of the open nodes, packed by part.
    ``look(batch, sparse, arrays)`` gives each row's node in every tree and its statistics there (rows x
    trees x n_stats).  The totals of nodes that have none yet are rows with term -1 in every part."""
    arrays, parts, bins = nodes.arrays(), data.parts, data.bins
    is_open = np.zeros(len(nodes.tree), bool)
    is_open[open_nodes] = True
    fresh = [i for i in open_nodes if nodes.total[i] is None]

    def out(keys, stats, width):
        node, rest = np.divmod(keys, width * bins)
        term, bin_ = np.divmod(rest, bins)
        part = _mix(node, term) % parts
        order = np.argsort(part.astype(np.int16 if parts < 1 << 15 else np.int64), kind="stable")
        begin = np.searchsorted(part[order], np.arange(parts + 1))
        pieces = [(p, order[begin[p]:begin[p + 1]]) for p in range(parts) if begin[p] < begin[p + 1]]
        return packed([p for p, _ in pieces], [(node[x], term[x], bin_[x], stats[x]) for _, x in pieces])

    def run(batches):
        totals = np.zeros((len(fresh), n_stats))
        for batch in batches:
            sparse = Batch(batch)
            at, stats = look(batch, sparse, arrays)
            for i, f in enumerate(fresh):
                totals[i] += stats[at[:, arrays["tree"][f]] == f, arrays["tree"][f]].sum(axis=0)
            by_class = ByClass(sparse, subset) if subset.groups > 1 else None
            # cells of the batch, numbered; a node's sums are then plain counts by cell
            cells, cell_of = np.unique(sparse.terms * bins + sparse.values, return_inverse=True)
            keys, sums, held = [], [], 0
            for t in range(at.shape[1]):
                node = at[:, t]
                use = is_open[node] & (stats[:, t] != 0).any(axis=1)
                if not use.any():
                    continue
                pick = np.flatnonzero(use[sparse.row_of]) if by_class is None else by_class.weights(node, use)
                row = sparse.row_of[pick]
                here, place = np.unique(node[use], return_inverse=True)
                of_row = np.zeros(len(node), np.int64)
                of_row[use] = place
                if len(here) * len(cells) <= (max(FLUSH, 8 * len(pick)) if by_class is None else 8 * len(pick)):
                    at_cell = of_row[row] * len(cells) + cell_of[pick]
                    found = np.flatnonzero(np.bincount(at_cell, minlength=1))
                    added = np.stack([np.bincount(at_cell, stats[row, t, i])[found] for i in range(n_stats)], axis=1) \
                        if len(found) else np.zeros((0, n_stats))
                    n, c = np.divmod(found, len(cells) or 1)
                    keys.append(here[n] * sparse.width * bins + cells[c])
                    sums.append(added)
                else:
                    k, added = _add_up(node[row] * sparse.width * bins + cells[cell_of[pick]], stats[row, t])
                    keys.append(k)
                    sums.append(added)
                held += len(keys[-1])
                if held >= FLUSH:
                    yield out(np.concatenate(keys), np.concatenate(sums), sparse.width)
                    keys, sums, held = [], [], 0
            if held:
                yield out(np.concatenate(keys), np.concatenate(sums), sparse.width)
        if fresh:
            head = np.array(fresh), np.full(len(fresh), -1), np.zeros(len(fresh)), totals
            yield packed(range(parts), [head] * parts)

    return run, CELLS


# What a pass needs of a block of rows, ``n`` of them.  Kind 1: the weights of a part's terms as term, bin
# and the row's place in its block, in order of term and bin.  Kind 0: the node and the statistics of every row
# in every tree, by place; the last column is empty.
PIECES = "part int, block int, kind int, n int, first binary, second binary, third binary"


def dealt_by_term(data: Binned) -> DataFrame:
    """PIECES of kind 1: one for each part and block."""
    parts = data.parts

    def run(batches):
        blocks: dict = {}
        for batch in batches:
            sparse = Batch(batch)
            block = batch.column("block").to_numpy()
            for b in np.unique(block).tolist():
                mine = block[sparse.row_of] == b
                blocks.setdefault(b, []).append((batch.column("row").to_numpy()[block == b], batch.column("row").to_numpy()[
                    sparse.row_of[mine]], sparse.terms[mine].astype(np.int32), sparse.values[mine]))
        for b in sorted(blocks):
            numbers, row, term, bin_ = (np.concatenate(x) for x in zip(*blocks.pop(b)))
            numbers = np.sort(numbers)
            part = _mix(term) % parts
            order = np.lexsort((row, bin_, term, part))
            begin = np.searchsorted(part[order], np.arange(parts + 1))
            row = np.searchsorted(numbers, row).astype(np.int32)
            for p in range(parts):
                x = order[begin[p]:begin[p + 1]]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([v], pa.int32()) for v in (p, b, 1, len(numbers))), *(pa.array([np.ascontiguousarray(v[x], kind).tobytes()], pa.binary())
                       for v, kind in ((term, np.int32), (bin_, np.int16), (row, np.int32)))],
                    ["part", "block", "kind", "n", "first", "second", "third"])

    return cut_lineage(data.rows.mapInArrow(run, PIECES))


def row_facts(look, nodes: Nodes, open_nodes: list):
    """Kernel over the rows, and its schema: PIECES of kind 0, one for each block.  Statistics at nodes that
    are not open are zero."""
    arrays = nodes.arrays()
    is_open = np.zeros(len(nodes.tree), bool)
    is_open[open_nodes] = True

    def run(batches):
        blocks: dict = {}
        for batch in batches:
            at, stats = look(batch, Batch(batch), arrays)
            stats = np.where(is_open[at][:, :, None], stats, 0.0)
            block, row = batch.column("block").to_numpy(), batch.column("row").to_numpy()
            for b in np.unique(block).tolist():
                mine = block == b
                blocks.setdefault(b, []).append((row[mine], at[mine].astype(np.int32), stats[mine]))
        for b in sorted(blocks):
            row, at, stats = (np.concatenate(x) for x in zip(*blocks.pop(b)))
            order = np.argsort(row)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([v], pa.int32()) for v in (0, b, 0, len(row))), pa.array([at[order].tobytes()], pa.binary()),
                 pa.array([stats[order].tobytes()], pa.binary()), pa.array([None], pa.binary())],
                ["part", "block", "kind", "n", "first", "second", "third"])

    return run, PIECES


def sums_of_part(data: Binned, nodes: Nodes, open_nodes: list):
    """``unpacked`` for the PIECES of a part in order of block and kind: the sums of all its cells, and the
    totals of nodes that have none yet, with term -1.  Rows' facts are held for one block at a time."""
    bins, is_open = data.bins, np.zeros(len(nodes.tree), bool)
    is_open[open_nodes] = True
    tree = np.array(nodes.tree)
    fresh = [i for i in open_nodes if nodes.total[i] is None]

    def of_block(term, bin_, place, at, stats):
        """Cells of one block; ``term`` and ``bin_`` ascend."""
        n_stats = stats.shape[2]
        key = term.astype(np.int64) * bins + bin_
        first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        cells, cell_of = key[first], np.cumsum(first) - 1
        for t in range(at.shape[1]):
            use = is_open[at[:, t]] & (stats[:, t] != 0).any(axis=1)
            pick = np.flatnonzero(use[place])
            if not len(pick):
                continue
            here, of_row = np.unique(np.where(use, at[:, t], at[use, t][0]), return_inverse=True)
            row = place[pick]
            at_cell = of_row[row] * len(cells) + cell_of[pick]
            if len(here) * len(cells) <= 8 * len(pick):
                found = np.flatnonzero(np.bincount(at_cell))
                sums = np.stack([np.bincount(at_cell, stats[row, t, i])[found] for i in range(n_stats)], axis=1)
            else:
                found, sums = _add_up(at_cell, stats[row, t])
            node, cell = np.divmod(found, len(cells))
            yield here[node], *np.divmod(cells[cell], bins), sums

    def run(batches, n_stats: int):
        found, facts = [], None
        for batch in batches:
            _, block, kind, n, *columns = batch.columns
            for i, about in enumerate(zip(block.to_pylist(), n.to_pylist())):
                if kind[i].as_py() == 0:
                    at = np.frombuffer(columns[0][i].as_buffer(), np.int32).reshape(about[1], -1)
                    stats = np.frombuffer(columns[1][i].as_buffer(), np.float64).reshape(*at.shape, n_stats)
                    facts = about
                    totals = np.array([stats[at[:, tree[f]] == f, tree[f]].sum(axis=0) for f in fresh]).reshape(-1, n_stats)
                    found.append((np.array(fresh, np.int64), np.full(len(fresh), -1), np.zeros(len(fresh), np.int64), totals))
                elif facts != about:
                    raise RuntimeError(f"weights of block and rows {about} met the rows of {facts}")
                else:
                    found += of_block(*(np.frombuffer(c[i].as_buffer(), k) for c, k in
                                        zip(columns, (np.int32, np.int16, np.int32))), at, stats)
        if found:
            yield tuple(np.concatenate(x) for x in zip(*found))

    return run


def best_of(node, term, bin_, stats, total, score):
    """Places of the best candidates, one for each node that has one, with gain, cut and left statistics of
    all.  Candidates are the cuts below each cell that is present; node, term and bin ascend."""
    begin = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (term[1:] != term[:-1])]))
    size = np.diff(np.concatenate([begin, [len(node)]]))
    # running sums pass over all terms: in doubles, their error would part equal gains
    upto = np.cumsum(stats if score.counts else stats.astype(np.longdouble), axis=0)
    upto -= stats
    before = (upto - np.repeat(upto[begin], size, axis=0)).astype(np.float64)  # cells of the term below this one
    whole = np.repeat(np.add.reduceat(stats, begin, axis=0), size, axis=0)
    left = np.maximum(total - whole, 0) + before if score.counts else total - whole + before
    cut = np.concatenate([[0], bin_[:-1]])
    cut[begin] = 0
    gain = score(left, total)
    if not score.counts:  # sums of fractions: equal gains may differ in their last digits
        digits, power = np.frexp(np.where(np.isfinite(gain), gain, -1.0))
        gain = np.where(np.isfinite(gain), np.ldexp(np.round(digits * (1 << 32)), power - 32), -np.inf)
    gain = np.where(np.isnan(gain), -np.inf, gain)
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    most = np.repeat(np.maximum.reduceat(gain, starts), np.diff(np.concatenate([starts, [len(node)]])))
    top = np.flatnonzero((gain == most) & np.isfinite(gain) & (gain > score.least_gain))
    # terms and cuts ascend, so the first of equal gains is the smallest
    first = top[np.concatenate([[True], node[top][1:] != node[top][:-1]])] if len(top) else top
    return first, gain, cut, left


def best_splits(data: Binned, nodes: Nodes, open_nodes: list, n_stats: int, score, sums=unpacked):
    """Kernel over all cells of its nodes and terms, and its schema: the best split of each
    open node that has one, and the totals of fresh ones.  ``score(left, total)`` gives
    the gain of each candidate, -inf if it isn't allowed.  ``sums`` reads the cells of the batches."""
    known = np.full((len(nodes.tree), n_stats), np.nan)
    for i in open_nodes:
        if nodes.total[i] is not None:
            known[i] = nodes.total[i]
    bins = data.bins

    def run(batches):
        for node, term, bin_, stats in sums(batches, n_stats):
            if not len(node):
                continue
            width = int(term.max()) + 2
            keys, added = _add_up((node * width + term + 1) * bins + bin_, stats)
            n, rest = np.divmod(keys, width * bins)
            t, b = np.divmod(rest, bins)
            totals = known.copy()
            head = t == 0  # written as term -1
            totals[n[head]] = added[head]
            rows = [np.stack([n[head], np.full(head.sum(), -1), np.zeros(head.sum())], axis=1).astype(np.float64)]
            gains, lefts, wholes = [np.zeros(int(head.sum()))], [np.zeros((int(head.sum()), n_stats))], [added[head]]
            n, t, b, added = n[~head], t[~head] - 1, b[~head], added[~head]
            if len(n):
                first, gain, cut, left = best_of(n, t, b, added, totals[n], score)
                rows.append(np.stack([n[first], t[first], cut[first]], axis=1).astype(np.float64))
                gains.append(gain[first])
                lefts.append(left[first])
                wholes.append(totals[n[first]])
            rows, left, whole = np.concatenate(rows), np.concatenate(lefts), np.concatenate(wholes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[:, 0].astype(np.int32)), pa.array(np.concatenate(gains)),
                 pa.array(-rows[:, 1].astype(np.int32)), pa.array(-rows[:, 2].astype(np.int32)),
                 pa.array(list(left), pa.list_(pa.float64())), pa.array(list(whole), pa.list_(pa.float64()))],
                ["node", "gain", "less_term", "less_cut", "left", "total"])

    return run, "node int, gain double, less_term int, less_cut int, left array<double>, total array<double>"


def look_for_splits(data: Binned, state, look, nodes: Nodes, open_nodes: list, n_stats: int, score,
                    subset: Subset = Subset()) -> None:
    """One pass that fills ``best`` (and a root's ``total``) of the open nodes."""
    rows = data.rows if state is None else data.rows.join(state, "row")
    cells, cell_schema = sum_cells(data, look, nodes, open_nodes, n_stats, subset)
    splits, split_schema = best_splits(data, nodes, open_nodes, n_stats, score)
    if data.parts == 1:  # all sums of all nodes are in the one task
        found = rows.mapInArrow(lambda batches: splits(cells(batches)), split_schema)
    elif subset.groups == 1:
        facts = rows.mapInArrow(*row_facts(look, nodes, open_nodes))
        facts = facts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(data.parts - 1))))
        splits, _ = best_splits(data, nodes, open_nodes, n_stats, score, sums_of_part(data, nodes, open_nodes))
        found = data.by_term().unionByName(facts).repartitionById(data.parts, "part").sortWithinPartitions("block", "kind") \
            .mapInArrow(splits, split_schema)
    else:
        found = rows.mapInArrow(cells, cell_schema).repartitionById(data.parts, "part").mapInArrow(splits, split_schema)
    if len(open_nodes) * data.parts > 4096:  # one row per node and part is small; else one per node
        found = found.groupBy("node").agg(F.max(F.struct("gain", "less_term", "less_cut", "left", "total")).alias("b")) \
            .select("node", "b.*")
    best: dict = {}
    for r in found.collect():
        rank = (r["gain"], r["less_term"], r["less_cut"])
        if r["node"] not in best or rank > best[r["node"]][0]:
            best[r["node"]] = (rank, np.array(r["left"]), np.array(r["total"]))
    for i in open_nodes:
        nodes.best[i] = None
        if i in best:
            (gain, less_term, less_cut), left, total = best[i]
            if nodes.total[i] is None:
                nodes.total[i] = total
            if less_term <= 0 and gain > score.least_gain:
                nodes.best[i] = (gain, -less_term, -less_cut, left)


# ---------------------------------------------------------------------------
# rows of few numbers: their state stays on the driver
# ---------------------------------------------------------------------------

class Held:
    """Training rows of which the driver holds the label, and while trees grow the node and the statistics.  A pass
    broadcasts these and reads the weights, packed by part of the terms, where they lie: no shuffle.  Each part
    answers with the best split of every open node, and a bit for each row and tree that says whether it goes right."""

    def __init__(self, data: Binned):
        self.bins = data.bins
        facts = data.rows.select("block", "row", "label").toArrow()
        block, row, label = (facts[c].to_numpy() for c in ("block", "row", "label"))
        order = np.lexsort((row, block))
        self.label, self.n = label[order], len(label)
        numbers = np.unique(block)
        begin = dict(zip(numbers.tolist(), np.searchsorted(block[order], numbers).tolist()))
        bins = data.bins

        def merged(batches):
            pieces = [x for b in batches for x in zip(*(b.column(c).to_pylist() for c in ("part", "block", "first", "second", "third")))]
            if not pieces:
                return
            term, bin_, place = (np.concatenate([np.frombuffer(x[i], kind) for x in pieces]) for i, kind in
                                 ((2, np.int32), (3, np.int16), (4, np.int32)))
            place = place + np.repeat([begin[x[1]] for x in pieces], [len(x[4]) // 4 for x in pieces])
            key = term.astype(np.int64) * bins + bin_
            order = np.lexsort((place, key))
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([pieces[0][0]], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (
                    key[first], first.astype(np.int32), place[order].astype(np.int32)))], ["part", "cells", "begin", "places"])

        self.parts = cut_lineage(data.by_term().repartitionById(data.parts, "part").mapInArrow(
            merged, "part int, cells binary, begin binary, places binary"))

    def search(self, at: np.ndarray, columns: list, known: np.ndarray, is_open: np.ndarray, score) -> list:
        """For each part: node, gain, term, cut, left statistics of its best splits, and the bits of the rows by
        tree.  ``columns``: the statistics, each rows x trees, or 1.0."""
        bins = self.bins
        shared = self.parts.sparkSession.sparkContext.broadcast((at, columns, known, is_open))

        def of_tree(at, columns, known, is_open, cells, begin, places):
            """Best splits of one tree's open nodes."""
            here = np.unique(at[is_open[at]])
            if not len(here) or not len(cells):
                return None
            number = np.full(len(known), -1)
            number[here] = np.arange(len(here))
            of_row = number[at]
            if len(here) == 1:
                mine = of_row == 0
                sums = [np.add.reduceat((mine * c)[places], begin) for c in columns]
                sums = np.stack(sums, axis=1)
                found = np.flatnonzero((sums != 0).any(axis=1))
                node, sums = np.zeros(len(found), np.int64), sums[found]
                cell = found
            else:
                use = of_row[places]
                pick = np.flatnonzero(use >= 0)
                cell_of = np.repeat(np.arange(len(cells)), np.diff(np.append(begin, len(places))))
                key, row = use[pick] * len(cells) + cell_of[pick], places[pick]
                if len(here) * len(cells) <= 8 * len(pick):
                    found = np.flatnonzero(np.bincount(key))
                    sums = np.stack([np.bincount(key, c[row] if isinstance(c, np.ndarray) else None)[found] for c in columns], axis=1)
                else:
                    found, sums = _add_up(key, np.stack([c[row] if isinstance(c, np.ndarray) else np.ones(len(row)) for c in columns], axis=1))
                node, cell = np.divmod(found, len(cells))
            if not len(node):
                return None
            term, bin_ = np.divmod(cells[cell], bins)
            total = known[here][node]
            first, gain, cut, left = best_of(node, term, bin_, sums.astype(np.float64), total, score)
            right = np.zeros(len(at), bool)
            for i in first:
                low, high = np.searchsorted(cells, [term[i] * bins + cut[i] + 1, (term[i] + 1) * bins])
                rows = places[begin[low]:begin[high] if high < len(begin) else len(places)] if low < len(begin) else places[:0]
                right[rows[of_row[rows] == node[i]]] = True
            return here[node[first]], gain[first], term[first], cut[first], left[first], np.packbits(right).tobytes()

        def run(batches):
            at, columns, known, is_open = shared.value
            for batch in batches:
                for _, *packed_ in zip(*(c.to_pylist() for c in batch.columns)):
                    cells, begin, places = (np.frombuffer(x, k) for x, k in zip(packed_, (np.int64, np.int32, np.int32)))
                    for t in range(at.shape[1]):
                        own = [c[:, t] if isinstance(c, np.ndarray) else c for c in columns]
                        best = of_tree(at[:, t], own, known, is_open, cells, begin, places)
                        if best is not None and len(best[0]):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([x], k) for x, k in zip((t, *(np.ascontiguousarray(b).tobytes() for b in (
                                    best[0].astype(np.int32), best[1].astype(np.float64), best[2].astype(np.int32),
                                    best[3].astype(np.int32), best[4].astype(np.float64))), best[5]), (pa.int32(), *[pa.binary()] * 6))],
                                ["tree", "node", "gain", "term", "cut", "left", "right"])

        out = self.parts.mapInArrow(run, "tree int, node binary, gain binary, term binary, cut binary, left binary, right binary").collect()
        shared.destroy()
        return out


class Growth:
    """Trees that grow on held rows: every row's node, and which rows a split sends right."""

    def __init__(self, held: Held, nodes: Nodes, roots: list, columns: list, score):
        self.held, self.nodes, self.columns, self.score = held, nodes, columns, score
        self.roots = np.array(roots, np.int32)
        self.at, self.done, self.right = np.tile(self.roots, (held.n, 1)), set(), {}

    def _move(self, at: np.ndarray, done: set) -> None:
        nodes = self.nodes
        for i in range(len(nodes.tree)):
            if nodes.left[i] >= 0 and i not in done:
                t = self.tree_of(i)
                mine = np.flatnonzero(at[:, t] == i)
                goes = np.unpackbits(self.right[i], count=self.held.n)[mine]
                at[mine, t] = np.where(goes, nodes.right[i], nodes.left[i])
                done.add(i)

    def tree_of(self, node: int) -> int:
        return self.nodes.tree[node]

    def search(self, front: list) -> None:
        """``look_for_splits``."""
        nodes = self.nodes
        self._move(self.at, self.done)
        for i in front:
            if nodes.total[i] is None:
                t = self.tree_of(i)
                mine = self.at[:, t] == i
                nodes.total[i] = np.array([float(mine.sum()) if not isinstance(c, np.ndarray) else c[mine, t].sum() for c in self.columns])
        known = np.zeros((len(nodes.tree), len(self.columns)))
        is_open = np.zeros(len(nodes.tree), bool)
        for i in front:
            known[i], is_open[i], nodes.best[i] = nodes.total[i], True, None
        ranks: dict = {}
        for r in self.held.search(self.at, self.columns, known, is_open, self.score):
            node, gain, term, cut, left = (np.frombuffer(r[c], k) for c, k in (
                ("node", np.int32), ("gain", np.float64), ("term", np.int32), ("cut", np.int32), ("left", np.float64)))
            for j, i in enumerate(node.tolist()):
                rank = (gain[j], -term[j], -cut[j])
                if i not in ranks or rank > ranks[i]:
                    ranks[i] = rank
                    nodes.best[i] = (float(gain[j]), int(term[j]), int(cut[j]), left.reshape(len(node), -1)[j].copy())
                    self.right[i] = np.frombuffer(r["right"], np.uint8)

    def leaves(self) -> np.ndarray:
        """Every row's leaf in each tree (rows x trees), by the splits that the trees have now."""
        if all(self.nodes.left[i] >= 0 for i in self.done):
            self._move(self.at, self.done)
            return self.at
        at = np.tile(self.roots, (self.held.n, 1))
        self._move(at, set())
        return at


class Gini:
    """Decrease of the Gini impurity.  Statistics are class weights; with
    ``counted`` a last one holds the number of rows, for rows of unequal weight."""

    counts = True
    least_gain = 0.0

    def __init__(self, counted: bool = False):
        self.counted = counted

    @staticmethod
    def impurity(counts, n):
        out = np.ones(len(n))
        for c in range(counts.shape[1]):
            share = counts[:, c] / n
            out -= share * share
        return out

    def __call__(self, left, total):
        right = total - left
        if self.counted:
            allowed = (left[:, -1] >= 1) & (right[:, -1] >= 1)
            left, right, total = left[:, :-1], np.maximum(right[:, :-1], 0), total[:, :-1]
        nl, nr, n = left.sum(axis=1), right.sum(axis=1), total.sum(axis=1)
        if not self.counted:
            allowed = (nl >= 1) & (nr >= 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = self.impurity(total, n) - nl / n * self.impurity(left, nl) - nr / n * self.impurity(right, nr)
        return np.where(allowed, gain, -np.inf)


# ---------------------------------------------------------------------------
# fitted trees
# ---------------------------------------------------------------------------

class TreeModel:
    """Fitted trees: per node tree, term, threshold (weights up to it go left), left, right
    and a vector of class values; a row's score is the sum of its leaves' vectors."""

    def __init__(self, tree, term, threshold, left, right, value, start=None):
        self.tree, self.term, self.left, self.right = (np.asarray(x, np.int64) for x in (tree, term, left, right))
        self.threshold, self.value = np.asarray(threshold, np.float64), np.asarray(value, np.float64)
        self.start = np.zeros(self.value.shape[1]) if start is None else np.asarray(start, np.float64)

    @property
    def roots(self) -> np.ndarray:
        """First node of every tree."""
        _, first = np.unique(self.tree, return_index=True)
        return first

    def scores(self, sparse: Batch) -> np.ndarray:
        at = np.tile(self.roots, (sparse.n, 1))
        at = sparse.route(at, self.term, self.threshold, self.left, self.right)
        out = np.tile(self.start, (sparse.n, 1))
        for t in range(at.shape[1]):
            out += self.value[at[:, t]]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` (the smallest of the best classes) to sparse rows."""
        ship_package(df.sparkSession)
        df = as_sparse(df)
        model = df.sparkSession.sparkContext.broadcast(self)

        def run(batches):
            for batch in batches:
                best = model.value.scores(Batch(batch, "weights")).argmax(axis=1).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best)], [*batch.schema.names, "prediction"])

        from pyspark.sql.types import DoubleType, StructField, StructType

        return df.mapInArrow(run, StructType([*df.schema.fields, StructField("prediction", DoubleType())]))

    def save(self, path: str, spark: SparkSession) -> None:
        rows = [(i, int(self.tree[i]), int(self.term[i]), float(self.threshold[i]), int(self.left[i]), int(self.right[i]),
                 self.value[i].tolist()) for i in range(len(self.tree))] + [(-1, -1, -1, 0.0, -1, -1, self.start.tolist())]
        spark.createDataFrame(rows, "node int, tree int, term int, threshold double, `left` int, `right` int, "
                                    "value array<double>").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "TreeModel":
        start, *rows = spark.read.parquet(path).orderBy("node").collect()
        return cls(*[[r[c] for r in rows] for c in ("tree", "term", "threshold", "left", "right", "value")], start["value"])


def thresholds(data: Binned, nodes: Nodes) -> list:
    """The weight at each node's cut, looked up for the terms in use."""
    spark = data.rows.sparkSession
    used = sorted({t for t in nodes.term if t >= 0})
    if not used:
        return [0.0] * len(nodes.term)
    cuts = dict(data.cuts.join(spark.createDataFrame([(t,) for t in used], "term int"), "term").collect())
    return [cuts[t][c] if t >= 0 else 0.0 for t, c in zip(nodes.term, nodes.cut)]


# ---------------------------------------------------------------------------
# Forest and single tree
# ---------------------------------------------------------------------------

class Forest:
    """Gini trees grown level by level, all trees together.  ``features``: "all", or "sqrt"
    for a random class of about the square root of the number of terms per node;
    ``bootstrap``: every tree sees its own Poisson sample of the rows."""

    def __init__(self, trees: int = 100, depth: int = 30, num_classes: int = 2, num_features: int | None = None,
                 features: str = "sqrt", bootstrap: bool = True, bins: int = 32, seed: int = 42):
        self.trees, self.depth, self.k, self.width = trees, depth, num_classes, num_features
        self.features, self.bootstrap, self.bins, self.seed = features, bootstrap, bins, seed

    def fit(self, train: DataFrame) -> TreeModel:
        ship_package(train.sparkSession)
        data = binned(train, self.bins)
        width = self.width or data.cuts.count()
        groups = max(1, round(math.sqrt(width))) if self.features == "sqrt" else 1
        trees, k, seed, bootstrap = self.trees, self.k, self.seed, self.bootstrap
        nodes = Nodes()
        front = [nodes.add(t, 0) for t in range(trees)]
        state = None

        def start(batch):
            if "at" in batch.schema.names:
                return batch.column("at").flatten().to_numpy(zero_copy_only=False).reshape(-1, trees).astype(np.int64)
            return np.tile(np.arange(trees), (batch.num_rows, 1))

        def look(batch, sparse, arrays):
            at = sparse.route(start(batch), arrays["term"], arrays["cut"], arrays["left"], arrays["right"])
            copies = poisson_copies(batch.column("row").to_numpy(), trees, seed) if bootstrap else np.ones(at.shape)
            stats = np.zeros((*at.shape, k))
            label = batch.column("label").to_numpy()
            stats[np.arange(len(label)), :, label] = copies
            return at, stats

        tries: dict = {}
        turn = 0
        held = data.held(trees) if groups == 1 and not bootstrap else None
        if held:
            growth = Growth(held, nodes, front, [np.repeat((held.label == c).astype(np.float64)[:, None], trees, axis=1)
                                                 for c in range(k)], Gini())
        while front and self.depth:
            if held:
                growth.search(front)
            else:
                look_for_splits(data, state, look, nodes, front, k, Gini(), Subset(groups, turn, seed))
            turn += 1
            children = [c for i in front if nodes.best[i] is not None for c in nodes.split(i)]
            # a node whose class of terms has no split looks into other classes
            again = [i for i in front if groups > 1 and nodes.best[i] is None and tries.setdefault(i, 0) < RETRIES]
            for i in again:
                tries[i] += 1
            # a child of one class only has no split
            front = [i for i in again + children if nodes.depth[i] < self.depth and np.count_nonzero(nodes.total[i] > 0.5) > 1]
            if front and children and not held:
                state = self._moved(data, state, nodes, start)
        value = np.zeros((len(nodes.tree), k))
        for i, total in enumerate(nodes.total):
            if total is not None and total.sum() > 0:
                value[i] = total / total.sum()
        return TreeModel(nodes.tree, nodes.term, thresholds(data, nodes), nodes.left, nodes.right, value)

    @staticmethod
    def _moved(data: Binned, state, nodes: Nodes, start) -> DataFrame:
        """(row, at): the node of every row in every tree, dealt out like the rows."""
        arrays = nodes.arrays()

        def run(batches):
            for batch in batches:
                at = Batch(batch).route(start(batch), arrays["term"], arrays["cut"], arrays["left"], arrays["right"])
                offsets = np.arange(0, at.size + 1, at.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(at.astype(np.int32).ravel()))], ["row", "at"])

        rows = data.rows if state is None else data.rows.join(state, "row")
        return cut_lineage(rows.mapInArrow(run, "row bigint, at array<int>").repartition(data.parts, "row"))
