"""Merkle manifest of a dataset (operator 12).

Every row is a leaf, the SHA-256 of its fields.  The leaves of a source, ascending by
doc_id, form a tree in which FAN consecutive nodes become one; the roots of the sources,
ordered by source, form another tree of the same kind.  Per level one window over the
nodes, with fixed-offset lag and lead columns that are masked by a node's slot and by the
length of its run, gives every node its siblings; first-child rows hash the parents.
Going down again, a node's path (its siblings and those of all nodes above it) is put
together once per run and not per leaf, so that proofs are folded inside their rows.

Scale: texts are read once and only digests move.  Leaves are numbered by range
partitioning; a window partition is a block of BLOCK nodes, so the size of a source does
not matter.  Each level is written and has a sixteenth of the rows of the one below it;
the driver holds the largest number of leaves and one digest.

Defined cases: a null field counts as ``-``, an empty one as ``0:``.  Rows without a source
form the first source, rows without a doc_id come first in theirs; rows that share both
are ordered by their leaves, and equal rows are leaves of their own.  An empty table gives
no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.common import LOWER, UPPER, ascii_lower
from lexis.operators.rows import dense_index
from lexis.session import written

FAN = 16
BLOCK = 16 * FAN  # nodes of a window partition; a multiple of FAN, so that no run is cut
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before: string, after: string>>"


def field(value: Column) -> Column:
    """A value as it enters a leaf: byte count, colon, value; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """Digest of a row; ``changed`` columns replace those of the table."""
    return F.sha2(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]), 256)


def tampered() -> Column:
    """True for rows whose text is tampered with: 5 divides the checksum of
    the id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, pos, n, digest, doc_id, altered): the leaf of every row, its place
    among the n leaves of its source, and its digest after tampering.  ``tree``
    numbers the sources in their order."""
    own = docs.select(*FIELDS)
    rows = written(own.select("doc_id", "source", leaf().alias("digest"),
                              F.when(tampered(), leaf(text=ascii_lower(F.col("text")))).alias("altered")), "leaves")
    at = written(dense_index(rows, ["source", "doc_id", "digest"], "_at"), "leaves")
    trees = at.groupBy("source").agg(F.min("_at").alias("tree"), F.count(F.lit(1)).alias("n")) \
        .withColumnRenamed("source", "_source")
    return at.join(trees, F.col("source").eqNullSafe(F.col("_source"))).select(
        "tree", (F.col("_at") - F.col("tree")).alias("pos"), "n", "digest", "doc_id", "altered")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Adds ``before`` and ``after``: the digests of the other nodes of a
    node's run, from left to right."""
    slot = F.col("pos") % FAN
    length = F.least(F.lit(FAN), F.col("n") - F.col("pos") + slot)
    along = Window.partitionBy("tree", F.expr(f"pos div {BLOCK}")).orderBy("pos")
    lags = [F.when(slot >= j, F.lag("digest", j).over(along)) for j in range(FAN - 1, 0, -1)]
    leads = [F.when(slot + j < length, F.lead("digest", j).over(along)) for j in range(1, FAN)]
    return nodes.select("*", F.concat_ws("", *lags).alias("before"), F.concat_ws("", *leads).alias("after"))


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: every first child hashes its run."""
    return with_siblings(nodes.where("n > 1")).where(F.col("pos") % FAN == 0).select(
        "tree", F.expr(f"pos div {FAN}").alias("pos"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
        F.sha2(F.concat("digest", "after"), 256).alias("digest"))


def levels(nodes: DataFrame, most: int) -> list:
    """All levels of the trees, from their leaves up to single nodes; ``most``
    is the number of leaves of the largest tree."""
    found = [nodes]
    while most > 1:
        found.append(written(parents(found[-1]), "level"))
        most = -(-most // FAN)
    return found


def with_paths(found: list, tops: DataFrame, keep=()) -> DataFrame:
    """Adds ``path`` to the leaves of trees given by their ``levels``: the
    siblings (before, after) of a leaf and of every node above it.  ``tops``
    has a row (tree, path, keep...) per tree, with the path of its root."""
    below = None
    for nodes in reversed(found):
        single = nodes.where("n = 1").join(tops, "tree")
        if below is not None:
            inner = with_siblings(nodes.where("n > 1")).withColumn("_run", F.expr(f"pos div {FAN}"))
            above = below.select("tree", F.col("pos").alias("_run"), "path", *keep)
            inner = inner.join(above, ["tree", "_run"]).withColumn(
                "path", F.concat(F.array(F.struct("before", "after")), F.col("path")))
            single = single.unionByName(inner.drop("_run", "before", "after"))
        # the leaves' own level is used once and not written
        below = single if nodes is found[0] else written(single.select("tree", "pos", "path", *keep), "paths")
    return below


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot (of its source), root, proof_sha256 (digest of all
    siblings on the way to the root), folded_root (from the tampered leaf, if the row is
    one, and the original siblings) and verified (folded_root equals root)."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    nodes = written(leaves(docs), "nodes")
    most = nodes.agg(F.max("n")).first()[0]
    if most is None:
        return spark.createDataFrame([], f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                                         "folded_root string, verified boolean")
    found = levels(nodes, most)
    single = [level.where("n = 1").select("tree", "digest") for level in found]
    for more in single[1:]:
        single[0] = single[0].unionByName(more)
    ordered = written(dense_index(single[0], ["tree"], "pos"), "subroots")
    sources = ordered.count()
    upper = levels(ordered.select(F.lit(0).cast("bigint").alias("tree"), "pos", F.lit(sources).cast("bigint").alias("n"),
                                  "digest", F.col("tree").alias("_source")), sources)
    root = upper[-1].where("n = 1").first()["digest"]
    top = spark.range(1).select(F.col("id").alias("tree"), F.array().cast(PATH).alias("path"))
    tops = written(with_paths(upper, top).select(F.col("_source").alias("tree"), "path", F.col("digest").alias("subroot")), "tops")
    rows = with_paths(found, tops, keep=("subroot",))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    return rows.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root).alias("root"), F.sha2(proof, 256).alias("proof_sha256"),
        fold(F.coalesce("altered", "digest"), F.col("path")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _sql_leaf(text: str = "text") -> str:
    return f"sha256({' || '.join(_sql_field(text if c == 'text' else c) for c in FIELDS)})"


def _sql_tree(name: str, depth: int) -> str:
    """CTEs ``{name}0`` to ``{name}{depth}``: levels of trees of up to
    FAN ** depth leaves, and ``{name}p{k}``: paths of their nodes."""
    run = f"(PARTITION BY tree, pos // {FAN} ORDER BY pos ROWS BETWEEN"
    out = []
    for k in range(1, depth + 1):
        out.append(f"""{name}{k} AS (
SELECT tree, pos // {FAN} AS pos, (any_value(n) + {FAN - 1}) // {FAN} AS n, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
FROM {name}{k - 1} WHERE n > 1 GROUP BY tree, pos // {FAN})""")
    out.append(f"{name}top AS ({' UNION ALL '.join(f'SELECT tree, digest FROM {name}{k} WHERE n = 1' for k in range(depth + 1))})")
    return ",\n".join(out)


def _sql_paths(name: str, depth: int, tops: str) -> str:
    out = [f"{name}p{depth} AS (SELECT x.tree, x.pos, t.path FROM {name}{depth} x JOIN {tops} t USING (tree))"]
    for k in range(depth - 1, -1, -1):
        out.append(f"""{name}s{k} AS (
SELECT *, coalesce(string_agg(digest, '') OVER (PARTITION BY tree, pos // {FAN} ORDER BY pos
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
       coalesce(string_agg(digest, '') OVER (PARTITION BY tree, pos // {FAN} ORDER BY pos
                   ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name}{k} WHERE n > 1),
{name}p{k} AS (
SELECT s.tree, s.pos, list_concat([struct_pack(before := s.before, after := s.after)], p.path) AS path
FROM {name}s{k} s JOIN {name}p{k + 1} p ON p.tree = s.tree AND p.pos = s.pos // {FAN}
UNION ALL SELECT x.tree, x.pos, t.path FROM {name}{k} x JOIN {tops} t USING (tree) WHERE x.n = 1)""")
    return ",\n".join(out)


# crc32, bit by bit, of the decimal id
_SQL_CRC = ("xor(list_reduce(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), "
            "lambda i: CAST(ord(CAST(doc_id AS VARCHAR)[i]) AS BIGINT)), "
            "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], "
            "lambda x, z: xor(x >> 1, 3988292384 * (x & 1))), 4294967295::BIGINT), 4294967295::BIGINT)")
_SQL_FOLD = ("list_reduce(list_transform(path, lambda s: [s.before, s.after]), "
             "lambda a, s: [sha256(s[1] || a[1] || s[2]), ''], [coalesce(altered, digest), ''])[1]")
DEPTH = 6  # of the SQL form: up to 16 ** 6 rows of a source, and as many sources

ORACLE = f"""
WITH l AS (SELECT doc_id, source, {_sql_leaf()} AS digest,
                  CASE WHEN {_SQL_CRC} % 5 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS altered
           FROM documents),
t0 AS (SELECT dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree, count(*) OVER (PARTITION BY source) AS n,
              row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, digest, doc_id, altered FROM l),
{_sql_tree("t", DEPTH)},
s0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, digest, tree AS source FROM ttop),
{_sql_tree("s", DEPTH)},
none AS (SELECT 0 AS tree, CAST([] AS STRUCT(before VARCHAR, after VARCHAR)[]) AS path),
{_sql_paths("s", DEPTH, "none")},
tops AS (SELECT s0.source AS tree, s0.digest AS subroot, p.path FROM s0 JOIN sp0 p USING (tree, pos)),
{_sql_paths("t", DEPTH, "tops")},
r AS (SELECT t0.doc_id, t0.digest, t0.altered, p.path, o.subroot, (SELECT digest FROM stop) AS root
      FROM t0 JOIN tp0 p USING (tree, pos) JOIN tops o ON o.tree = t0.tree)
SELECT doc_id, digest AS leaf, subroot, root, sha256(list_reduce(list_transform(path, lambda s: s.before || s.after),
       lambda a, b: a || b, '')) AS proof_sha256, {_SQL_FOLD} AS folded_root, {_SQL_FOLD} = root AS verified FROM r
"""
