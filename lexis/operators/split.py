"""Exact, seeded, stratified splits (K1, K2) and shuffled batches.

Quotas follow the stratified-shuffle rule: ``n_test = ceil(test_size*n)``;
each class gets ``floor(n_train*c_k/n)`` training rows and the remaining
``n_train - sum`` rows go to the largest remainders (ties: lower class
first), the rest of the class is test.  Inside a class, rows are ordered by
``md5("<seed>:<salt>:<id>")``, a key both Spark and SQL engines compute, and
the first ``quota`` rows are train.

Scale: a plain ``row_number()`` over a class puts a whole class (possibly a
third of the data) in one task.  Instead rows are bucketed by the first
five hex digits of the key (at most 16^5 buckets per class); bucket counts
are aggregated (map-side combined), a per-class cumulative sum over the
bounded bucket table finds the one boundary bucket per class, every other
bucket is decided by a comparison, and only rows of the boundary buckets
(about n/16^5 per class) are ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexis.operators.rows import require_columns
from lexis.session import cut_lineage

BUCKET_DIGITS = 5


def check_test_size(test_size: float) -> None:
    if isinstance(test_size, bool) or not (0.0 < float(test_size) < 1.0):
        raise ValueError(f"test_size must be in (0, 1), got {test_size!r}")


def split_key(id_col: str, seed, salt: str = "") -> F.Column:
    prefix = f"{seed}:{salt}:" if salt else f"{seed}:"
    return F.md5(F.concat(F.lit(prefix), F.col(id_col).cast("string")))


def train_quotas(counts: dict, test_size: float) -> dict:
    """Per-class training quotas (largest remainder, exact integers)."""
    check_test_size(test_size)
    n = sum(counts.values())
    if n == 0:
        raise ValueError("cannot split an empty frame")
    small = [k for k, c in counts.items() if c < 2]
    if small:
        raise ValueError(f"classes of a single row can't be split: {sorted(small)}")
    n_test = math.ceil(float(test_size) * n)
    n_train = n - n_test
    k = len(counts)
    if n_test < k or n_train < k:
        raise ValueError(f"{k} classes need at least {k} rows on each side, got {n_train} and {n_test}")
    classes = sorted(counts)
    floors = {c: (counts[c] * n_train) // n for c in classes}
    rema = {c: (counts[c] * n_train) % n for c in classes}
    extra = n_train - sum(floors.values())
    for c in sorted(classes, key=lambda c: (-rema[c], classes.index(c)))[:extra]:
        floors[c] += 1
    return floors


def stratified_split(df: DataFrame, label_col: str, id_col: str, *, test_size: float = 0.25,
                     seed=42, salt: str = "", split_col: str = "split",
                     names=("train", "test")) -> DataFrame:
    """K1: add ``split_col`` = names[0] (train) or names[1] (test).

    Passes over ``df``: one aggregate (bucket counts, from which the class
    counts follow), then the output itself as the union of the decided rows
    and the ranked boundary rows.  Materialise an expensive input first."""
    require_columns(df, label_col, id_col)
    check_test_size(test_size)
    spark = df.sparkSession
    keyed = df.withColumn("_key", split_key(id_col, seed, salt)) \
        .withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    # (class, bucket) counts: at most K * 16^5 rows, combined map-side
    buckets = cut_lineage(keyed.groupBy(label_col, "_bucket").agg(F.count(F.lit(1)).alias("_cnt")))
    counts_rows = buckets.groupBy(label_col).agg(F.sum("_cnt").alias("n")).collect()
    counts = {r[0]: r[1] for r in counts_rows}
    if None in counts:
        raise ValueError(f"label column {label_col!r} contains nulls")
    quotas = train_quotas(counts, test_size)

    ltype = df.schema[label_col].dataType.simpleString()
    quota_df = spark.createDataFrame([(c, q) for c, q in quotas.items()],
                                     f"`{label_col}` {ltype}, _quota long")
    w = Window.partitionBy(label_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cum = buckets.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0))) \
        .join(F.broadcast(quota_df), label_col)
    # per class: the bucket where the quota boundary falls and the train rows
    # still needed inside it, or else the last bucket that is wholly train
    facts = cum.groupBy(label_col).agg(
        F.max(F.when((F.col("_before") < F.col("_quota"))
                     & (F.col("_before") + F.col("_cnt") > F.col("_quota")),
                     F.struct(F.col("_bucket"), (F.col("_quota") - F.col("_before")))))
        .alias("b"),
        F.max(F.when(F.col("_before") + F.col("_cnt") <= F.col("_quota"), F.col("_bucket")))
        .alias("_last_full"),
    ).collect()
    bdf = spark.createDataFrame(
        [(r[0], r["b"][0] if r["b"] else None, int(r["b"][1]) if r["b"] else 0, r["_last_full"])
         for r in facts],
        f"`{label_col}` {ltype}, _bb string, _rem long, _last_full string")
    keyed = keyed.join(F.broadcast(bdf), label_col, "left")
    in_boundary = F.col("_bb").isNotNull() & (F.col("_bucket") == F.col("_bb"))
    decided = keyed.where(~in_boundary).withColumn(
        "_train", F.when(F.col("_bb").isNotNull(), F.col("_bucket") < F.col("_bb"))
        .otherwise(F.col("_last_full").isNotNull() & (F.col("_bucket") <= F.col("_last_full"))))
    # rank only rows of boundary buckets (about n / 16^5 rows per class)
    edge = keyed.where(in_boundary).withColumn(
        "_train", F.row_number().over(Window.partitionBy(label_col).orderBy("_key", id_col))
        <= F.col("_rem"))
    out = decided.unionByName(edge).withColumn(
        split_col, F.when(F.col("_train"), F.lit(names[0])).otherwise(F.lit(names[1])))
    return out.drop("_key", "_bucket", "_bb", "_rem", "_last_full", "_train")


def three_way_split(df: DataFrame, label_col: str, id_col: str, *, test_size: float = 0.1,
                    validation_size: float = 0.2, seed=42, split_col: str = "split") -> DataFrame:
    """K2: test first, then validation as a fraction of the remainder."""
    first = cut_lineage(stratified_split(df, label_col, id_col, test_size=test_size, seed=seed,
                                         salt="test", split_col="_s1", names=("rest", "test")))
    rest = first.where(F.col("_s1") == "rest").drop("_s1")
    test = first.where(F.col("_s1") == "test").drop("_s1").withColumn(split_col, F.lit("test"))
    second = stratified_split(rest, label_col, id_col, test_size=validation_size, seed=seed,
                              salt="val", split_col=split_col, names=("train", "validation"))
    return second.unionByName(test)


def shuffled_batches(df: DataFrame, id_col: str, batch_size: int = 32, seed=42) -> DataFrame:
    """Seeded row shuffle (order by md5 key), then consecutive batches of
    ``batch_size`` (last one short).  Adds ``shuffle_pos`` and ``batch``."""
    from lexis.operators.rows import dense_index

    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    keyed = df.withColumn("_key", split_key(id_col, seed, "shuffle"))
    idx = dense_index(keyed, ["_key", id_col], "shuffle_pos")
    return idx.withColumn("batch", F.floor(F.col("shuffle_pos") / F.lit(batch_size)).cast("bigint")) \
        .drop("_key")
