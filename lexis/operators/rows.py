"""Row-level operators: dedup (W1), dense renumbering (W2), label encoding
(W3, J6).

Scale notes
-----------
* ``dedup_first`` shuffles a 32-byte digest plus the order key, never the
  documents: ``groupBy(digest).agg(min(order))`` combines map-side, so a
  text copied a billion times collapses before the shuffle.  The survivors
  are then kept with a semi join on the (unique) order key.
* ``dense_index`` never uses a global ``row_number()`` (one task): it range
  partitions, counts rows per partition and adds per-partition offsets.
* Lookups are plain joins: Spark broadcasts a side by its measured size, and
  splits hot keys of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 33 low bits of monotonically_increasing_id() hold the in-partition row number.
_LOW_BITS = (1 << 33) - 1


def require_columns(df: DataFrame, *names: str) -> None:
    """S3: raise KeyError listing the missing columns, sorted (no job)."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise KeyError(f"no such columns: {missing}")


def text_digest(c: Column) -> Column:
    """32-byte binary SHA-256 of a text (null stays null)."""
    return F.unhex(F.sha2(c, 256))


def dedup_first(df: DataFrame, text_col: str, order_col: str) -> DataFrame:
    """Keep the first row (smallest ``order_col``) of every distinct text.

    Nulls form one group, like pandas ``drop_duplicates``; null and '' are
    different groups.  ``order_col`` must be unique."""
    require_columns(df, text_col, order_col)
    keep = (
        df.groupBy(text_digest(F.col(text_col)).alias("_digest"))
        .agg(F.min(order_col).alias(order_col))
        .select(order_col)
    )
    return df.join(keep, on=order_col, how="left_semi")


def dense_index(df: DataFrame, order_cols: list, name: str = "row_id",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0..n-1 in ``order_cols`` order, without pulling all
    rows into one task.

    The frame is range partitioned and sorted, each row gets its
    in-partition position from ``monotonically_increasing_id()``, and a
    (partitions-sized) offset table adds the rows of earlier partitions.
    The numbered frame is checkpointed so that recomputation after an
    executor loss cannot renumber rows.  ``order_cols`` must be unique
    (add the id as a last key): ties would pile one key into one range
    partition and make the numbering of tied rows arbitrary."""
    from lexis.session import cut_lineage

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    tagged = ranged.select(
        "*",
        F.spark_partition_id().alias("_pid"),
        (F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))).alias("_pos"),
    )
    tagged = cut_lineage(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a bounded table, safe to order in one task
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"),
    ).fillna(0, subset=["_off"])
    out = tagged.join(F.broadcast(offsets), "_pid").withColumn(
        name, (F.col("_off") + F.col("_pos")).cast("bigint")
    )
    return out.drop("_pid", "_pos", "_off")


def label_dimension(df: DataFrame, label_col: str, id_col: str = "label_id") -> tuple[DataFrame, list]:
    """Sorted distinct labels with their codes 0..K-1 (alphabetical,
    like a label encoder).  Returns ``(dimension DataFrame, labels)``.

    The classes of a classifier are its output and reach the driver with any
    model; Spark decides by their size whether the join broadcasts them."""
    require_columns(df, label_col)
    values = [r[0] for r in df.select(label_col).distinct().collect()]
    if any(v is None for v in values):
        raise ValueError(f"label column {label_col!r} contains nulls")
    labels = sorted(values)
    spark = df.sparkSession
    field = df.schema[label_col]
    dim = spark.createDataFrame(
        [(v, i) for i, v in enumerate(labels)],
        f"`{label_col}` {field.dataType.simpleString()}, `{id_col}` int",
    )
    return dim, labels


def encode_labels(df: DataFrame, label_col: str, id_col: str = "label_id") -> tuple[DataFrame, list]:
    """W3 + J6: add the integer code of ``label_col``; returns the frame and
    the class names ordered by code."""
    dim, labels = label_dimension(df, label_col, id_col)
    return df.join(dim, on=label_col, how="left"), labels


def decode_labels(df: DataFrame, labels: list, id_col: str = "prediction",
                  out_col: str = "predicted_label") -> DataFrame:
    """J6 (decode): integer code -> class name via a broadcast lookup of the
    (bounded, already collected) class list."""
    spark = df.sparkSession
    dim = spark.createDataFrame(
        [(i, v) for i, v in enumerate(labels)], f"`_code` int, `{out_col}` string"
    )
    return df.join(dim, F.col(id_col).cast("int") == F.col("_code"), "left").drop("_code")
