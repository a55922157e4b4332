"""Dataset profile (A1-A9): overview, per-column info, class balance and
text-length statistics.

Every section is one aggregation job over the input; pandas index values
(column name, class, statistic) become ordinary key columns.  Rounding is
half-even (``bround``), like numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.functions.text import char_count, word_count
from lexis.operators.rows import require_columns, text_digest

_FIXED_WIDTH = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4,
                "double": 8, "boolean": 1, "date": 4, "timestamp": 8}


def _is_missing(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _cell_bytes(field: T.StructField):
    c = F.col(f"`{field.name}`")
    t = field.dataType.simpleString()
    if t == "string":
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint")
    if t == "binary":
        return F.coalesce(F.length(c), F.lit(0)).cast("bigint")
    return F.lit(_FIXED_WIDTH.get(t, 8)).cast("bigint")


def dataset_overview(df: DataFrame, text_col: str) -> DataFrame:
    """A1-A4: rows, columns, duplicate_texts, total_missing, data_kb.

    duplicate_texts counts rows after the first occurrence of each text
    (nulls equal each other); the distinct count runs on a 32-byte digest.
    data_kb is the data volume (UTF-8 bytes of strings plus fixed widths),
    the Spark counterpart of an in-memory size."""
    require_columns(df, text_col)
    fields = df.schema.fields
    missing = sum((F.count_if(_is_missing(f)) for f in fields), F.lit(0)).cast("bigint")
    volume = F.sum(sum((_cell_bytes(f) for f in fields), F.lit(0).cast("bigint")))
    text = F.col(f"`{text_col}`")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(text_digest(text)).alias("_distinct"),
        F.max(text.isNull().cast("int")).alias("_has_null"),
        missing.alias("total_missing"),
        volume.alias("_bytes"),
    ).select(
        "rows",
        F.lit(len(fields)).cast("bigint").alias("columns"),
        (F.col("rows") - F.col("_distinct") - F.coalesce(F.col("_has_null"), F.lit(0)))
        .cast("bigint").alias("duplicate_texts"),
        "total_missing",
        F.bround(F.coalesce(F.col("_bytes"), F.lit(0)) / F.lit(1024.0), 1).alias("data_kb"),
    )


def _distinct_key(f) -> Column:
    """Binary key of a column's value, equal for equal values and null for null."""
    c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
    if kind == "string":
        return text_digest(c)
    if kind == "binary":
        return F.unhex(F.sha2(c, 256))
    if kind in ("float", "double"):
        c = F.when(c == 0, F.lit(0.0)).otherwise(c)  # both zeros are one value
    elif kind == "timestamp":
        c = F.unix_micros(c)  # as text, two instants of an hour that clocks repeat would be one
    elif kind.startswith(("array", "struct", "map")):
        c = F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}))
    return c.cast("string").cast("binary")


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """A5: per column: dtype (Spark type name), missing, missing_pct
    (2 dp), unique (non-null distinct values).

    Distinct values are (column, key) rows, combined before the shuffle, so that
    a row costs one key per column and a column of many repeats shuffles few
    rows; long texts are keyed by digest.  ``approx=True`` estimates them in the
    pass that counts the missing values (HyperLogLog++)."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(fields):
        aggs.append(F.count_if(_is_missing(f)).alias(f"_m{i}"))
        if approx:
            key = F.col(f"`{f.name}`")
            aggs.append(F.approx_count_distinct(text_digest(key) if f.dataType.simpleString() == "string" else key).alias(f"_u{i}"))
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(i).alias("i"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"_m{i}").cast("bigint").alias("missing"),
            (F.col(f"_u{i}") if approx else F.lit(None)).cast("bigint").alias("unique"),
        )
        for i, f in enumerate(fields)
    ])).alias("r")
    out = df.agg(*aggs).select("_n", rows).select("_n", "r.*")
    if not approx:
        keys = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _distinct_key(f).alias("key")) for i, f in enumerate(fields)]))
        distinct = df.select(keys.alias("r")).select("r.*").where(F.col("key").isNotNull()).distinct()
        counts = distinct.groupBy("i").agg(F.count(F.lit(1)).alias("_unique"))
        out = out.join(counts, "i", "left").withColumn("unique", F.coalesce("_unique", F.lit(0)).cast("bigint"))
    return out.select(
        "column", "dtype", "missing",
        F.bround(F.try_divide(F.col("missing") * F.lit(100.0), F.col("_n")), 2).alias("missing_pct"),
        "unique",
    )


def class_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """Count and percentage (2 dp) per label, count-descending then
    label; null labels are not listed but count in the denominator.

    The denominator is one scalar (a count job), never a cross join."""
    require_columns(df, label_col)
    total = df.count()
    lab = F.col(f"`{label_col}`")
    counts = df.where(lab.isNotNull()).groupBy(lab.alias(label_col)).agg(
        F.count(F.lit(1)).alias("count"))
    pct = F.bround(F.col("count") / F.lit(float(total)) * F.lit(100.0), 2) if total else F.lit(None)
    return counts.select(label_col, "count", pct.cast("double").alias("percentage")).orderBy(
        F.desc("count"), F.asc(label_col))


def text_length_profile(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """A7 + A8 (+ U1): overall mean/min/max of character and word counts and
    per-class means, 1 dp, in one pass via ROLLUP (grouping sets
    ``((label), ())``).  Keys: overall_mean, overall_min, overall_max,
    mean[<class>] (classes ascending, null class dropped)."""
    require_columns(df, text_col, label_col)
    lab = F.col(f"`{label_col}`")
    lengths = df.select(
        lab.alias("_label"),
        char_count(F.col(f"`{text_col}`")).alias("c"),
        word_count(F.col(f"`{text_col}`")).alias("w"),
    )
    g = lengths.rollup("_label").agg(
        F.grouping("_label").alias("_overall"),
        F.avg("c").alias("c_mean"), F.min("c").alias("c_min"), F.max("c").alias("c_max"),
        F.avg("w").alias("w_mean"), F.min("w").alias("w_min"), F.max("w").alias("w_max"),
    ).where((F.col("_overall") == 1) | F.col("_label").isNotNull())

    def entry(key, c, w, order):
        return F.struct(key.alias("stat"), F.bround(c.cast("double"), 1).alias("char_count"),
                        F.bround(w.cast("double"), 1).alias("word_count"),
                        F.lit(order).alias("_o"))

    overall = F.array(
        entry(F.lit("overall_mean"), F.col("c_mean"), F.col("w_mean"), 0),
        entry(F.lit("overall_min"), F.col("c_min"), F.col("w_min"), 1),
        entry(F.lit("overall_max"), F.col("c_max"), F.col("w_max"), 2),
    )
    per_class = F.array(entry(F.concat(F.lit("mean["), F.col("_label").cast("string"), F.lit("]")),
                              F.col("c_mean"), F.col("w_mean"), 3))
    out = g.select(F.col("_label"), F.explode(
        F.when(F.col("_overall") == 1, overall).otherwise(per_class)).alias("r"))
    return out.select("r.stat", "r.char_count", "r.word_count", "r._o", "_label") \
        .orderBy("_o", "_label").drop("_o", "_label")


@dataclass(frozen=True)
class DatasetSummary:
    overview: DataFrame
    dtypes: DataFrame
    class_distribution: DataFrame
    text_length: DataFrame


def summarize_dataset(df: DataFrame, text_col: str = "Sentence",
                      label_col: str = "Sentiment", approx: bool = False) -> DatasetSummary:
    """All four sections (KeyError if a column is missing)."""
    require_columns(df, text_col, label_col)
    return DatasetSummary(
        overview=dataset_overview(df, text_col),
        dtypes=column_profile(df, approx=approx),
        class_distribution=class_distribution(df, label_col),
        text_length=text_length_profile(df, text_col, label_col),
    )
