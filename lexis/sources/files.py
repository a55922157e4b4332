"""File sources and sinks (S1-S4, S7) and the labelled-text loader (M3).

Schemas are always given explicitly; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lexis.operators.rows import dedup_first, dense_index, encode_labels, require_columns

# ---------------------------------------------------------------------------
# The strings a pandas CSV read turns into missing values.
# ---------------------------------------------------------------------------
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def _not_found(e: Exception, path: str) -> Exception:
    if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
        return FileNotFoundError(f"no such path: {path}")
    return e


def read_csv_table(spark: SparkSession, path: str, schema: str, *,
                   multiline: bool = True, file_order: str | None = None) -> DataFrame:
    """S1 + S2: CSV with header and RFC-4180 quoting; every string field in
    NA_STRINGS becomes null.  ``multiline=True`` allows newlines inside quoted
    fields (one task per file); for big inputs land the data as Parquet once,
    or pass ``multiline=False`` to keep files splittable.

    ``file_order`` names a unique column that orders rows as the files hold
    them: file path, start of the block, place in the task's run.  (Tasks take
    blocks by size, so the running row number alone is not file order.)"""
    try:
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", multiline)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .option("nullValue", None)
            .option("emptyValue", "")
            .csv(path)
        )
    except AnalysisException as e:
        raise _not_found(e, path) from e
    na = list(NA_STRINGS)
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.simpleString() == "string":
            c = F.when(c.isin(na), F.lit(None)).otherwise(c).alias(f.name)
        cols.append(c)
    if file_order:
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("row"))
        cols.append(place.alias(file_order))
    return df.select(*cols)


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file (header row only, no full scan)."""
    try:
        first = spark.read.text(path).limit(1).collect()
    except AnalysisException as e:
        raise _not_found(e, path) from e
    if not first:
        return []
    import csv

    return next(csv.reader([first[0][0]]))


def write_csv_table(df: DataFrame, path: str, *, single_file: bool = False) -> str:
    """CSV with header, no index.  ``single_file`` only for tiny tables
    such as a results ranking; everything else writes in parallel."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True).option("quote", '"')
        .option("escape", '"').option("emptyValue", '""').csv(path))
    return path


def load_labeled_text(df: DataFrame, text_col: str, label_col: str, *,
                      order_col: str, drop_duplicates: bool = True,
                      id_col: str = "label_id", row_id: str | None = "row_id") -> tuple[DataFrame, list]:
    """M3: column check -> dedup on text keeping the first row -> label
    codes (alphabetical) -> dense row ids 0..n-1 in ``order_col`` order.

    ``order_col`` must be unique; a CSV source gives one (``file_order``).
    Returns ``(frame, class names ordered by code)``."""
    require_columns(df, text_col, label_col, order_col)
    if drop_duplicates:
        df = dedup_first(df, text_col, order_col)
    df, labels = encode_labels(df, label_col, id_col)
    if row_id:
        df = dense_index(df, [order_col], row_id)
    return df, labels


def load_labeled_csv(spark: SparkSession, path: str, text_col: str = "Sentence",
                     label_col: str = "Sentiment", **kw) -> tuple[DataFrame, list]:
    """CSV form of M3: the header is validated first (KeyError naming the
    missing columns), the file row order becomes ``order_col``."""
    header = read_header(spark, path)
    missing = sorted({text_col, label_col} - set(header))
    if missing:
        raise KeyError(f"columns absent from the header: {missing}")
    schema = ", ".join(f"`{c}` string" for c in header)
    df = read_csv_table(spark, path, schema, multiline=kw.pop("multiline", True), file_order="_order")
    return load_labeled_text(df, text_col, label_col, order_col="_order", **kw)


def write_split_dataset(df: DataFrame, path: str, split_col: str = "split") -> str:
    """One dataset per split value, as Parquet partitions; readers
    prune partitions with ``where(split = ...)``."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    return path
