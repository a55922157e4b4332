"""TF-IDF (A10, A11, T1-T6, J5, P7) in relational long form and as ML
vectors.

Long form: ``(id, term, tf)`` -> document frequency per term -> vocabulary
band -> ``idf = ln((1+n)/(1+df)) + 1`` -> ``w = tf*idf / ||tf*idf||_2``.
A document without any vocabulary term has no rows (a zero vector).

Plan shape: term frequencies are counted inside the row (by shuffle only if ids
repeat) and written once, one shuffle for document frequencies (hot terms collapse
map-side), a join with the vocabulary (broadcast if Spark measures it small, else by
shuffle with hot terms split), and one shuffle by document for the L2 norm; a
document's terms are bounded by its length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.functions.text import WORD
from lexis.operators.rows import dense_index, require_columns
from lexis.session import cut_lineage, scratch_path, written

# Vectoriser token rule: maximal runs of at least two word characters.
TERM_PATTERN = "[" + WORD + "]{2,}"


def _check_band(min_df, max_df):
    for name, v in (("min_df", min_df), ("max_df", max_df)):
        if isinstance(v, bool) or v < 0:
            raise ValueError(f"{name} must be >= 0, got {v!r}")
        if isinstance(v, float) and v > 1.0:
            raise ValueError(f"{name} as a fraction must be <= 1.0, got {v!r}")


def terms_column(text_col: str) -> Column:
    """Lower-cased word tokens of at least two characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(TERM_PATTERN), 0)


def terms(df: DataFrame, text_col: str, id_col: str, keep=()) -> DataFrame:
    """T1 in long form ``(id, keep..., term)``; ``keep`` columns (a split, a
    label) travel with the rows, so that nothing is joined back later."""
    require_columns(df, text_col, id_col, *keep)
    return df.select(id_col, *keep, F.explode(terms_column(text_col)).alias("term"))


def term_frequency(term_rows: DataFrame, id_col: str, keep=()) -> DataFrame:
    """A10: ``(id, keep..., term, tf)``."""
    return term_rows.groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def counted_terms(df: DataFrame, text_col: str, id_col: str, keep=(), unique: bool = False) -> DataFrame:
    """T1 + A10 of one row a document, written: the terms are counted inside the row,
    without a shuffle of terms.  Documents whose id (and ``keep``) repeats are added up
    by ``term_frequency``; ``unique`` says that none does."""
    require_columns(df, text_col, id_col, *keep)
    if not unique and df.groupBy(id_col, *keep).count().where("count > 1").limit(1).count():
        return written(term_frequency(terms(df, text_col, id_col, keep), id_col, keep), "terms")
    rows = df.select(id_col, *keep, F.sort_array(terms_column(text_col)).alias("_s"))
    size, none = F.size("_s"), F.array().cast("array<int>")
    begin = F.filter(F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(none), lambda i: (i == 1) | (
        F.element_at("_s", i) != F.element_at("_s", F.greatest(i - 1, F.lit(1)))))
    rows = rows.withColumn("_b", F.array_append(begin, size + 1)).withColumn("_n", F.size("_b") - 1)
    runs = F.transform(F.when(F.col("_n") > 0, F.sequence(F.lit(1), "_n")).otherwise(none), lambda i: F.struct(
        F.element_at("_s", F.element_at("_b", i)).alias("term"),
        (F.element_at("_b", i + 1) - F.element_at("_b", i)).cast("bigint").alias("tf")))
    # outer: a filter of empty lists would be pushed down and count them twice
    found = rows.select(id_col, *keep, runs.alias("_t")).select(id_col, *keep, F.inline_outer("_t"))
    return written(found.where(F.col("term").isNotNull()), "terms")


def document_frequency(tf: DataFrame) -> DataFrame:
    """``(term, df)`` over a term-frequency table (one row per doc and
    term already)."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


@dataclass
class TfidfModel:
    """Fitted vocabulary: ``vocab`` = (term, df, idf, term_index)."""

    vocab: DataFrame
    n_docs: int
    use_idf: bool = True

    @property
    def size(self) -> int:
        return self.vocab.count()


def fit(tf: DataFrame, n_docs: int, *, min_df=2e-5, max_df=0.70,
        use_idf: bool = True, index: bool = False) -> TfidfModel:
    """T2 + T3 (+ P7): vocabulary = terms with ``min_df*n <= df <= max_df*n``
    (ints are absolute counts), idf smoothed.  ``index=True`` adds the
    alphabetical ``term_index`` (distributed dense numbering)."""
    _check_band(min_df, max_df)
    lo = min_df if isinstance(min_df, int) else min_df * n_docs
    hi = max_df if isinstance(max_df, int) else max_df * n_docs
    if hi < lo:
        raise ValueError(f"empty document-frequency band: {lo} to {hi}")
    dfreq = document_frequency(tf)
    vocab = dfreq.where((F.col("df") >= F.lit(float(lo))) & (F.col("df") <= F.lit(float(hi))))
    idf = (F.log(F.lit(float(1 + n_docs)) / (F.col("df") + F.lit(1.0))) + F.lit(1.0)) if use_idf \
        else F.lit(1.0)
    vocab = vocab.select("term", "df", idf.alias("idf"))
    if index:
        vocab = dense_index(vocab, ["term"], "term_index")
    # the vocabulary is read several times (size, join, emptiness check);
    # materialise it once instead of re-aggregating the corpus each time
    vocab = cut_lineage(vocab)
    if vocab.limit(1).count() == 0:
        raise ValueError(f"no term is in {lo} to {hi} of {n_docs} documents")
    return TfidfModel(vocab=vocab, n_docs=n_docs, use_idf=use_idf)


def transform(tf: DataFrame, model: TfidfModel, id_col: str, keep=(), index: bool = False) -> DataFrame:
    """T4/T5 (+ J5): weights of ``tf`` under a fitted vocabulary; terms not
    in the vocabulary are dropped; L2-normalised per document.
    Returns ``(id, keep..., term, weight)``, with ``term_index`` on request."""
    more = ["term_index"] if index else []
    j = tf.join(model.vocab.select("term", "idf", *more), "term")
    raw = F.col("tf").cast("double") * F.col("idf")
    j = j.select(id_col, *keep, "term", *more, raw.alias("_raw"))  # what the shuffle by document carries
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(id_col)))
    return j.select(id_col, *keep, "term", *more, (F.col("_raw") / norm).alias("weight"))


def fit_transform(df: DataFrame, text_col: str, id_col: str, **kw):
    """T4: fit on ``df`` and weight the same documents.  Returns
    ``(weights, model)``."""
    tf = counted_terms(df, text_col, id_col)
    n = df.count()
    model = fit(tf, n, **kw)
    return transform(tf, model, id_col), model


# ---------------------------------------------------------------------------
# The same weights as sparse vectors
# ---------------------------------------------------------------------------

def sparse_rows(weights: DataFrame, id_col: str, keep=()) -> DataFrame:
    """(id, keep..., indices, weights): a row's terms in order of their index.
    The vocabulary stays a table; nothing limits its size."""
    rows = weights.groupBy(id_col, *keep).agg(F.sort_array(F.collect_list(F.struct("term_index", "weight"))).alias("_t"))
    return rows.select(id_col, *keep, F.col("_t.term_index").alias("indices"), F.col("_t.weight").alias("weights"))


def folded(rows: DataFrame, fold: int) -> DataFrame:
    """Sparse rows with every term folded into one of ``fold`` slots (index
    modulo fold); weights of a slot are added up.  An option for models that
    cannot take the width; it mixes unrelated terms."""
    keep = [c for c in rows.columns if c not in ("indices", "weights")]
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    parts = numbered.select("_row", *keep, F.inline_outer(F.arrays_zip("indices", "weights")))
    sums = parts.groupBy("_row", *keep, F.pmod("indices", F.lit(fold)).alias("indices")).agg(F.sum("weights").alias("weights"))
    pairs = F.sort_array(F.collect_list(F.when(F.col("indices").isNotNull(), F.struct("indices", "weights"))))
    lists = sums.groupBy("_row", *keep).agg(pairs.alias("_t"))
    return lists.select(*keep, F.col("_t.indices").alias("indices"), F.col("_t.weights").alias("weights"))


# The stored form of an ML vector: type 0 sparse, 1 dense.
VECTOR_FIELDS = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


def _as_vectors(rows: DataFrame, kept: list, value: Column, out_col: str, by=()) -> DataFrame:
    """``value`` (VECTOR_FIELDS) as a column of ML vectors, without a Python worker:
    written as a plain struct (in folders by the columns ``by``) and read under the vector type's schema."""
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType

    path = scratch_path(rows.sparkSession, "vectors")
    rows.select(*[f.name for f in kept], value.alias(out_col)).write.partitionBy(*by).parquet(path)
    return rows.sparkSession.read.schema(StructType([*kept, StructField(out_col, VectorUDT())])).parquet(path)


def vectors(rows: DataFrame, width: int, fold: int | None = None, out_col: str = "features") -> DataFrame:
    """Sparse ML vectors of sparse rows: of full ``width``, or ``folded``."""
    if fold and fold < width:
        rows, width = folded(rows, fold), fold
    none = F.array()
    value = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(width).cast("int").alias("size"),
                     F.coalesce(F.col("indices").cast("array<int>"), none.cast("array<int>")).alias("indices"),
                     F.coalesce("weights", none.cast("array<double>")).alias("values"))
    return _as_vectors(rows, [f for f in rows.schema.fields if f.name not in ("indices", "weights", out_col)], value, out_col)


def dense_vectors(rows: DataFrame, values_col: str, out_col: str = "features", by=()) -> DataFrame:
    """Dense ML vectors from a column of number arrays; readers that filter the
    columns ``by`` read only the folders they need."""
    value = F.struct(F.lit(1).cast("tinyint").alias("type"), F.lit(None).cast("int").alias("size"),
                     F.lit(None).cast("array<int>").alias("indices"), F.col(values_col).cast("array<double>").alias("values"))
    return _as_vectors(rows, [f for f in rows.schema.fields if f.name not in (values_col, out_col)], value, out_col, by)


def as_sparse(rows: DataFrame) -> DataFrame:
    """Rows with ``indices`` and ``weights``; a ``features`` vector is taken
    apart by the way ``vectors`` made it."""
    if "indices" in rows.columns:
        return rows.withColumn("indices", F.coalesce(F.col("indices").cast("array<int>"), F.array().cast("array<int>"))) \
            .withColumn("weights", F.coalesce(F.col("weights").cast("array<double>"), F.array().cast("array<double>")))
    from pyspark.sql.types import StructField, StructType

    struct = StructType.fromDDL(f"features {VECTOR_FIELDS}").fields[0].dataType
    path = scratch_path(rows.sparkSession, "vectors")
    rows.write.parquet(path)
    fields = [StructField(f.name, struct if f.name == "features" else f.dataType) for f in rows.schema.fields]
    plain = rows.sparkSession.read.schema(StructType(fields)).parquet(path)
    v = F.col("features")
    size = F.size(v["values"])
    return plain.withColumn("indices", F.when(v["type"] == 0, v["indices"]).when(size > 0, F.sequence(F.lit(0), size - 1))
                            .otherwise(F.array().cast("array<int>"))) \
        .withColumn("weights", v["values"]).drop("features")
