"""Fixed-length sequence encoding (Q1) and batched model scoring (Q2, Q3).

Q1 is word level: the vocabulary is the corpus' words by frequency
(descending, ties alphabetical); ids 0 = begin, 1 = pad, 2 = end,
3 = unknown, words from 4.  Each text is truncated to ``max_length - 2``
words, wrapped in begin/end and padded to exactly ``max_length``; the
attention mask is 1 for real positions.

A vocabulary of at most BROADCAST_WORDS words is broadcast and the first
``max_length - 2`` tokens of a text are looked up in its row, without a shuffle;
a larger one is joined by shuffle and the tokens are grouped again, in groups
bounded by ``max_length``.  Both give the same rows; ids may be null or repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lexis.functions.text import whitespace_tokens
from lexis.operators.rows import dense_index, require_columns
from lexis.session import cut_lineage, ship_package

BROADCAST_WORDS = 1 << 20
BEGIN, PAD, END, UNKNOWN, FIRST_WORD = 0, 1, 2, 3, 4


def positioned_tokens(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``(id, pos, token)`` with ``pos`` = index among non-empty tokens."""
    require_columns(df, text_col, id_col)
    return df.select(F.col(id_col), F.posexplode(whitespace_tokens(
        F.coalesce(F.col(text_col), F.lit("")))).alias("pos", "token"))


def build_vocabulary(tokens: DataFrame, vocab_size: int | None = None) -> DataFrame:
    """``(token, token_id)``: frequency-descending, ties alphabetical, ids
    from 4.  ``vocab_size`` keeps only the most frequent words (the rest
    encode as unknown); None keeps all."""
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_n"))
    ranked = dense_index(counts, [F.desc("_n"), F.asc("token")], "_rank")
    if vocab_size is not None:
        ranked = ranked.where(F.col("_rank") < vocab_size)
    return ranked.select("token", (F.col("_rank") + FIRST_WORD).cast("int").alias("token_id"))


def _ids_in_rows(rows: DataFrame, vocab: pa.Table) -> DataFrame:
    """``_tokens`` replaced by ``_ids``, looked up in the broadcast vocabulary."""
    ship_package(rows.sparkSession)
    words = vocab.column("token").combine_chunks()
    shared = rows.sparkSession.sparkContext.broadcast((words, vocab.column("token_id").to_numpy().astype(np.int32)))
    kept = [f for f in rows.schema.fields if f.name != "_tokens"]

    def run(batches):
        words, numbers = shared.value
        numbers = np.append(numbers, np.int32(UNKNOWN))
        for batch in batches:
            lists = batch.column("_tokens")
            at = pc.index_in(lists.flatten(), value_set=words).fill_null(len(words)).to_numpy()
            offsets = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(numbers[at]))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), ids], [*(f.name for f in kept), "_ids"])

    return rows.mapInArrow(run, StructType([*kept, StructField("_ids", ArrayType(IntegerType()))]))


def _ids_by_join(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """The same by a join on the words; rows are told apart by a number of
    their own."""
    rows = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()))
    ids = rows.select("_row", F.posexplode("_tokens").alias("pos", "token")).join(vocab, "token", "left").select(
        "_row", "pos", F.coalesce(F.col("token_id"), F.lit(UNKNOWN)).alias("wid"))
    grouped = ids.groupBy("_row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "wid"))), lambda x: x["wid"]).alias("_ids"))
    return rows.drop("_tokens").join(grouped, "_row", "left").drop("_row")


def encode_sequences(df: DataFrame, text_col: str, id_col: str, vocab: DataFrame,
                     max_length: int = 128, keep=()) -> DataFrame:
    """Q1: add ``input_ids`` and ``attention_mask`` (array<int>, length
    ``max_length``); drops the text (P2), keeps ``id_col`` and ``keep``."""
    if max_length < 2:
        raise ValueError("max_length must be >= 2")
    require_columns(df, text_col, id_col, *keep)
    tokens = F.slice(whitespace_tokens(F.coalesce(F.col(text_col), F.lit(""))), 1, max_length - 2)
    rows = df.select(id_col, *keep, tokens.alias("_tokens"))
    small = vocab.select("token", "token_id").limit(BROADCAST_WORDS + 1).toArrow()
    rows = _ids_in_rows(rows, small) if small.num_rows <= BROADCAST_WORDS else _ids_by_join(rows, vocab)
    seq = F.concat(F.array(F.lit(BEGIN)), F.coalesce(F.col("_ids"), F.array().cast("array<int>")),
                   F.array(F.lit(END)))
    n = F.size(seq)
    pad = F.lit(max_length) - n
    return rows.select(
        id_col, *keep,
        F.concat(seq, F.array_repeat(F.lit(PAD), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
    )


def batch_predict(df: DataFrame, input_col: str, make_predict_fn, input_dim: int,
                  batch_size: int = 256, out_col: str = "scores") -> DataFrame:
    """Q2/Q3: batched inference with ``predict_batch_udf`` (the model is
    built once per Python worker by ``make_predict_fn``, rows arrive as
    Arrow batches of ``batch_size``)."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType

    from lexis.session import ship_package

    ship_package(df.sparkSession)
    udf = predict_batch_udf(make_predict_fn, return_type=ArrayType(FloatType()),
                            batch_size=batch_size, input_tensor_shapes=[[input_dim]])
    return df.withColumn(out_col, udf(F.col(input_col)))


def centroid_scorer(df: DataFrame, vec_col: str, label_col: str, num_classes: int):
    """A linear scorer fitted by Spark: per-class mean vectors (K x D,
    aggregated distributedly, bounded by K and D) -> ``make_predict_fn``
    returning dot-product scores."""
    import numpy as np

    means = (df.select(label_col, F.posexplode(vec_col).alias("d", "x"))
             .groupBy(label_col, "d").agg(F.avg("x").alias("m")).collect())
    dims = max(r["d"] for r in means) + 1
    w = np.zeros((dims, num_classes), dtype=np.float32)
    for r in means:
        w[r["d"], int(r[label_col])] = r["m"]

    def make_predict_fn():
        weights = w

        def predict(x):
            return (np.asarray(x, dtype=np.float32) @ weights).astype(np.float32)

        return predict

    return make_predict_fn, dims
