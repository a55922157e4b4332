"""Line dedup (operator 4), with DataFrame functions only.

Long lines become (key hash, document, position) rows, are range-partitioned by
key and document and sorted by key, document (descending) and position; a
streaming pass keeps the first occurrence of a key in each document.  These
first occurrences are counted per key with map-side aggregation, so a line that
a third of all documents share arrives as one row per task.  A key found in
enough documents is kept in the largest doc_id only.  The decision goes back to
the documents as a compressed keep bitmap: 64 lines a word, and words in which
every line stays are left out.  Texts are never shuffled to decide anything.

Scale: the range partitioning includes the document, so a hot key spreads over
many tasks; the join of occurrences with the frequent keys is a plain join
whose skewed partitions Spark splits.

Defined cases: null or empty text is one empty line.  Rows without a doc_id
neither count nor lose lines.  Repeated rows of a doc_id count as one document
and are treated alike; rows that share a doc_id but not the text have bitmaps
of their own.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.common import ascii_lower, hash128
from lexis.session import written

MIN_CODE_POINTS = 40
MIN_DOCUMENTS = 5
BLANKS = " \t\n\x0b\x0c\r"
WORD_BITS = 64


def text_lines(text: Column) -> Column:
    """The lines of a text; null and '' are one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _text_id(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def occurrences(docs: DataFrame, min_code_points: int = MIN_CODE_POINTS) -> DataFrame:
    """(ka, kb, doc, text_id, pos) of every line whose key is long enough."""
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc"), _text_id(F.col("text")).alias("text_id"),
        F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
    # a key is never longer than its line: short lines go before their keys are made
    rows = rows.where(F.length("line") >= min_code_points).withColumn("key", line_key(F.col("line"))) \
        .where(F.length("key") >= min_code_points).withColumn("h", hash128(F.col("key")))
    return rows.select(F.col("h.a").alias("ka"), F.col("h.b").alias("kb"), "doc", "text_id", "pos")


def frequent_keys(occ: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(ka, kb, keeper) of the keys found in enough documents."""
    parts = int(occ.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    back = occ.select("ka", "kb", F.bitwise_not("doc").alias("back"), "pos")  # ascending = doc descending
    order = ["ka", "kb", "back", "pos"]
    ranged = back.repartitionByRange(parts, "ka", "kb", "back").sortWithinPartitions(*order)
    at = Window.partitionBy("ka", "kb", "back").orderBy("pos")
    first = ranged.withColumn("nth", F.row_number().over(at)).where("nth = 1")
    return first.groupBy("ka", "kb").agg(F.count(F.lit(1)).alias("docs"), F.min("back").alias("back")) \
        .where(F.col("docs") >= min_documents).select("ka", "kb", F.bitwise_not("back").alias("keeper"))


def keep_bitmaps(docs: DataFrame, min_code_points: int = MIN_CODE_POINTS,
                 min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Per document that loses lines: doc, text_id, n_dropped and ``keep``, an
    array of (word, mask) in which bit p of word w says whether line 64*w + p
    stays; words that are not listed keep all their lines."""
    occ = written(occurrences(docs, min_code_points), "lines")
    gone = occ.join(frequent_keys(occ, min_documents), ["ka", "kb"]).where("doc <> keeper")
    bit = F.expr(f"shiftleft(1L, pos % {WORD_BITS})")
    masks = gone.select("doc", "text_id", F.expr(f"pos div {WORD_BITS}").cast("int").alias("word"), bit.alias("bit")) \
        .groupBy("doc", "text_id", "word").agg(F.bitwise_not(F.bit_or("bit")).alias("mask"))
    return masks.groupBy("doc", "text_id").agg(
        F.sum(WORD_BITS - F.bit_count("mask")).cast("bigint").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("keep"))


def kept_text(lines: Column, keep: Column) -> Column:
    """The kept lines joined again."""
    by_word = F.map_from_entries(keep)
    last = F.expr(f"(size(_lines) - 1) div {WORD_BITS}").cast("int")
    dense = F.transform(F.sequence(F.lit(0), last), lambda w: F.coalesce(F.try_element_at(by_word, w), F.lit(-1)))
    return F.when(keep.isNull(), F.lit(None)).otherwise(dense)


def _with_kept(docs: DataFrame, columns: list, **limits) -> DataFrame:
    """``columns`` of every row plus _text, _lines, _dropped and _kept."""
    maps = keep_bitmaps(docs, **limits).select(
        F.col("doc").alias("_doc"), F.col("text_id").alias("_tid"), F.col("n_dropped").alias("_dropped"), "keep") \
        .withColumnRenamed("keep", "_keep").hint("shuffle_hash")
    rows = docs.select(*columns, F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("_text"))
    rows = rows.withColumn("_text_id", _text_id(F.col("_text")))
    both = rows.join(maps, (F.col("_id") == F.col("_doc")) & (F.col("_text_id") == F.col("_tid")), "left")
    both = both.withColumn("_lines", text_lines(F.col("_text"))) \
        .withColumn("_dense", kept_text(F.col("_lines"), F.col("_keep")))
    kept = F.expr(f"array_join(filter(_lines, (x, i) -> getbit(_dense[i div {WORD_BITS}], i % {WORD_BITS}) = 1), '\\n')")
    return both.withColumn("_kept", F.when(F.col("_keep").isNull(), F.coalesce("_text", F.lit(""))).otherwise(kept))


def line_digest(docs: DataFrame, **limits) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and the SHA-256 of the kept text."""
    return _with_kept(docs, ["doc_id"], **limits).select(
        "doc_id", F.size("_lines").cast("bigint").alias("n_lines"),
        F.coalesce("_dropped", F.lit(0)).cast("bigint").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256"))


def drop_lines(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with the kept text (n_chars follows); rows that lose no line
    are unchanged."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    out = _with_kept(docs, [F.col(c) for c in others] + [F.col("n_chars").alias("_chars")], **limits)
    touched = F.col("_dropped").isNotNull()
    text = F.when(touched, F.col("_kept")).otherwise(F.col("_text"))
    out = out.withColumn("text", text).withColumn(
        "n_chars", F.when(touched, F.length("_kept").cast("bigint")).otherwise(F.col("_chars").cast("bigint")))
    return out.select(docs.columns)


ORACLE = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {MIN_CODE_POINTS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}),
m AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
