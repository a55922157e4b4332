"""Chat formatting (operator 10), with DataFrame functions only.

Logs of growing conversations hold each of them many times, cut off at different
turns.  Every turn gets a rolling hash of all turns up to it; a conversation
whose last hash is the hash of an earlier turn of a longer one is a snapshot of
that one, and an anti join drops it.  Equal conversations keep the smallest
conv_id.  What remains is rendered, SEGMENT turns to a row.

Scale: turns are numbered by range partitioning, so a conversation may be larger
than a task.  The rolling hash is an exclusive-or of position-salted turn hashes:
it is summed up per block of turns first, and only the blocks of a conversation
meet in one window.  Snapshots are compared as (turns, hash) pairs, aggregated
before they are shuffled; texts are moved once to be numbered and once to be
rendered.  A very long conversation is several rows, never one group.

Defined cases: rows without a conv_id belong to no conversation and are left
out.  Null roles and texts count as empty; a null turn comes first.  Equal turns
of a conversation count once; turns of the same number are ordered by role and
text.  ``<|`` inside a role or text is written ``< |``, so that no text can forge
a marker.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexis.operators.rows import dense_index
from lexis.session import written

BLOCK = 256  # turns whose hashes are combined first
SEGMENT = 256  # turns rendered into one row


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, p, role, text): distinct turns, numbered from 0 within each
    conversation."""
    turns = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    at = written(dense_index(turns, ["conv_id", "turn", "role", "text"], "_at"), "turns")
    first = at.groupBy("conv_id").agg(F.min("_at").alias("_first"))
    return written(at.join(first, "conv_id").select("conv_id", (F.col("_at") - F.col("_first")).alias("p"), "role", "text"),
                   "turns")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, k, ha, hb): hash of the first k turns, for every k."""
    salted = turns.select("conv_id", "p", F.expr(f"p div {BLOCK}").alias("block"),
                          F.xxhash64("p", "role", "text").alias("ta"),
                          F.xxhash64(F.lit(7), "p", "role", "text").alias("tb"))
    blocks = salted.groupBy("conv_id", "block").agg(F.bit_xor("ta").alias("ba"), F.bit_xor("tb").alias("bb"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", F.coalesce(F.bit_xor("ba").over(before), F.lit(0)).alias("ba"),
                           F.coalesce(F.bit_xor("bb").over(before), F.lit(0)).alias("bb"))
    upto = Window.partitionBy("conv_id", "block").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    inside = salted.select("conv_id", "block", "p", F.bit_xor("ta").over(upto).alias("ta"),
                           F.bit_xor("tb").over(upto).alias("tb"))
    return inside.join(blocks, ["conv_id", "block"]).select(
        "conv_id", (F.col("p") + 1).alias("k"), F.col("ta").bitwiseXOR(F.col("ba")).alias("ha"),
        F.col("tb").bitwiseXOR(F.col("bb")).alias("hb"))


def maximal(hashes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies) of the conversations that are no snapshot of a longer
    one; of equal ones the smallest conv_id."""
    length = hashes.groupBy("conv_id").agg(F.max("k").alias("n"))
    marked = hashes.join(length, "conv_id")
    whole = marked.where("k = n").groupBy("k", "ha", "hb").agg(F.min("conv_id").alias("conv_id"),
                                                               F.count(F.lit(1)).alias("copies"))
    inner = marked.where("k < n").select("k", "ha", "hb").distinct()
    return whole.join(inner, ["k", "ha", "hb"], "left_anti").select("conv_id", F.col("k").alias("n_turns"), "copies")


def _plain(c):
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of at most SEGMENT rendered turns: conv_id, segment, n_turns (of
    the conversation), copies and text."""
    piece = F.concat(F.lit("<|"), _plain(F.col("role")), F.lit("|>\n"), _plain(F.col("text")), F.lit("<|end|>\n"))
    rows = turns.select("conv_id", "p", F.expr(f"p div {SEGMENT}").alias("segment"), piece.alias("piece")) \
        .join(kept, "conv_id")
    return rows.groupBy("conv_id", "segment").agg(
        F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p", "piece"))), lambda x: x["piece"]), "").alias("text"))


def format_conversations(rows: DataFrame) -> DataFrame:
    turns = numbered_turns(rows)
    kept = maximal(written(prefix_hashes(turns), "prefixes"))
    return render(turns, kept)


ORACLE = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT conv_id, role, text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS p FROM t),
c AS (SELECT conv_id, count(*) AS n, list(struct_pack(role := role, text := text) ORDER BY p) AS a FROM r GROUP BY conv_id),
d AS (SELECT min(conv_id) AS conv_id, any_value(n) AS n, count(*) AS copies, a FROM c GROUP BY a),
x AS (SELECT DISTINCT a[1:k] AS b FROM (SELECT a, unnest(range(1, n)) AS k FROM d)),
m AS (SELECT d.* FROM d WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.b = d.a))
SELECT r.conv_id, r.p // {SEGMENT} AS segment, any_value(m.n) AS n_turns, any_value(m.copies) AS copies,
       string_agg('<|' || replace(r.role, '<|', '< |') || '|>' || chr(10) || replace(r.text, '<|', '< |') || '<|end|>'
                  || chr(10), '' ORDER BY r.p) AS text
FROM r JOIN m USING (conv_id) GROUP BY r.conv_id, r.p // {SEGMENT}
"""
