"""Document fingerprints (operator 11), with DataFrame functions only.

A fingerprint is a threshold-scaled sketch: the hashes of all distinct shingles of a text
that lie below a fixed fraction of their range.  Whether a hash is kept depends on nothing
but the hash, so fingerprints of parts merge into that of the whole, and of a short and a
very long text the same shingles are kept, which makes the share of one in the other
comparable.  Texts with few shingles below the threshold keep their LEAST smallest hashes
instead; up to the largest of these the sketch is complete as well, and two sketches
are compared up to where both are.

Scale: the sketch is made inside the row.  To find the next document only ids, lengths
and hashes are numbered; then texts are dealt out by doc_id once, and from every document
only its sketch and the beginning that its predecessor asks for travel on.

Defined cases: null text counts as empty; a text without words has an empty fingerprint,
which is like another empty one (1.0) and unlike any other (0.0); a text of fewer than five
words is one shingle.  Rows without a doc_id come before all others.  Rows that share a
doc_id have the same next document; as someone's next document they are the one whose text
has the smallest hash.  The next document of a table's only one is itself.  Equal rows
are all returned.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import SPACE_CLASS, ascii_lower
from lexis.operators.rows import dense_index
from lexis.session import written

SHINGLE = 5  # words
RANGE = 1 << 63  # hashes are numbers from 0 up to here
THRESHOLD = RANGE // 8  # every shingle hash below is retained
LEAST = 16  # smallest hashes kept of a text with fewer below the threshold
_FIRST_ID = -(1 << 63)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(ascii_lower(text), SPACE_CLASS + "+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(text: Column) -> Column:
    """Hash of every shingle of a text, in order and with repetitions."""
    none = F.array().cast("array<bigint>")

    def of(words):
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - SHINGLE + 1, F.lit(1)))
        return F.when(F.size(words) == 0, none).otherwise(
            F.transform(starts, lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(words, i, F.lit(SHINGLE))), 1)))

    return _let(word_hashes(text), of)


def _retained(hashes: Column) -> Column:
    """The sketch of a list of shingle hashes."""
    def of(every):
        below = F.array_sort(F.array_distinct(F.filter(every, lambda x: x < THRESHOLD)))
        return _let(below, lambda kept: F.when(F.size(kept) >= LEAST, kept).otherwise(
            F.slice(F.array_sort(F.array_distinct(every)), 1, LEAST)))

    return _let(hashes, of)


def sketch(text: Column) -> Column:
    """Ascending hashes retained of a text."""
    return _retained(shingle_hashes(F.coalesce(text.cast("string"), F.lit(""))))


def merge(a: Column, b: Column) -> Column:
    """The sketch of all shingles of two sketched texts."""
    return _retained(F.concat(a, b))


def _reach(x: Column) -> Column:
    """The largest hash up to which a sketch holds every shingle."""
    return F.when(F.size(x) < LEAST, F.lit(RANGE - 1)).otherwise(
        F.greatest(F.element_at(x, -1), F.lit(THRESHOLD - 1)))


def _compared(a: Column, b: Column, ratio) -> Column:
    """``ratio(common, of a, of b)`` over the hashes that both sketches could hold."""
    def upto(x, y, end):
        return _let(F.filter(x, lambda h: h <= end), lambda p: _let(F.filter(y, lambda h: h <= end), lambda q: ratio(
            F.size(F.array_intersect(p, q)).cast("double"), F.size(p), F.size(q))))

    found = _let(F.least(_reach(a), _reach(b)), lambda end: upto(a, b, end))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)) \
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.coalesce(found, F.lit(0.0)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has."""
    return _compared(a, b, lambda common, of_a, of_b: F.try_divide(common, of_a))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts' shingles."""
    return _compared(a, b, lambda common, of_a, of_b: F.try_divide(common, of_a + of_b - common))


def likeness(a: Column, b: Column) -> Column:
    """Containment of the text with fewer shingles in the other one."""
    return _compared(a, b, lambda common, of_a, of_b: F.try_divide(common, F.least(of_a, of_b)))


def as_text(x: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits per hash, ascending."""
    return F.array_join(F.transform(x, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def from_text(x: Column) -> Column:
    """The sketch that ``as_text`` wrote."""
    at = F.sequence(F.lit(0), (F.length(x) / 16).cast("int") - 1)
    return F.when(F.length(x) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(at, lambda i: F.conv(x.substr(i * 16 + 1, F.lit(16)), 16, 10).cast("bigint")))


def following(rows: DataFrame) -> DataFrame:
    """(prev, key, wanted, need): for every id the next one (for the last the first),
    the hash of that one's text, and the code points needed of it."""
    ids = rows.groupBy("key").agg(F.min("text_hash").alias("text_hash"), F.max("n_chars").alias("longest"))
    at = written(dense_index(ids, ["key"], "_at"), "ids")
    total = at.count()
    before = at.select(F.expr(f"(_at + 1) % {max(total, 1)}").alias("_at"), F.col("key").alias("prev"),
                       F.expr("longest div 4").alias("need"))
    return at.select("_at", "key", F.col("text_hash").alias("wanted")).join(before, "_at").drop("_at")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next and text_hash.  The edited text has its last quarter replaced by the
    beginning of the next document."""
    kind = docs.schema["doc_id"].dataType
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_FIRST_ID)).alias("key"), text.alias("text"),
                       F.xxhash64(text).alias("text_hash"))
    after = written(following(rows.withColumn("n_chars", F.length("text"))), "following")
    # Both joins read the same columns, dealt out once; merge joins at every size of the table.
    dealt = rows.withColumn("sketch", sketch(F.col("text")))
    # (the hashes are compared by a bit operation, so that both sides stay dealt out by the key alone)
    heads = dealt.join(after.hint("merge"), "key").where(F.col("text_hash").bitwiseXOR(F.col("wanted")) == 0).select(
        F.col("prev").alias("key"), F.col("text").substr(F.lit(1), F.col("need").cast("int")).alias("head"),
        F.col("sketch").alias("next_sketch"))
    heads = heads.groupBy("key").agg(F.first("head").alias("head"), F.first("next_sketch").alias("next_sketch"))
    both = dealt.join(heads.hint("merge"), "key")
    n = F.length("text")
    cut = F.expr("length(text) div 4").cast("int")
    both = both.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), n - cut), F.col("head").substr(F.lit(1), cut)))
    both = both.withColumn("edited_sketch", sketch(F.col("edited")))
    return both.select(
        F.when(F.col("key") != _FIRST_ID, F.col("key")).cast(kind).alias("doc_id"), n.cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"), "text_hash")
