"""Benchmark decontamination (operator 6), with DataFrame functions only.

Windows of a document that are as long as a benchmark item are fingerprinted
with a 64-bit SimHash of their words and looked up in a multi-index: the
fingerprint is cut into 4 blocks of 16 bits, and the items' blocks are stored
with every value within 3 bits.  Fingerprints at most RADIUS = 15 bits apart
agree to 3 bits in one block at least (4 * 4 > 15), so the lookup finds all of
them.  What it finds is verified with the weighted Jaccard similarity of 5-word
shingles (weights are counts): 100 * sum of minima >= 75 * sum of maxima.

Which windows: moving a window on past a shingle that the item lacks loses
nothing, so some best window of an item begins with a shared shingle, or is the
last of its text.  Those windows, and those that align a shared shingle with its
place in the item, are built if they hold enough shared shingles: similarity of
0.75 needs 6 of 7 on average over both lists.  Documents shorter than an item are
one window.

Windows whose fingerprint is further away than the radius are looked up as well:
a similar window lacks so few of its shingles that one of its first ones is the
item's, so the items that have one of those are verified too.

Scale: whole texts are cut into shingles inside the row; the benchmark's
shingles are broadcast if they are few enough (BROADCAST_ROWS, checked), else
joined by shuffle.  Shared shingles are counted by running sums in order of
place.  Texts with a window to build are fetched once more and cut into
overlapping blocks of BLOCK words, from which each window is sliced, so no row
holds more than a block and a window.

Defined cases: null and empty texts and items have no words and match nothing.
Items of fewer than five words are one shingle of all their words.  Rows without
a doc_id can't be reported and are left out (the pipeline's stage keeps them);
items without an item_id likewise.  Repeated rows report once.  Items with the
same item_id and several texts match by any of them.  Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.common import SPACE_CLASS, ascii_lower
from lexis.session import written

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100  # similarity of 0.75 or more
BITS, BLOCKS, NEAR = 64, 4, 3
WIDTH = BITS // BLOCKS
RADIUS = BLOCKS * (NEAR + 1) - 1
BROADCAST_ROWS = 1_000_000  # benchmark shingles of 32 bytes: 32 MB at most
BLOCK = 4096  # words from which on the windows of a block begin
# Every 16-bit pattern of at most NEAR bits.
MASKS = [sum(1 << b for b in bits) for n in range(NEAR + 1) for bits in combinations(range(WIDTH), n)]


def word_list(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    folded = ascii_lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.filter(F.split(folded, SPACE_CLASS + "+"), lambda w: w != "")


def shingle_hashes(words: str, size: int) -> Column:
    """Hash of the ``size`` words from each position on (of fewer at the end)."""
    def one(w, i):
        rest = [F.get(F.col(words), i + j) for j in range(1, size)]
        return F.xxhash64(F.lit(size), w, *rest)

    return F.transform(words, one)


def full_shingles(words: str, size: int) -> Column:
    """Hashes of the full shingles of a word list."""
    return F.slice(shingle_hashes(words, size), F.lit(1), F.greatest(F.lit(0), F.size(words) - (size - 1)))


def simhash(words: str) -> Column:
    """64-bit SimHash of a list's words, each occurrence weighing one."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    half = F.size(words) / F.lit(2)

    def bit(acc, b):
        ones = F.size(F.filter(F.col("_hashes"), lambda h: F.getbit(h, b) == 1))
        return acc.bitwiseOR(F.when(ones > F.col("_half"), F.call_function("shiftleft", F.lit(1).cast("bigint"), b))
                             .otherwise(F.lit(0).cast("bigint")))

    return hashes.alias("_hashes"), half.alias("_half"), bit


def fingerprints(rows: DataFrame, words: str = "words") -> DataFrame:
    """``rows`` with the column fp."""
    hashes, half, bit = simhash(words)
    fp = F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("bigint"), bit)
    return rows.select("*", hashes, half).withColumn("fp", fp).drop("_hashes", "_half")


def _block(fp: str, b: Column) -> Column:
    return F.call_function("shiftrightunsigned", F.col(fp), (b * WIDTH).cast("int")).bitwiseAND(F.lit((1 << WIDTH) - 1))


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_no, words, m, k, shingles, fp) of every item."""
    rows = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("bigint").alias("item_id"), word_list(F.col("text")).alias("words")).where(F.size("words") > 0)
    rows = rows.distinct().withColumn("m", F.size("words")).withColumn("k", F.least(F.lit(SHINGLE), F.size("words")))
    hashes = F.when(F.col("k") == SHINGLE, full_shingles("words", SHINGLE))
    for k in range(1, SHINGLE):
        hashes = hashes.when(F.col("k") == k, full_shingles("words", k))
    return written(fingerprints(rows.withColumn("shingles", hashes)), "items")


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc, tid, m, k, start, words) of the windows that can be similar to an
    item of their length."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.where(F.col("doc_id").isNotNull() & (text != "")).select(
        F.col("doc_id").cast("bigint").alias("doc"), F.xxhash64(text).alias("tid"), text.alias("text"))
    listed = rows.select("doc", "tid", word_list(F.col("text")).alias("words"))
    marks = written(items.select("m", "k", F.posexplode("shingles").alias("ipos", "h")).distinct(), "shingles")
    marks_small = _few(marks)
    sizes = sorted(r[0] for r in items.select("k").distinct().collect())  # at most SHINGLE values
    found = None
    for k in sizes or [SHINGLE]:
        at = listed.select("doc", "tid", F.size("words").alias("n"),
                           F.posexplode(shingle_hashes("words", k)).alias("pos", "h")).where(F.col("pos") <= F.col("n") - k)
        hit = at.join(marks_small.where(F.col("k") == k), "h").select("doc", "tid", "n", "m", "k", "pos", "ipos")
        found = hit if found is None else found.union(hit)
    places = written(_promising(found), "places")
    of = places.select("doc", "tid").distinct().hint("shuffle_hash")
    both = rows.join(of, ["doc", "tid"]).dropDuplicates(["doc", "tid"]).select("doc", "tid", word_list(F.col("text")).alias("words"))
    longest = places.agg(F.max("m")).first()[0] or 0
    last = F.floor((F.size("words") - 1) / BLOCK).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(F.col("words"), b * BLOCK + 1, F.lit(BLOCK + longest)))
    blocks = both.select("doc", "tid", F.posexplode(cut).alias("block", "words"))
    places = places.withColumn("block", F.floor(F.col("start") / BLOCK).cast("int"))
    return blocks.join(places, ["doc", "tid", "block"]).select(
        "doc", "tid", "m", "k", "start", F.slice("words", F.col("start") % BLOCK + 1, F.col("m")).alias("words"))


def _promising(found: DataFrame) -> DataFrame:
    """(doc, tid, m, k, start) of the windows that begin with a shared shingle
    or align one, and hold as many shared places as similarity of 0.75 needs at
    least.  Three kinds of events in order of place, (1) shared places, (0)
    before and (2) at the last place of a window, give each window's number."""
    n, m, k, pos = (F.col(c) for c in ("n", "m", "k", "pos"))
    last = F.least(n, m) - k  # of a window's places, counted from its start
    starts = [F.greatest(F.lit(0), F.least(p, n - m)) for p in (pos, pos - F.col("ipos"))]

    def event(at, kind, start):
        return F.struct(at.alias("at"), F.lit(kind).alias("kind"), start.alias("start"))

    events = [event(pos, 1, F.lit(-1))] + [event(s + d, kind, s) for s in starts for d, kind in ((0, 0), (last, 2))]
    rows = found.select("doc", "tid", "n", "m", "k", F.explode(F.array(*events)).alias("e")).select(
        "doc", "tid", "n", "m", "k", "e.*").distinct()
    key = ["doc", "tid", "n", "m", "k"]
    so_far = Window.partitionBy(*key).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("seen", F.count_if(F.col("kind") == 1).over(so_far)).where("kind <> 1")
    held = rows.groupBy(*key, "start").agg((F.max(F.when(F.col("kind") == 2, F.col("seen"))) -
                                            F.max(F.when(F.col("kind") == 0, F.col("seen")))).alias("held"))
    return held.where(_enough(F.col("held"), last + 1, m - k + 1)).select("doc", "tid", "m", "k", "start")


def _enough(common: Column, n1: Column, n2: Column) -> Column:
    """Whether lists of n1 and n2 shingles with ``common`` of both are similar."""
    return common * (NUMERATOR + DENOMINATOR) >= (n1 + n2) * NUMERATOR


def _weighted_overlap(a: str, b: str) -> Column:
    """Sum over the shingles of both lists of the smaller count."""
    def least(x):
        return F.least(F.size(F.filter(F.col(a), lambda y: y == x)), F.size(F.filter(F.col(b), lambda y: y == x)))

    return F.aggregate(F.transform(F.array_intersect(a, b), least), F.lit(0), lambda s, x: s + x)


def _sharing(found: DataFrame, items: DataFrame) -> DataFrame:
    """(m, fp, ifp) of windows and items that share one of the window's first
    shingles: more of them than a similar window can lack."""
    n = F.size("sw")
    lacks = n - F.ceil((n + F.col("m") - F.col("k") + 1) * NUMERATOR / (NUMERATOR + DENOMINATOR)).cast("int")
    first = found.select("m", "fp", F.explode(F.slice("sw", F.lit(1), lacks + 1)).alias("h")).distinct()
    theirs = items.select("m", F.col("fp").alias("ifp"), F.explode("shingles").alias("h")).distinct()
    return first.join(theirs, ["m", "h"]).select("m", "fp", "ifp").distinct()


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, start, distance): for every document and
    item its best window, if that is similar enough."""
    items = items_of(benchmark)
    found = fingerprints(windows(docs, items))
    own = F.when(F.col("k") == SHINGLE, full_shingles("words", SHINGLE))
    for k in range(1, SHINGLE):
        own = own.when(F.col("k") == k, full_shingles("words", k))
    found = written(found.select("doc", "tid", "m", "k", "start", "fp", own.alias("sw")), "windows")
    index = items.select("item_id", "m", F.col("fp").alias("ifp"), F.col("shingles").alias("si"),
                         F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    keys = index.select("m", "ifp", "block", _block("ifp", F.col("block")).alias("at")).distinct() \
        .select("m", "ifp", "block", "at", F.explode(F.lit(MASKS)).alias("mask")) \
        .select("m", "ifp", "block", F.col("at").bitwiseXOR(F.col("mask").cast("bigint")).alias("value"))
    asked = found.select("m", "fp").distinct().select("m", "fp", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    asked = asked.withColumn("value", _block("fp", F.col("block")))
    close = asked.join(keys, ["m", "block", "value"]).select("m", "fp", "ifp").distinct()
    close = close.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS)
    close = close.union(_sharing(found, items)).distinct() \
        .withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))))
    pairs = found.join(close, ["m", "fp"]).join(items.select("item_id", "m", F.col("fp").alias("ifp"),
                                                            F.col("shingles").alias("si")), ["m", "ifp"])
    pairs = pairs.withColumn("low", _weighted_overlap("sw", "si"))
    pairs = pairs.withColumn("high", F.size("sw") + F.size("si") - F.col("low"))
    good = pairs.where((F.col("low") > 0) & (F.col("low") * DENOMINATOR >= F.col("high") * NUMERATOR))
    best = good.groupBy(F.col("doc").alias("doc_id"), "item_id").agg(
        F.max(F.struct((F.col("low") / F.col("high")).alias("similarity"), (-F.col("start")).alias("back"),
                       (-F.col("distance")).alias("near"))).alias("b"))
    return best.select("doc_id", "item_id", "b.similarity", (-F.col("b.back")).cast("int").alias("start"),
                       (-F.col("b.near")).cast("int").alias("distance"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows whose document holds no benchmark item."""
    hit = matches(docs, benchmark).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(docs.columns)
