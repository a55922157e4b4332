"""MinHash near-duplicates with circulant permutations (operator 3).

Two permutations make all signature coordinates: ``sigma`` scatters a
shingle's 64-bit hash over ``SLOTS`` slots, and ``pi``, a permutation of the
slots, is read circularly shifted by k for coordinate k.  A shingle's K values
are thus one contiguous slice of ``pi``, and a signature is the running minimum
of such slices.  Signatures are cut into bands; documents that share a band are
candidates, and candidates are confirmed with 100*|A and B| >= 75*|A or B| on
their full shingle sets.

Scale: documents with equal sets form one class (aggregated map-side), and only
classes are compared.  In a bucket every class is compared with one pivot, the
best-connected class; buckets whose members are then connected are done.  What is
left is compared across components, where exact bounds rule out most pairs: shingles that no other
candidate has can't be shared, distances to a common pivot differ by no more than
the distance of the pair, and parity bitmaps of the sets differ in no more bits
than the sets have different shingles.  So no pair of different components in a
bucket goes undecided, and no bucket of a connected group is expanded into pairs.

Defined cases: null text counts as empty; a text without words has no shingles,
stands alone and is kept.  Rows without a doc_id are never linked
(component_id null, kept).  Repeated rows share a class, so all of them carry
the same component_id.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm import hashing
from lexis.session import ship_package, written

BANDS, ROWS = 48, 5  # misses a pair at exactly 0.75 with probability 2e-6
SLOTS = 1 << 22
SEED = 11
PARITY_BITS = 1024
_BLOCK = 4096  # shingles whose slices are gathered at a time
_TABLE: dict = {}


def _pi(coordinates: int) -> np.ndarray:
    """``pi`` with its first values repeated at the end, as overlapping slices."""
    if coordinates not in _TABLE:
        table = np.random.default_rng(SEED).permutation(SLOTS).astype(np.uint32)
        table = np.concatenate([table, table[:coordinates]])
        _TABLE[coordinates] = np.lib.stride_tricks.sliding_window_view(table, coordinates)
    return _TABLE[coordinates]


def signature(shingle_hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a set: coordinate k is the least
    ``pi[(sigma(x) + k) mod SLOTS]`` over the set."""
    pi = _pi(coordinates)
    slots = (hashing.mix(shingle_hashes) % np.uint64(SLOTS)).astype(np.int64)  # sigma
    out = None
    for i in range(0, len(slots), _BLOCK):
        low = pi[slots[i:i + _BLOCK]].min(axis=0)
        out = low if out is None else np.minimum(out, low)
    return out


def _each(batch: pa.RecordBatch):
    """(row, sorted distinct shingle hashes) of every text of a batch."""
    raw, offsets = hashing.buffers(batch.column("text"))
    h, at = hashing.words(raw, offsets)
    for i in range(batch.num_rows):
        yield i, hashing.shingles(h[at[i]:at[i + 1]])


def _set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketch(bands: int, rows: int):
    def run(batches):
        place = np.arange(1, rows + 1, dtype=np.uint64)
        which = np.arange(bands, dtype=np.uint64) << np.uint64(40)
        for batch in batches:
            n, keys, cuts = [], [], []
            for _, s in _each(batch):
                n.append(len(s))
                keys.append(_set_key(s) if len(s) else None)
                if len(s):
                    v = signature(s, bands * rows).astype(np.uint64).reshape(bands, rows)
                    cuts.append(hashing.mix(hashing.mix(v * place + (place << np.uint64(32))).sum(axis=1) + which)
                                .view(np.int64))
                else:
                    cuts.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(cuts, pa.list_(pa.int64()))], ["doc_id", "n", "cls", "bands"])

    return run


def parity(shingle_hashes: np.ndarray) -> np.ndarray:
    """Bitmap of a set: bit b is the parity of the shingles hashed to it.  Two
    bitmaps differ in at most as many bits as their sets have shingles that the
    other lacks."""
    odd = np.bincount((shingle_hashes % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(batches):
    for batch in batches:
        keys, sets, bits = [], [], []
        for _, s in _each(batch):
            keys.append(_set_key(s) if len(s) else None)
            sets.append(s.view(np.int64))
            bits.append(parity(s))
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, longs), pa.array(bits, longs)],
                                         ["cls", "set", "bits"])


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: doc_id, n (set size), cls (128-bit key of the set, null
    if empty) and its band keys."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_sketch(bands, rows), "doc_id bigint, n bigint, cls binary, bands array<bigint>")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) but the roots: the root is
    the smallest node of a component.  Alternates large-star and small-star
    rounds, each a grouped minimum and a join, until nothing changes."""
    cur, before = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), None
    while True:
        sym = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
                                            .alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        cur = written(small, "links")
        now = cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:  # every node then has one edge, to its root
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _similar(common: Column, n1: Column, n2: Column) -> Column:
    return common * 100 >= (n1 + n2 - common) * 75


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact overlap of candidate classes: (a, b, common, n1, n2, linked)."""
    left = sets.select(F.col("cls").alias("a"), F.col("set").alias("s1"))
    right = sets.select(F.col("cls").alias("b"), F.col("set").alias("s2"))
    out = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size(F.array_intersect("s1", "s2")).cast("bigint").alias("common"),
        F.size("s1").cast("bigint").alias("n1"), F.size("s2").cast("bigint").alias("n2"))
    return out.withColumn("linked", _similar(F.col("common"), F.col("n1"), F.col("n2")))


def _may_link(n1: str, s1: str, n2: str, s2: str) -> Column:
    """Whether sets of n shingles, s of which occur in any other candidate, can
    be similar: they share at most the smaller s, and their union holds both
    sets' own shingles and the larger s."""
    common = F.least(s1, s2)
    union = F.col(n1) - F.col(s1) + F.col(n2) - F.col(s2) + F.greatest(s1, s2)
    return common * 100 >= union * 75


def _light() -> Column:
    """Whether a set could still be similar to one that has as many shingles
    without another holder.  Of two linked sets at least one is light: a set
    with u shingles of its own can be linked only if its partner has no more
    than (100 s - 75 n) / 75, and both partners can't lie above the other's."""
    return _may_link("n", "s", "n", "s")


def _open(member: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their components, of the buckets that hold more than one."""
    cur = member.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    mixed = cur.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")) \
        .where("lo <> hi").select("bucket")
    return cur.join(mixed, "bucket", "left_semi")


def _shared_counts(cur: DataFrame, sets: DataFrame) -> DataFrame:
    """(cls, s): how many of a class's shingles occur in any other class of
    ``cur``.  Shingles with a single holder are counted per holder, so no
    shingle's holders are ever gathered."""
    there = sets.join(cur.select("cls").distinct(), "cls", "left_semi")
    alone = there.select("cls", F.explode("set").alias("x")).groupBy("x").agg(
        F.count(F.lit(1)).alias("c"), F.min("cls").alias("cls")).where("c = 1").groupBy("cls").agg(F.count(F.lit(1)).alias("u"))
    return there.select("cls", F.size("set").cast("bigint").alias("n")).join(alone, "cls", "left").select(
        "cls", (F.col("n") - F.coalesce("u", F.lit(0))).alias("s"))


def class_components(docs: DataFrame, sk: DataFrame) -> DataFrame:
    """(cls, root) for the classes that are linked to a smaller one."""
    known = sk.where(F.col("cls").isNotNull() & F.col("doc_id").isNotNull())
    # all rows of a class have the same set, and so the same size and bands
    one = known.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    rows = one.select("cls", "doc_id", "n", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    member = written(rows.join(shared, "bucket"), "members")
    weight = member.groupBy("cls").agg(F.sum("c").alias("w"))

    wanted = member.select("doc_id").distinct().hint("shuffle_hash")  # texts are dealt out, but not sorted
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = text.join(wanted, "doc_id", "left_semi").select("text").mapInArrow(
        _sets, "cls binary, set array<bigint>, bits array<bigint>").where("cls is not null").dropDuplicates(["cls"])
    sets = written(sets, "sets")

    # in every bucket the best-connected class is compared with all others
    lead = member.join(weight, "cls").groupBy("bucket").agg(F.max(F.struct("w", "cls", "n")).alias("p"))
    pivots = written(lead.select("bucket", F.col("p.cls").alias("p"), F.col("p.n").alias("pn")), "pivots")
    pairs = member.join(pivots, "bucket").where("cls <> p").where(_may_link("n", "n", "pn", "pn")) \
        .select(F.least("cls", "p").alias("a"), F.greatest("cls", "p").alias("b")).distinct()
    tested = written(_verify(pairs, sets), "verified")
    roots = written(connected(tested.where("linked").select("a", "b")), "roots")

    # and in buckets that are then still in parts, the parts with each other
    cur = written(_open(member.select("bucket", "cls", "n"), roots), "open")
    if not cur.isEmpty():
        cur = cur.join(_shared_counts(cur, sets), "cls").where(F.col("s") * 100 >= F.col("n") * 75)
        pairs = _rest(cur.join(sets.select("cls", "bits"), "cls"), pivots, tested).join(tested, ["a", "b"], "left_anti")
        links = written(_verify(pairs, sets), "verified").where("linked")
        if not links.isEmpty():
            roots = connected(roots.toDF("a", "b").union(links.select("a", "b")))
    return roots.withColumnRenamed("node", "cls")


def _rest(cur: DataFrame, pivots: DataFrame, tested: DataFrame) -> DataFrame:
    """Pairs of one bucket that are in different components and that neither
    their shared shingles, nor the distances to the bucket's pivot, nor their
    parity bitmaps rule out."""
    d = tested.select("a", "b", (1 - F.col("common") / (F.col("n1") + F.col("n2") - F.col("common"))).alias("d"))
    cur = cur.join(pivots.drop("pn"), "bucket", "left") \
        .withColumn("a", F.least("cls", "p")).withColumn("b", F.greatest("cls", "p")).join(d, ["a", "b"], "left")
    cur = cur.withColumn("light", _light())
    x, y = (cur.select("bucket", *[F.col(c).alias(c + k) for c in ("cls", "root", "n", "s", "d", "bits", "light")]) for k in "12")
    apart = F.coalesce(F.abs(F.col("d1") - F.col("d2")), F.lit(0.0))
    differ = sum((F.bit_count(F.col("bits1")[i].bitwiseXOR(F.col("bits2")[i])) for i in range(PARITY_BITS // 64)), F.lit(0))
    pairs = x.where("light1").join(y, "bucket").where("root1 < root2 or (root1 > root2 and not light2)").where(_may_link("n1", "s1", "n2", "s2")).where(apart <= 0.2500001) \
        .where(differ * 7 <= F.col("n1") + F.col("n2"))  # 0.75 or more leaves a seventh at most to one set alone
    return pairs.select(F.least("cls1", "cls2").alias("a"), F.greatest("cls1", "cls2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id
    linked to it directly or through others) and kept."""
    sk = written(sketches(docs, bands, rows), "sketches")
    roots = class_components(docs, sk)
    known = sk.where("cls is not null and doc_id is not null")
    least = known.groupBy("cls").agg(F.min("doc_id").alias("least"))
    of_class = written(least.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "classes")
    of_root = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    comp = of_class.join(of_root, "root").select("cls", "component_id")
    out = sk.select("doc_id", F.col("n").alias("n_shingles"), "cls").join(comp, "cls", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group, that with the smallest doc_id, and one of its
    repeated rows: the pipeline's stage.  Rows without a doc_id stay."""
    found = written(near_duplicates(docs), "near")
    gone = found.where("not kept").select("doc_id").distinct()
    # ids of several rows are few: only those rows are compared whole
    again = written(found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"),
                    "repeated")
    once = docs.join(gone.union(again), "doc_id", "left_anti").select(docs.columns)
    if again.isEmpty():
        return once
    more = docs.join(again.join(gone, "doc_id", "left_anti"), "doc_id", "left_semi").select(docs.columns)
    return once.union(more.dropDuplicates(["doc_id", "text"]))
