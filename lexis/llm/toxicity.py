"""Toxicity (operator 8): class-conditional Kneser-Ney models.

A text is a row of words (runs of letters of any script, lower-cased; in scripts
written without spaces every symbol begins one).  A model predicts a word's next
symbol, or its end, from the beginning of the word so far, up to ORDER symbols,
so that inflected and compounded forms of an expression share evidence.  Each
class has discounted counts of its own; both back off to the same continuation
counts over the last symbols:

    P_c(x | u) = max(n_c(ux) - D, 0) / n_c(u) + D * t_c(u) / n_c(u) * P(x | u')

with P the Kneser-Ney distribution of the lower orders over both classes'
beginnings.  Beyond the beginning that training texts hold, both classes take the
shared probability, so the rest of a word changes nothing.  A word's evidence is
its toxic minus its ordinary log-likelihood as far as that exceeds MARGIN: rare
forms that one class happens to hold stay below it.  A text's ratio is the sum
over its words divided by its length (words + LENGTH), since an ordinary text may
hold one such word while a toxic one repeats them.  The score is the logistic of
that ratio, calibrated on a fifth of the training rows that the counts leave out
so that THRESHOLD is where the two classes part best.

Scale: counting, continuation counts and probabilities are grouped sums over
every training row.  The model that scores is a table of the beginnings at which
the evidence differs from that of the beginning one symbol shorter; all others
inherit it, so the table is exact and holds little but toxic expressions.  It is
broadcast up to BROADCAST_GRAMS rows (counted first), else the texts' beginnings
are joined with it.  Beginnings are told apart by 64-bit hashes.  Texts are read
in pieces, so memory is bounded for any text.

Defined cases: null and empty texts have no evidence and get the calibrated
score of a ratio of zero.  Labels other than 0 and 1 are ignored; a document with
both labels counts once for each.  Without training rows of both classes the
score is the share of label 1 (0 without labels).  Rows without a doc_id are
scored and count as not held out.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import fold
from lexis.session import ship_package, written

FOLDS, HELD_OUT_FOLD = 3, 1
THRESHOLD = 0.7
ORDER = 8  # symbols of a word that are predicted, its end included
BACKOFF, BITS = 3, 21  # longest shared gram in symbols, bits of a symbol
DISCOUNT = 0.75
MARGIN = 3.0  # log-likelihood ratio up to which a word is no evidence
LENGTH = 50  # words added to a text's length
CALIBRATION_PARTS = 5  # one of so many parts of the training rows calibrates
BROADCAST_GRAMS = 1 << 22  # rows of the model, 12 bytes each: 50 MB at most
BIN = 0.0005  # width of a bin of ratios in the calibration
ROOT = np.uint64(0x9E3779B97F4A7C15)  # the empty beginning
START, END = (1 << BITS) - 1, (1 << BITS) - 2  # before the first symbol, after the last
_PIECE = 1 << 19
# Scripts written without spaces between words: South-East Asian, then East Asian.
_DENSE = ((0xE00, 0xF00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x2E80, 0xA000), (0xF900, 0xFB00), (0x20000, 0x40000))


@cache
def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: the lower-case one, and its kind (0 between words,
    1 letter or mark, 2 letter of a script without spaces)."""
    lower = np.arange(0x110000, dtype=np.uint32)
    kind = np.zeros(0x110000, np.uint8)
    for i in range(0x80, 0x40000):
        c = chr(i)
        if unicodedata.category(c)[0] in "LM":
            kind[i] = 1
            if len(small := c.lower()) == 1:
                lower[i] = ord(small)
    kind[97:123] = kind[65:91] = 1
    lower[65:91] += 32
    for a, b in _DENSE:
        kind[a:b] *= 2
    return lower, kind


def _pieces(texts: list):
    """Lists of (text, characters, first, end): words that begin from ``first``
    to ``end`` belong to the piece; a symbol before and ORDER after are context."""
    group, held = [], 0
    for of, t in enumerate(texts):
        for i in range(0, len(t), _PIECE):
            a = max(0, i - 1)
            cut = t[a:i + _PIECE + ORDER]
            group.append((of, cut, i - a, min(len(t), i + _PIECE) - a))
            held += len(cut)
            if held >= _PIECE:
                yield group
                group, held = [], 0
    if group:
        yield group


def beginnings(group: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every word of a list of pieces: its text, the number of its
    predictions, and per prediction the symbol and the beginning's hash."""
    lower, kind = _symbols()
    raw = "\0".join(cut for _, cut, _, _ in group) + "\0" * (ORDER + 1)
    points = np.frombuffer(raw.encode("utf-32-le", "replace"), np.uint32)
    kinds, points = kind[points], lower[points]
    inside, of = np.zeros(len(points), bool), np.zeros(len(points), np.int32)
    at = 0
    for text, cut, first, end in group:
        inside[at + first:at + end] = True
        of[at:at + len(cut)] = text
        at += len(cut) + 1
    before = np.concatenate([[np.uint8(0)], kinds[:-1]])
    start = np.flatnonzero(inside & (kinds > 0) & ((kinds == 2) | (before != 1)))
    size = np.full(len(start), ORDER)
    symbols = np.full((len(start), ORDER), END, np.int64)
    hashes = np.zeros((len(start), ORDER), np.uint64)
    h, open_ = np.full(len(start), ROOT), np.ones(len(start), bool)
    for k in range(ORDER):
        here = open_ & (kinds[start + k] > 0)
        symbols[here, k] = points[start[here] + k]
        size[open_ & ~here] = k + 1
        h = _mix(h, symbols[:, k])
        hashes[:, k] = h
        open_ = here
    return of[start], size, symbols, hashes


def _mix(h: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Hash of a beginning from that of the one before and the next symbol."""
    x = h ^ ((symbol.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _text_groups(batch: pa.RecordBatch):
    """Slices of a batch of about a piece of text each: (first row, texts)."""
    texts, held, first = [], 0, 0
    for i, t in enumerate(batch.column("text").to_pylist()):
        texts.append(t or "")
        held += len(texts[-1])
        if held >= _PIECE:
            yield first, texts
            texts, held, first = [], 0, i + 1
    if texts:
        yield first, texts


def _counted(y: np.ndarray, group: list):
    """(g, c, s, k, t, o) of the distinct beginnings of a list of pieces: hash,
    hash of the one before, last symbols, length, and counts by class."""
    of, size, symbols, hashes = beginnings(group)
    if not len(of):
        return
    _, first, word = np.unique(hashes[np.arange(len(of)), size - 1], return_index=True, return_inverse=True)
    toxic = y[of] == 1
    n = [np.bincount(word, kept, len(first)) for kept in (toxic, ~toxic)]
    size, symbols, hashes = size[first], symbols[first], hashes[first]
    for k in range(ORDER):
        has = np.flatnonzero(size > k)
        g, one, back = np.unique(hashes[has, k], return_index=True, return_inverse=True)
        one = has[one]
        s = np.zeros(len(one), np.int64)
        for j in range(k - BACKOFF + 1, k + 1):
            s = s << BITS | (symbols[one, j] if j >= 0 else START)
        c = hashes[one, k - 1] if k else np.full(len(one), ROOT)
        yield [g.view(np.int64), c.view(np.int64), s, np.full(len(one), k, np.int32),
               *(np.bincount(back, x[has], len(g)).astype(np.int64) for x in n)]


def _count(batches):
    for batch in batches:
        y = np.array(batch.column("y").to_pylist(), dtype=np.int64)
        for first, texts in _text_groups(batch):
            for group in _pieces(texts):
                for columns in _counted(y[first:], group):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], list("gcskto"))


def backoff(grams: DataFrame) -> DataFrame:
    """Shared Kneser-Ney probability P(last symbol | before) of every gram s of
    BACKOFF symbols, from continuation (type) counts: (s, below)."""
    types, kept = grams, []
    for order in range(BACKOFF, 0, -1):
        types = types.select(_suffix(order).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("k"))
        kept.append((order, types))
    lower = None
    for order, k in reversed(kept):
        ctx = k.groupBy(F.shiftright("s", BITS).alias("u")).agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("m"))
        p = k.join(ctx, F.shiftright("s", BITS) == F.col("u"))
        if lower is None:
            p = p.withColumn("below", F.lit(1.0 / (1 << BITS)))
        else:
            p = p.withColumn("z", _suffix(order - 1)).join(lower.withColumnRenamed("s", "z"), "z")
        p = p.select("s", ((F.greatest(F.col("k") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("m") * F.col("below"))
                           / F.col("n")).alias("below"))
        lower = p
    return lower


def _suffix(order: int) -> Column:
    """The last ``order`` symbols of a gram."""
    return F.col("s").bitwiseAND(F.lit((1 << (BITS * order)) - 1))


def log_ratios(grams: DataFrame) -> DataFrame:
    """(g, c, k, llr): log P_toxic - log P_ordinary of the last symbol of every
    seen beginning g after the one before, c."""
    ctx = grams.groupBy("c").agg(
        F.sum("t").alias("nt"), F.sum("o").alias("no"), F.count_if(F.col("t") > 0).alias("mt"),
        F.count_if(F.col("o") > 0).alias("mo"))
    rows = grams.join(ctx, "c").join(backoff(grams), "s")
    prob = {x: F.when(F.col("n" + x) > 0, (F.greatest(F.col(x) - DISCOUNT, F.lit(0.0))
                                           + DISCOUNT * F.col("m" + x) * F.col("below")) / F.col("n" + x))
            .otherwise(F.col("below")) for x in "to"}
    return rows.select("g", "c", "k", (F.log(prob["t"]) - F.log(prob["o"])).alias("llr"))


def evidence(grams: DataFrame) -> DataFrame:
    """(g, v): evidence of the beginnings at which it differs from that of the
    beginning one symbol shorter.  One join per length with the table of the
    length before; a beginning has as many rows there as symbols follow it."""
    ratios = written(log_ratios(grams), "toxic-ratios")
    above = F.greatest(F.col("r") - MARGIN, F.lit(0.0)).cast("float")
    kept, shorter = None, None
    for k in range(ORDER):
        own = ratios.where(F.col("k") == k)
        if k:
            own = own.join(shorter, "c").withColumn("r", F.col("r") + F.col("llr"))
        else:
            own = own.withColumn("r", F.col("llr")).withColumn("was", F.lit(0.0).cast("float"))
        own = written(own.select("g", "r", "was", above.alias("v")), "toxic-level")
        shorter = own.select(F.col("g").alias("c"), "r", F.col("v").alias("was"))
        changed = own.where("v <> was").select("g", "v")
        kept = changed if kept is None else kept.unionAll(changed)
    return written(kept, "toxic-model")


@dataclass
class Model:
    """Evidence of beginnings in order of their hashes (in the table ``rest``,
    if they are too many), and the calibration."""

    grams: np.ndarray
    values: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None
    rest: DataFrame | None = None


def text_ratios(texts: list, grams: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Length-normalised evidence of each text."""
    total, words = np.zeros(len(texts)), np.zeros(len(texts))
    for group in _pieces(texts):
        of, size, _, hashes = beginnings(group)
        v = np.zeros(len(of), np.float32)
        for k in range(ORDER if len(grams) else 0):  # the longest beginning in the table speaks
            asked = hashes[:, k].view(np.int64)
            place = np.minimum(np.searchsorted(grams, asked), len(grams) - 1)
            hit = (grams[place] == asked) & (size > k)
            v[hit] = values[place[hit]]
        total += np.bincount(of, v, len(texts))
        words += np.bincount(of, minlength=len(texts))
    return total / (words + LENGTH)


def _scored(docs: DataFrame, model: Model, extra: list) -> DataFrame:
    """doc_id, ``extra`` columns and r, the ratio of each row."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(replace(model, rest=None))
    joined = model.rest is not None

    def run(batches):
        for batch in batches:
            r = np.zeros(batch.num_rows)
            for first, texts in _text_groups(batch):
                part = batch.slice(first, len(texts))
                table = _merged(part) if joined else (shared.value.grams, shared.value.values)
                r[first:first + len(texts)] = text_ratios(texts, *table)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(c) for c in extra), pa.array(r)], ["doc_id", *extra, "r"])

    def asked(batches):
        for batch in batches:
            for first, texts in _text_groups(batch):
                for group in _pieces(texts):
                    of, size, _, hashes = beginnings(group)
                    for k in range(ORDER):
                        has = size > k
                        pair = np.unique(np.stack([first + of[has], hashes[has, k].view(np.int64)]), axis=1)
                        row = pa.array(pair[0])
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("a").take(row), batch.column("b").take(row), pa.array(pair[1])], ["a", "b", "g"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in extra)
    rows = docs.select("doc_id", "text", *extra)
    if joined:  # the model's rows of each text, by the text's key
        rows = rows.withColumn("a", F.xxhash64("text")).withColumn("b", F.xxhash64(F.lit(7), "text"))
        own = rows.select("a", "b", "text").mapInArrow(asked, "a bigint, b bigint, g bigint").distinct()
        found = own.join(model.rest, "g").groupBy("a", "b").agg(F.collect_list(F.struct("g", "v")).alias("x"))
        rows = rows.join(found, ["a", "b"], "left").select(
            "doc_id", "text", *extra, F.col("x.g").alias("g"), F.col("x.v").alias("v"))
    return rows.mapInArrow(run, f"doc_id {kind}{more}, r double")


def _merged(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The model's rows of a batch's texts in order."""
    g, first = np.unique(np.asarray(batch.column("g").flatten(), np.int64), return_index=True)
    return g, np.asarray(batch.column("v").flatten(), np.float32)[first]


def _calibrate(bins: list) -> tuple[float, float]:
    """Slope of a weighted logistic regression of the label on the binned ratio
    (with a weak pull towards zero), and the offset at which the score passes
    THRESHOLD where a cut of the ratio makes the fewest errors; if that holds
    for a stretch of cuts, in its middle."""
    x = np.array([b[0] * BIN for b in bins])
    y = np.array([b[1] for b in bins], float)
    w = np.array([b[2] for b in bins], float)
    scale = max(1e-9, float(np.sqrt((w * (x - np.average(x, weights=w)) ** 2).sum() / w.sum())))
    beta, a = np.zeros(2), np.column_stack([x / scale, np.ones(len(x))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (y - p)) - np.array([0.05, 0.0]) * beta
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + np.diag([0.05, 1e-9])
        beta = beta + np.clip(np.linalg.solve(hess, grad), -2, 2)
    slope = float(beta[0] / scale)
    points = np.unique(x)
    cuts = np.concatenate([[points[0] - BIN], (points[1:] + points[:-1]) / 2, [points[-1] + BIN]])
    errors = np.array([(w * ((x > c) != (y == 1))).sum() for c in cuts])
    best = cuts[errors == errors.min()]
    return slope, float(np.log(THRESHOLD / (1 - THRESHOLD)) - slope * (best.min() + best.max()) / 2)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", broadcast_grams: int = BROADCAST_GRAMS) -> Model:
    """Counts, model and calibration from the labelled rows outside the
    held-out fold."""
    spark = docs.sparkSession
    ship_package(spark)
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select(
        F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")).distinct().hint("shuffle_hash")
    rows = docs.where(fold("doc_id", FOLDS) != HELD_OUT_FOLD).select(
        "doc_id", F.col("text").cast("string").alias("text"))
    train = rows.join(marks, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "y")
    # one pass over the joined texts, written once: counts and calibration read it
    train = written(train.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION_PARTS))), "toxic-train")
    share = {r[0]: r[1] for r in train.groupBy("y").count().collect()}
    if len(share) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), constant=float(1 in share))
    grams = train.where("part <> 0").select("text", "y").mapInArrow(
        _count, "g bigint, c bigint, s bigint, k int, t bigint, o bigint")
    grams = written(grams.groupBy("g").agg(F.min("c").alias("c"), F.min("s").alias("s"), F.min("k").alias("k"),
                                           F.sum("t").alias("t"), F.sum("o").alias("o")), "toxic-grams")
    table = evidence(grams)
    few = table.count() <= broadcast_grams
    held = (table.orderBy("g") if few else table.limit(0)).toPandas()
    model = Model(held.g.to_numpy(np.int64), held.v.to_numpy(np.float32), rest=None if few else table)
    seen = _scored(train.where("part = 0"), model, ["y"])
    bins = seen.groupBy(F.round(F.col("r") / BIN).cast("int").alias("x"), "y").count().collect()
    if len({b[1] for b in bins}) == 2:
        model.slope, model.offset = _calibrate(bins)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT_FOLD, F.lit(False))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if model.constant is not None:
        out = rows.select("doc_id", F.lit(model.constant).alias("score"))
    else:
        z = F.col("r") * model.slope + model.offset
        out = _scored(rows, model, []).select("doc_id", (1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))).alias("score"))
    return out.select("doc_id", held.alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled training rows of ``docs`` and score every row."""
    return score(docs, fit(docs, labels))
