import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexis.llm import quality, toxicity

LABELS = "doc_id bigint, quality int, toxic int"


def _fold(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def corpus(frame, prose, spark):
    rows, labels = [], []
    for i in range(400):
        text, good, toxic = prose(40 + i % 90, i).capitalize() + ".", 1, 0
        if i % 5 == 0:
            text, good = " ".join(w + "***" for w in text.split()), 0
        elif i % 5 == 1:
            ws = text.split()
            for j in range(0, len(ws), 25):
                ws.insert(j, "grunfel" + ["", "ing", "ster"][j % 3])
            text, toxic = " ".join(ws), 1
        rows.append((i, text))
        labels.append((i, good, toxic))
    return frame(rows), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize("module, label, folds, held", [(quality, "quality", 4, 2), (toxicity, "toxic", 3, 1)])
def test_held_out_accuracy(corpus, module, label, folds, held):
    docs, labels = corpus
    want = {r.doc_id: r[label] for r in labels.collect()}
    rows = module.classify(docs, labels).collect()
    assert all(r.held_out == (_fold(r.doc_id, folds) == held) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    test = [r for r in rows if r.held_out]
    assert sum(r.predicted == want[r.doc_id] for r in test) >= 0.97 * len(test)


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_labels_are_not_read(corpus, module, label):
    docs, labels = corpus
    folds, held = (4, 2) if module is quality else (3, 1)
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    flipped = labels.withColumn(label, F.when(crc == held, 1 - F.col(label)).otherwise(F.col(label)))
    a = {r.doc_id: round(r.score, 6) for r in module.classify(docs, labels).collect()}
    assert a == {r.doc_id: round(r.score, 6) for r in module.classify(docs, flipped).collect()}


@pytest.mark.parametrize("module", [quality, toxicity])
def test_defined_cases(corpus, module, spark, frame, clashing):
    docs, labels = corpus
    odd = frame([(None, "no id"), (5000, None), (5001, ""), (5002, "x" * 300000), (5002, "x" * 300000), (5003, "\U0001F600 ퟿")])
    more = labels.union(spark.createDataFrame([(1, None, None), (2, 7, 9), (None, 1, 1), (99999, 0, 1), (3, 0, 1)], LABELS))
    rows = module.classify(clashing(docs.union(odd)), more).collect()
    assert len(rows) == 406 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (5000, 5001)}) == 1
    none = module.classify(docs, labels.limit(0)).collect()
    assert len(none) == 400 and len({r.score for r in none}) == 1
    assert module.classify(docs.limit(0), labels).count() == 0


def test_cholesky_density_equals_the_plain_formula():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(3, 3))
    cov, mean, x = a @ a.T + np.eye(3), rng.normal(size=3), rng.normal(size=(4, 3))
    low = np.linalg.cholesky(cov)
    model = quality.Discriminant([mean, mean + 1], [np.linalg.inv(low)] * 2, [np.log(np.diag(low)).sum()] * 2, 0.3)
    inv = np.linalg.inv(cov)
    plain = [-0.5 * np.einsum("ij,jk,ik->i", x - m, inv, x - m) - 0.5 * math.log(np.linalg.det(cov)) for m in model.means]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-(plain[1] - plain[0] + 0.3))))


def _beginnings(text):
    """Per word the list of its beginnings, END included, up to ORDER symbols."""
    return [[(w + "$")[:k] for k in range(1, min(len(w) + 1, toxicity.ORDER) + 1)]
            for w in re.findall(r"[^\W\d_]+", (text or "").lower())]


def _brute_force(rows):
    """Evidence of a text, as a plain dictionary version of the model."""
    counts = {0: Counter(), 1: Counter()}
    for text, y in rows:
        counts[y].update(x for w in _beginnings(text) for x in w)
    seen = set(counts[0]) | set(counts[1])
    d, types = toxicity.DISCOUNT, [Counter(("^^" + x)[-3:] for x in seen)]
    for n in (2, 1):
        types.append(Counter(x[-n:] for x in types[-1]))
    types.reverse()

    def shared(g):
        if not g:
            return 2.0 ** -toxicity.BITS
        k = types[len(g) - 1]
        like = {x: n for x, n in k.items() if x[:-1] == g[:-1]}
        return (max(k[g] - d, 0) + d * len(like) * shared(g[1:])) / sum(like.values())

    def prob(x, y):
        like = {z: n for z, n in counts[y].items() if z[:-1] == x[:-1]}
        low, n = shared(("^^" + x)[-3:]), sum(like.values())
        return (max(counts[y][x] - d, 0) + d * len(like) * low) / n if n else low

    ratio = {x: math.log(prob(x, 1) / prob(x, 0)) for x in seen}

    def evidence(text):
        ws = _beginnings(text)
        return sum(max(0, sum(ratio.get(x, 0) for x in w) - toxicity.MARGIN) for w in ws) / (len(ws) + toxicity.LENGTH)

    return evidence


def test_ratios_equal_brute_force(spark, prose):
    """Counts, model, the table of changes and the texts' ratios, end to end."""
    rows = [(prose(30, i) + (" grunfel Grunfeling kabo" if i % 3 == 0 else " grunt, \u00e9t\u00e9"), int(i % 3 == 0)) for i in range(24)]
    rows += [("\u0431\u0440\u0430\u043d\u044c x", 1), ("", 0)]
    grams = spark.createDataFrame(rows, "text string, y int").mapInArrow(
        toxicity._count, "g bigint, c bigint, s bigint, k int, t bigint, o bigint").groupBy("g").agg(
        F.min("c").alias("c"), F.min("s").alias("s"), F.min("k").alias("k"), F.sum("t").alias("t"), F.sum("o").alias("o"))
    table = toxicity.evidence(grams).orderBy("g").toPandas()
    want = _brute_force(rows)
    texts = [t for t, _ in rows] + ["grunfelster grunfe", "never seen", "\u0431\u0440\u0430\u043d", "grunfel" * 9]
    got = toxicity.text_ratios(texts, table.g.to_numpy(), table.v.to_numpy())
    assert len(table) < grams.count() and max(got) > 0.05
    assert np.allclose(got, [want(t) for t in texts], atol=1e-5)


def test_pieces_equal_the_whole(monkeypatch, prose):
    """Words at the seams of pieces count once, with their whole beginnings."""
    texts = [prose(80, 1), "", "x" * 70, "\u6bd2\u8349 ab\u6bd2\u8349c " * 9, "a \U0001D400\U00020000 b"]

    def words(group_list):
        found = Counter()
        for group in group_list:
            of, size, _, h = toxicity.beginnings(group)
            found.update((int(o), tuple(r[:n])) for o, n, r in zip(of, size, h.tolist()))
        return found

    whole = words(toxicity._pieces(texts))
    for n in (1, 7, 64):
        monkeypatch.setattr(toxicity, "_PIECE", n)
        assert words(toxicity._pieces(texts)) == whole
    assert sum(whole.values()) == 80 + 1 + 9 * 6 + 4


def test_statistics_in_pieces(monkeypatch, prose):
    column = pa.array([prose(300, 1), None, "", "A!! B!!\nC", "k " * 500])
    whole = quality.features(column)
    monkeypatch.setattr(quality.hashing, "SEGMENT", 128)
    assert np.allclose(whole, quality.features(column))
    assert np.isfinite(whole).all()


def test_same_scores_with_a_joined_model(corpus):
    """The model joined with the texts' beginnings instead of broadcast."""
    docs, labels = corpus
    want = {r.doc_id: r.score for r in toxicity.classify(docs, labels).collect()}
    model = toxicity.fit(docs, labels, broadcast_grams=0)
    assert model.rest is not None
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], abs_tol=1e-9) for i in want)


def test_toxic_documents_are_found_in_every_language(spark):
    """Held-out recall and precision on the labels of the tables."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model)
    held = rows.where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    n = Counter((r.lang, r.toxic, r.predicted) for r in held.select("lang", "toxic", "predicted").collect())
    hit, miss, false = (sum(v for k, v in n.items() if k[1:] == kind) for kind in ((1, 1), (1, 0), (0, 1)))
    assert hit >= 0.9 * (hit + miss) and hit >= 0.9 * (hit + false)
    for lang in {k[0] for k in n}:
        assert n[lang, 1, 1] >= 0.8 * (n[lang, 1, 1] + n[lang, 1, 0])


def test_every_word_of_a_text_is_evidence_up_to_its_end():
    """``beginnings`` are those of words; a text is read to its end, also beyond a piece."""
    _, size, _, hashes = toxicity.beginnings([(0, "poison", 0, 6)])
    grams, values = hashes[0, size[0] - 1:size[0]].view(np.int64), np.array([5.0], np.float32)
    filler = "plain words " * (toxicity._PIECE // 8)  # more than one piece
    first, last, both, none = toxicity.text_ratios(
        ["poison " + filler, filler + "poison", "poison " + filler + "poison", filler], grams, values)
    assert none == 0 and first > 0
    assert np.isclose(first, last, rtol=1e-5) and np.isclose(both, 2 * last, rtol=1e-4)
