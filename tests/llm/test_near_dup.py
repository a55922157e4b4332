import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import helpers
from lexis.llm import hashing, near_dup


def _result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()}


def test_words_match_plain_python():
    texts = ["", None, "One  two\tTHREE", "É é one", " \n", "x" * 50, "a b\x0bc\x0cd\re"]
    raw, offsets = hashing.buffers(pa.array(texts))
    h, at = hashing.words(raw, offsets)
    own = [helpers.words(t) for t in texts]
    assert list(np.diff(at)) == [len(w) for w in own]
    by_word = {}
    for i, ws in enumerate(own):
        for w, v in zip(ws, h[at[i]:at[i + 1]]):
            assert by_word.setdefault(w, v) == v
    assert len(set(by_word.values())) == len(by_word)


def test_segments_do_not_matter(monkeypatch, prose):
    column = pa.array([prose(400, 1), "z" * 300, None, prose(30, 2) + " " + "q" * 200])
    raw, offsets = hashing.buffers(column)
    h, at = hashing.words(raw, offsets)
    monkeypatch.setattr(hashing, "SEGMENT", 256)
    h2, at2 = hashing.words(raw, offsets)
    assert (at == at2).all()
    long_words = [i for i, w in enumerate(sum((helpers.words(t) for t in column.to_pylist()), [])) if len(w) >= 200]
    same = np.setdiff1d(np.arange(len(h)), long_words)
    assert (h[same] == h2[same]).all()


def test_signature_is_circulant():
    s = np.arange(1, 400, dtype=np.uint64) * np.uint64(977)
    k = 12
    pi = near_dup._pi(k)[:, 0]
    slots = (hashing.mix(s) % np.uint64(near_dup.SLOTS)).astype(np.int64)
    want = [pi[(slots + j) % near_dup.SLOTS].min() for j in range(k)]
    assert list(near_dup.signature(s, k)) == want


def test_parity_is_a_lower_bound():
    rng = np.random.default_rng(5)
    for n in (3, 200, 3000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 2**63, n // 3).astype(np.uint64)]))
        x = np.bitwise_xor(near_dup.parity(a), near_dup.parity(b)).view(np.uint8)
        assert 0 < np.unpackbits(x).sum() <= len(np.setxor1d(a, b))


def test_against_all_pairs(frame, prose):
    rng = random.Random(3)
    rows = []
    for g in range(12):
        base = prose(rng.randint(8, 120), 100 + g).split()
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = prose(1, rng.random())
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    rows += [(1000, "one two"), (1001, "ONE  two"), (1002, "two one"), (1003, ""), (1004, None), (1005, "  ")]
    got = _result(frame(rows))
    want = helpers.components(dict(rows))
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_bucket_without_a_common_pivot(frame, prose):
    """A chain: neighbours are linked, ends aren't, and every document shares
    most of its shingles with all others."""
    base = prose(200, 5).split()
    rows, cur = [], base
    for i in range(14):
        rows.append((i, " ".join(cur)))
        cur = list(cur)
        cur[(i * 14 + 7) % 200] = f"changed{i}"
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame(rows)).collect()}
    assert got == {i: c for i, (_, c) in helpers.components(dict(rows)).items()}


def test_defined_cases(spark, frame, prose, clashing):
    text = prose(40, 9)
    df = frame([(1, text), (1, text), (2, text), (None, text), (None, None), (3, prose(30000, 10) + " " + text)])
    rows = near_dup.near_duplicates(clashing(df)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id is not None) == [
        (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None) and len(rows) == 6
    left = near_dup.drop_near_duplicates(clashing(df))
    assert left.columns == clashing(df).columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "3", "None", "None"]
    assert near_dup.near_duplicates(df.limit(0)).count() == 0
    assert near_dup.near_duplicates(df.withColumn("text", F.lit(None).cast("string"))).count() == 6


def test_partner_within_a_longer_text(frame, prose):
    """Some hundred edited copies, and twenty of them once more with a third of
    text of their own, each of which is similar to that one copy only."""
    base = prose(200, 21).split()
    rows = []
    for i in range(300):
        copy = list(base)
        copy[i * 7 % 200] = f"edit{i}"
        rows.append((i, " ".join(copy)))
    longer = range(5, 300, 15)
    rows += [(1000 + i, rows[i][1] + " " + prose(64, 50 + i)) for i in longer]
    alone = helpers.components({k: v for k, v in rows if k not in longer})
    assert all(alone[1000 + i][1] == 1000 + i for i in longer)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame(rows)).collect()}
    assert got == {i: c for i, (_, c) in helpers.components(dict(rows)).items()} == {i: 0 for i, _ in rows}
