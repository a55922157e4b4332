import hashlib
import zlib

import pytest

from lexis.llm import manifest as M

LOWER = {i: i + 32 for i in range(65, 91)}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    i, text, lang, source, n = row
    return sha("".join(map(field, (i, source, lang, n, text))))


def climb(nodes):
    """Root of a list of digests, and each leaf's runs (others before, after)."""
    paths, owner = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, below = [], []
        for a in range(0, len(nodes), 16):
            run = nodes[a:a + 16]
            for j in range(len(run)):
                for i in owner[a + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(sha("".join(run)))
            below.append([i for x in owner[a:a + 16] for i in x])
        nodes, owner = up, below
    return nodes[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    root, upper = climb([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, upper):
        sub, paths = trees[s]
        for (_, _, own, r), path in zip(sorted(by[s], key=lambda x: x[:3]), paths):
            full = path + above
            node = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                node = leaf((r[0], r[1].translate(LOWER) if r[1] is not None else None, *r[2:]))
            for a, b in full:
                node = sha(a + node + b)
            out.append((r[0], own, sub, root, sha("".join(a + b for a, b in full)), node, node == root))
    return sorted(out, key=str)


def mine(df):
    return sorted((tuple(r) for r in M.manifest(df).collect()), key=str)


SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_equals_brute_force_on_the_tables(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert mine(documents) == brute(rows)


@pytest.mark.parametrize("size", [1, 15, 16, 17, 256, 257, 300])
def test_every_shape_of_tree(spark, size):
    rows = [(i * 7, f"Text {i}", "en", "hot", 6) for i in range(size)] + [(3, "Lone", "fr", "other", None)] * (size > 1)
    assert mine(spark.createDataFrame(rows, SHAPE)) == brute(rows)


def test_many_sources_nulls_and_repeats(spark, clashing):
    rows = [(i, f"Doc {i} É" if i % 3 else None, None if i % 4 == 0 else "de", f"s{i % 40}", i) for i in range(120)]
    rows += [(5, "", "", None, 0), (None, "No id", "en", None, None), (None, None, None, None, None)]
    rows += [(7, "Twice", "en", "é", 5)] * 3 + [(7, "twice", "en", "é", 5), (9, "Long" * 30000, "en", "", 120000)]
    df = spark.createDataFrame(rows, SHAPE)
    assert mine(df) == brute(rows)
    assert mine(clashing(df).selectExpr("*", "1 AS tree", "2 AS digest", "3 AS path", "4 AS root")) == brute(rows)


def test_window_blocks_do_not_cut_runs(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 32)
    rows = [(i, f"T{i}", "en", f"s{i % 2}", 1) for i in range(200)]
    assert mine(spark.createDataFrame(rows, SHAPE)) == brute(rows)


def test_empty_table(spark):
    out = M.manifest(spark.createDataFrame([], SHAPE))
    assert out.collect() == [] and out.columns[0] == "doc_id"
