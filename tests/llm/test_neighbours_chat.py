import math

import duckdb
import numpy as np

from lexis.llm import chat, neighbours

SF = "/root/testdata/sf0.001"


def _exact(rows, nearest=5):
    """{query: [(score, vec_id)]} for distinct (vec_id, vector) rows."""
    ok = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and not any(x is None or not math.isfinite(x) for x in v)
                 and any(v)})
    ids = np.array([i for i, _ in ok])
    s = neighbours.cosines(np.array([v for _, v in ok], float), np.array([v for _, v in ok], float))
    out = {}
    for n, i in enumerate(ids):
        if i % 50 == 0:
            near = sorted((-s[n, j], ids[j]) for j in range(len(ids)) if ids[j] != i)[:nearest]
            out.setdefault(int(i), [(-a, int(b)) for a, b in near])
    return out


def test_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = _exact(rows)
    got = {}
    for r in neighbours.search(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    vec = dict(rows)
    found = 0
    for q, rs in got.items():
        rs.sort()
        assert [r[0] for r in rs] == [1, 2, 3, 4, 5] and all(a[2] >= b[2] for a, b in zip(rs, rs[1:]))
        for _, v, s in rs:
            a, b = np.array(vec[q], float), np.array(vec[v], float)
            assert math.isclose(s, a @ b / math.sqrt((a @ a) * (b @ b)), abs_tol=1e-12)
        found += len({r[1] for r in rs} & {v for _, v in want[q]})
    assert found >= 0.9 * 5 * len(want)



def test_vectors_of_several_lengths(spark):
    """Each is searched among those of its length, as all pairs of it say."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4 if i % 3 else 7).tolist()) for i in range(240)] + [(300, [1.0, 2.0])]
    got = {}
    for r in neighbours.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), recall=1.0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    vectors = {i: np.array(v) for i, v in rows}
    assert sorted(got) == [0, 50, 100, 150, 200]  # 300 has no other of its length
    found = wanted = 0
    for q, mine in got.items():
        like = {i: v @ vectors[q] / np.linalg.norm(v) / np.linalg.norm(vectors[q])
                for i, v in vectors.items() if len(v) == len(vectors[q]) and i != q}
        assert sorted(mine) == [1, 2, 3, 4, 5] and all(abs(like[i] - s) < 1e-12 for i, s in mine.values())
        best = set(sorted(like, key=lambda i: (-like[i], i))[:5])
        found, wanted = found + len(best & {i for i, _ in mine.values()}), wanted + 5
    assert found >= 0.9 * wanted


def test_tree_visits_all_leaves_in_order():
    rng = np.random.default_rng(2)
    x = neighbours._unit(rng.normal(size=(600, 8)))
    tree = neighbours.Tree(x, fan=4, leaf=20)
    bins = tree.best_bins(x[0], tree.n_leaves)
    assert sorted(bins) == list(range(tree.n_leaves)) and bins[:3] == tree.best_bins(x[0], 3)
    assert (np.bincount(tree.assign(x), minlength=tree.n_leaves) > 0).all()


def test_marks_are_the_first_leaves():
    rng = np.random.default_rng(3)
    x = neighbours._unit(rng.normal(size=(900, 8)))
    tree = neighbours.Tree(x, fan=4, leaf=12)
    for visits in (1, 2, 9, tree.n_leaves // 2, tree.n_leaves - 1, tree.n_leaves):
        marks = tree.first_bins(x[:60], visits)
        assert [np.flatnonzero(m).tolist() for m in marks] == [sorted(tree.best_bins(q, visits)) for q in x[:60]]


def test_ties_copies_and_odd_vectors(spark, clashing):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 2.0]) for i in range(40, 60)] + [(0, [1.0, 0.0, 2.0]), (100, [0.0, 1.0, 0.0]), (100, [0.0, 1.0, 0.0]), (7, [0.0, 3.0, 0.1])]
    odd = [(150, None), (200, []), (250, [0.0, 0.0, 0.0]), (300, [1.0, None, 2.0]), (350, [nan, 1.0, 1.0]), (400, [inf, 1.0, 1.0]),
           (450, [1.0, 2.0]), (None, [1.0, 0.0, 2.0]), (500, [1e-200, 0.0, 2e-200])]
    df = clashing(spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>"))
    got = {}
    for r in neighbours.search(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert set(got) == {0, 50, 100, 500}
    assert [v for _, v in sorted(got[50])] == [0, 40, 41, 42, 43]
    assert [v for _, v in sorted(got[0])] == [40, 41, 42, 43, 44]
    assert [v for _, v in sorted(got[500])] == [0, 40, 41, 42, 43]
    assert sorted(got[100])[0][1] == 7 and len(got[100]) == 5
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id bigint, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id) for r in neighbours.search(few).collect()] == [(0, 1, 1)]
    assert neighbours.search(few.limit(0)).count() == 0
    assert neighbours.search(few).dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]


def test_blocks_and_chunks(spark, monkeypatch):
    """A leaf cut into many blocks and chunks gives the same neighbours."""
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    a = sorted((r.query_id, r.rank, r.vec_id) for r in neighbours.search(df).collect())
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    monkeypatch.setattr(neighbours, "CHUNK", 2)
    assert a == sorted((r.query_id, r.rank, r.vec_id) for r in neighbours.search(df).collect())


def test_queries_come_to_the_units_in_rounds(spark, monkeypatch):
    """One row a query is written and at most the best few for each, not one a visited leaf, and
    several rounds find what one does."""
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    tables, write = [], neighbours.written

    def counted(rows, name):
        out = write(rows, name)
        tables.append((name, out.count()))
        return out

    monkeypatch.setattr(neighbours, "written", counted)
    a = sorted((r.query_id, r.rank, r.vec_id) for r in neighbours.search(df).collect())
    sizes = dict(tables)
    assert sizes["probes"] == sizes["queries"] and sizes["hits"] <= 6 * sizes["queries"]
    tables.clear()
    monkeypatch.setattr(neighbours, "ROUND_BYTES", 2_000)
    assert a == sorted((r.query_id, r.rank, r.vec_id) for r in neighbours.search(df).collect())
    assert sum(name == "hits" for name, _ in tables) > 1


def test_single_precision_loses_nothing():
    """The best of each query are those of double precision, also where single precision can't tell."""
    rng = np.random.default_rng(4)
    x = neighbours._unit(np.concatenate([rng.normal(size=(50, 24)), rng.normal(size=24) + rng.normal(size=(400, 24)) * 1e-8]))
    q = neighbours._unit(np.concatenate([x[:5], x[-5:] + 1e-9, rng.normal(size=(5, 24))]))
    near = neighbours.Nearest(q, 6)
    for i in range(0, len(x), 90):
        near.meet(np.arange(len(q)), x[i:i + 90], np.arange(i, min(i + 90, len(x))), i)
    query, score, _ = near.result()
    assert (query == np.repeat(np.arange(len(q)), 6)).all()
    assert np.allclose(score.reshape(-1, 6), np.sort(q @ x.T, axis=1)[:, :-7:-1], rtol=0, atol=1e-15)


SHAPE = "conv_id bigint, turn bigint, role string, text string"


def _chat(spark, rows):
    out = {}
    for r in chat.format_conversations(spark.createDataFrame(rows, SHAPE)).orderBy("conv_id", "segment").collect():
        out[r.conv_id] = out.get(r.conv_id, "") + r.text
    return out


def test_snapshots_collapse(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "done")]
    rows = []
    for conv, n in ((5, 1), (3, 2), (9, 4), (8, 4), (2, 3)):
        rows += [(conv, i * 10, r, t) for i, (r, t) in enumerate(talk[:n])]
    rows += [(7, 0, "user", "hi"), (7, 1, "assistant", "other"), (11, 0, "user", "hellohi"), (12, 0, "userhi", "")]
    got = _chat(spark, rows)
    assert set(got) == {8, 7, 11, 12}
    assert got[7] == "<|user|>\nhi<|end|>\n<|assistant|>\nother<|end|>\n"


def test_chat_cases(spark, clashing):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, None), (None, 0, "user", "a"), (2, None, "user", "<|end|>"), (2, 0, "x", "y"),
            (3, 5, "user", "b"), (3, 5, "user", "a"), (4, 0, "user", "")]
    got = _chat(spark, rows)
    assert got[1] == "<|user|>\na<|end|>\n<||>\n<|end|>\n"
    assert got[2] == "<|user|>\n< |end|><|end|>\n<|x|>\ny<|end|>\n"
    assert got[3] == "<|user|>\na<|end|>\n<|user|>\nb<|end|>\n" and set(got) == {1, 2, 3, 4}
    df = clashing(spark.createDataFrame(rows, SHAPE))
    assert chat.format_conversations(df).count() == 4
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_long_conversation_is_cut(spark):
    n = chat.SEGMENT * 2 + 3
    rows = [(1, i, "user", f"t{i}") for i in range(n)] + [(2, i, "user", f"t{i}") for i in range(n - 1)]
    out = chat.format_conversations(spark.createDataFrame(rows, SHAPE)).orderBy("segment").collect()
    assert [(r.conv_id, r.segment, r.n_turns) for r in out] == [(1, 0, n), (1, 1, n), (1, 2, n)]
    assert "".join(r.text for r in out) == "".join(f"<|user|>\nt{i}<|end|>\n" for i in range(n))


def test_same_as_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    rel = con.sql(chat.ORACLE)
    want = sorted(tuple(r) for r in rel.fetchall())
    df = chat.format_conversations(spark.read.parquet(f"{SF}/conversations.parquet")).select(rel.columns)
    assert sorted(tuple(r) for r in df.collect()) == want


def test_small_leaves_are_not_the_end(spark, monkeypatch):
    """Queries far from all others, in leaves with fewer than five candidates,
    visit further leaves."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(600, 6)) * 0.02 + np.eye(6)[np.arange(600) % 3], -np.eye(6)])
    ids = np.concatenate([np.arange(1, 601) * 50 + 1, np.arange(6) * 50])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(neighbours, "calibrate", lambda *a, **b: 1)
    tree = neighbours.Tree(neighbours._unit(x), fan=16, leaf=4)
    monkeypatch.setattr(neighbours, "fit_tree", lambda units: tree)
    got = {}
    for r in neighbours.search(df).collect():
        got.setdefault(r.query_id, []).append(r.rank)
    assert {q: sorted(r) for q, r in got.items()} == {i * 50: [1, 2, 3, 4, 5] for i in range(6)}
