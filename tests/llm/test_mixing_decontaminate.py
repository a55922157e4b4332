import random

import duckdb
from pyspark.sql import functions as F

import helpers
from lexis.llm import decontaminate, mixing

SF = "/root/testdata/sf0.001"


def test_factors_meet_all_marginals(documents):
    cells = documents.select(F.col("source"), F.col("lang"), mixing.word_total(F.col("text")).alias("tokens"),
                             mixing.form(F.col("text"), mixing.word_total(F.col("text"))).alias("topic")) \
        .groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))
    factors = mixing.rake(cells, rounds=25)
    f = {d: {r.value: r.factor for r in t.collect()} for d, t in factors.items()}
    rows = cells.collect()
    total = sum(r.tokens for r in rows)
    for dim in mixing.DIMS:
        want = {r.value: r.share for r in mixing.tempered(cells, dim).collect()}
        got = {}
        for r in rows:
            w = r.tokens * f["source"][r.source] * f["lang"][r.lang] * f["topic"][r.topic]
            got[r[dim]] = got.get(r[dim], 0) + w / total
        assert all(abs(got[v] - want[v]) < 2e-3 for v in want), dim


def test_a_half_step_is_one_sum_joined_back(documents, monkeypatch):
    """One written plan with one join a half-step: plans and broadcasts are what fills the driver."""
    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return written(df, name)

    from lexis.session import written

    cells = documents.select(F.col("source"), F.col("lang"), F.lit("a").alias("topic"), F.lit(1).alias("tokens")) \
        .groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))
    monkeypatch.setattr(mixing, "written", kept)
    mixing.rake(cells, rounds=2)
    steps = plans[-2 * len(mixing.DIMS):]
    assert len(plans) == 1 + len(steps) and all(p.count("Join ") == 1 and p.count("Aggregate ") == 1 for p in steps)


def test_same_as_sql(documents):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(mixing.oracle())
    want = sorted(tuple(r) for r in rel.fetchall())
    assert sorted(tuple(r) for r in mixing.mixture(documents).select(rel.columns).collect()) == want


def test_given_targets_and_expected_share(spark, frame, prose):
    df = frame([(i, prose(100, i)) for i in range(600)]).withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "a").otherwise("b"))
    want = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "value string, share double")
    out = mixing.mixture(df, targets={"source": want}).collect()
    p = {s: {r.probability for r in out if r.source == s} for s in "ab"}
    assert p["a"] == {1.0} and all(abs(x - 0.5) < 1e-6 for x in p["b"])
    kept = [r for r in out if r.kept]
    assert all(r.kept for r in out if r.source == "a") and 150 < sum(r.source == "b" for r in kept) < 250


def test_mixing_cases(frame, clashing):
    df = frame([(1, None), (2, ""), (None, "some words here"), (3, "w " * 50000), (3, "w " * 50000)])
    df = clashing(df.withColumn("source", F.when(F.col("doc_id") == 1, "s").cast("string")))
    out = mixing.mixture(df).collect()
    assert len(out) == 5 and all(r.probability is not None and 0 <= r.probability <= 1 for r in out)
    assert len({r.kept for r in out if r.doc_id == 3}) == 1
    assert {r.n_tokens for r in out if r.doc_id in (1, 2)} == {0}
    left = mixing.sample_mixture(df)
    assert [c for c in df.columns if c not in ("topic", "probability")] == left.columns[:-3]
    assert mixing.mixture(df.limit(0)).count() == 0
    assert mixing.mixture(df.withColumn("text", F.lit(None).cast("string"))).count() == 5


def _items(spark, items):
    return spark.createDataFrame(list(items.items()), "item_id bigint, text string")


def test_every_leak_and_nothing_else(spark, frame, prose):
    rng = random.Random(4)
    items = {i: prose(rng.randint(14, 60), 500 + i) for i in range(12)} | {50: "Short item here", 51: "ba"}
    docs = {}
    for d in range(60):
        ws = prose(rng.randint(0, 150), 900 + d).split()
        if d % 3:
            cut = items[d % 12].split()
            for _ in range(d % 4):  # none to three edits
                at = rng.randrange(len(cut))
                cut[at:at + 1] = rng.choice([[], ["changed"], [cut[at], "added"]])
            at = rng.randint(0, len(ws))
            ws[at:at] = [w.upper() if d % 5 == 0 else w for w in cut]
        docs[d] = ("\n" if d % 2 else "  ").join(ws)
    docs |= {100: "a SHORT  item here now", 101: "short item", 102: items[3], 103: " ".join(items[4].split()[:-2])}
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(frame(list(docs.items())), _items(spark, items)).collect()}
    assert got == helpers.leaks(docs, items)


def test_on_the_tables(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = decontaminate.matches(documents, bench).collect()
    docs = {r.doc_id: r.text for r in documents.collect()}
    assert got and {(r.doc_id, r.item_id) for r in got} == helpers.leaks(docs, {r.item_id: r.text for r in bench.collect()})
    assert all(0.75 <= r.similarity <= 1 and 0 <= r.distance <= decontaminate.RADIUS for r in got)


def test_multi_index_finds_all_within_the_radius():
    """Any two fingerprints RADIUS bits apart agree to NEAR bits in a block."""
    rng = random.Random(1)
    masks = set(decontaminate.MASKS)
    for _ in range(2000):
        flips = sum(1 << b for b in rng.sample(range(64), decontaminate.RADIUS))
        assert any((flips >> (16 * b)) & 0xFFFF in masks for b in range(4))
    assert len(masks) == 1 + 16 + 120 + 560


def test_decontamination_cases(spark, frame, prose, clashing):
    item = prose(30, 77)
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, item), (4, item)], "item_id bigint, text string")
    docs = [(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "w " * 60000 + item), (5, prose(40, 78))]
    df = clashing(frame(docs))
    out = decontaminate.matches(df, clashing(items)).collect()
    assert sorted((r.doc_id, r.item_id) for r in out) == [(1, 1), (1, 4), (4, 1), (4, 4)]
    assert {r.start for r in out if r.doc_id == 4} == {60000}
    left = decontaminate.drop_contaminated(df, items)
    assert left.columns == df.columns and sorted(str(r.doc_id) for r in left.collect()) == ["2", "3", "5", "None"]
    assert decontaminate.matches(df.limit(0), items).count() == 0
    assert decontaminate.matches(df, items.limit(0)).count() == 0


def _turned(item, n):
    ws = item.split()
    return " ".join(ws[n:] + ws[:n])


def test_moved_parts_and_blocks(spark, frame, prose, monkeypatch):
    """Items whose parts stand in another order, in texts of several blocks."""
    monkeypatch.setattr(decontaminate, "BLOCK", 16)
    items = {i: prose(100, 700 + i) for i in range(4)} | {9: prose(30, 709)}
    docs = {10 * i + j: prose(40 + 7 * j, 800 + i) + " " + _turned(items[i], n) + " " + prose(j * 9, 850 + j)
            for i in range(4) for j, n in enumerate((15, 20, 30, 50))}
    docs |= {90: _turned(items[9], 3), 91: prose(5, 1) + " " + items[9], 92: items[1] + " " + items[1] + " " + items[2][:200]}
    want = helpers.leaks(docs, items)
    assert {(0, 0), (11, 1), (22, 2), (33, 3)} <= want
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(frame(list(docs.items())), _items(spark, items)).collect()}
    assert got == want


def test_similar_windows_beyond_the_radius(spark, frame):
    """Few different words, whose bits a handful of others turn over: similar
    shingles, but a fingerprint far away."""
    item = " ".join(f"w{i}" for i in range(60))
    docs = {d: " ".join([f"w{i}" for i in range(52)] + [f"d{d}"] * 8) for d in range(40)}
    want = helpers.leaks(docs, {1: item})
    out = decontaminate.matches(frame(list(docs.items())), _items(spark, {1: item})).collect()
    assert len(want) == 40 and {(r.doc_id, r.item_id) for r in out} == want
    assert any(r.distance > decontaminate.RADIUS for r in out)
