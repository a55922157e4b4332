import hashlib

from helpers import shingle_list, words
from pyspark.sql import functions as F

from lexis.llm import fingerprint as P

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def hashes(spark, shingles):
    """{shingle: hash} by the rule of the operator, one shingle at a time."""
    every = sorted(set(shingles))
    df = spark.createDataFrame([(i, list(s)) for i, s in enumerate(every)], "i int, w array<string>")
    h = F.shiftrightunsigned(F.xxhash64(F.transform("w", lambda x: F.xxhash64(x))), 1)
    return {every[r["i"]]: r["h"] for r in df.select("i", h.alias("h")).collect()}


def brute(spark, rows):
    rows = [(i, t or "") for i, t in rows]
    hash_of = {r["t"]: r["h"] for r in spark.createDataFrame([(t,) for t in {t for _, t in rows}], "t string")
               .select("t", F.xxhash64("t").alias("h")).collect()}
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i))
    chosen = {i: min((hash_of[t], t) for j, t in rows if j == i)[1] for i in ids}
    edited = {}
    for i, t in rows:
        nxt = chosen[ids[(ids.index(i) + 1) % len(ids)]]
        cut = len(t) // 4
        edited[i, t] = (t[:len(t) - cut] + nxt[:cut], nxt)
    texts = {t for _, t in rows} | {x for e in edited.values() for x in e}
    sets = {t: set(shingle_list(words(t))) for t in texts}
    known = hashes(spark, [s for x in sets.values() for s in x])

    def sketch(t):
        all_h = sorted({known[s] for s in sets[t]})
        below = [h for h in all_h if h < P.THRESHOLD]
        return below if len(below) >= P.LEAST else all_h[:P.LEAST]

    def reach(s):
        return 1 << 63 if len(s) < P.LEAST else max(s[-1], P.THRESHOLD - 1)

    def near(a, b):
        a, b = sketch(a), sketch(b)
        if not a or not b:
            return 1.0 if a == b else 0.0
        end = min(reach(a), reach(b))
        a, b = {h for h in a if h <= end}, {h for h in b if h <= end}
        return len(a & b) / min(len(a), len(b)) if a and b else 0.0

    out = []
    for i, t in rows:
        e, nxt = edited[i, t]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), "".join(f"{h:016x}" for h in sketch(t)),
                    "".join(f"{h:016x}" for h in sketch(e)), near(t, e), near(t, nxt)))
    return sorted(out, key=str)


def mine(df):
    return sorted((tuple(r)[:7] for r in P.fingerprints(df).collect()), key=str)


def test_equals_brute_force_on_the_tables(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = mine(documents)
    assert found == brute(spark, rows)
    near = [r[5] for r in found if r[1] > 400]
    assert sum(near) / len(near) > 0.6 and sum(r[6] for r in found) / len(found) < 0.1


def test_edge_cases(spark, frame, prose, clashing):
    long = prose(3000, 1)
    rows = [(4, None), (9, ""), (11, "One two"), (2, prose(40, 2).upper()), (5, long), (6, long), (6, "other text of the id"),
            (7, long[:9000]), (None, "no id at all here"), (30, "É" * 50 + " 🙂 \t\n x"), (31, prose(30, 3)), (31, prose(30, 3)),
            (-5, " \n ")]
    df = frame(rows)
    assert mine(df) == brute(spark, rows)
    assert mine(clashing(df).selectExpr("*", "1 AS key", "2 AS head", "3 AS sketch")) == brute(spark, rows)
    one = frame([(1, prose(20, 4))])
    assert [r["near_next"] for r in P.fingerprints(one).collect()] == [1.0]
    assert P.fingerprints(frame([]).where("false")).collect() == []


def test_containment_of_very_unequal_texts_and_merging(spark, prose):
    long = prose(20000, 7)
    part = " ".join(long.split(" ")[4000:4600])
    df = spark.createDataFrame([(part, long, prose(500, 8))], "part string, whole string, other string")
    a, b, c = (P.sketch(F.col(x)) for x in ("part", "whole", "other"))
    r = df.select(P.containment(a, b).alias("into"), P.containment(b, a).alias("back"), P.resemblance(a, b).alias("same"),
                  P.containment(c, b).alias("none"), (P.from_text(P.as_text(b)) == b).alias("trip"),
                  (P.merge(a, b) == b).alias("within")).first()
    assert r["into"] == 1.0 and abs(r["back"] - 0.03) < 0.02 and abs(r["same"] - 0.03) < 0.02 and r["none"] == 0.0
    assert r["trip"] and r["within"]
    # merging sketches of both halves of a set of shingles gives the sketch of the set
    left, right = F.array(*[F.lit(x) for x in range(0, 1 << 62, 1 << 56)]), F.array(*[F.lit(x) for x in range(5, 1 << 62, 1 << 55)])
    s = spark.range(1).select((P.merge(P._retained(left), P._retained(right)) == P._retained(F.concat(left, right))).alias("x"))
    assert s.first()["x"]
