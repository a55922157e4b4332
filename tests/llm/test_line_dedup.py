import hashlib

import duckdb

from lexis.llm import line_dedup

SF = "/root/testdata/sf0.001"
LONG = "This passage is shared by many documents and long enough"


def _brute(rows):
    lines = {i: (t or "").split("\n") for i, t in rows}
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, ls in lines.items():
        for x in ls:
            if len(key(x)) >= 40:
                holders.setdefault(key(x), set()).add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    out = {}
    for i, ls in lines.items():
        kept = [x for x in ls if gone.get(key(x), i) == i]
        out[i] = (len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_against_brute_force(frame):
    rows = [(i, f"own line {i}\n  {LONG.upper() if i % 2 else LONG}\t\n{LONG}\nend") for i in range(7)]
    rows += [(20, None), (21, ""), (22, "\n\n"), (23, LONG + " É" + "\n" + LONG + " é"), (24, (LONG + "\n") * 200)]
    rows += [(30 + i, LONG + " four only") for i in range(4)]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.line_digest(frame(rows)).collect()}
    assert got == _brute(rows)
    maps = {r.doc: r for r in line_dedup.keep_bitmaps(frame(rows)).collect()}
    assert set(maps) == set(range(7))
    assert [(w.word, w.mask) for w in maps[0].keep] == [(0, ~0b110)]


def test_same_as_sql(spark, documents):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(tuple(r) for r in con.sql(line_dedup.ORACLE).fetchall())
    assert sorted(tuple(r) for r in line_dedup.line_digest(documents).collect()) == want


def test_defined_cases(frame, clashing):
    rows = [(i, f"{LONG}\nown {i}") for i in range(5)] + [(None, LONG), (None, LONG), (4, f"{LONG}\nown 4"), (3, f"x\n{LONG}")]
    df = clashing(frame(rows))
    out = line_dedup.line_digest(df).collect()
    assert len(out) == len(rows)
    assert all(r.n_dropped == 0 for r in out if r.doc_id in (None, 4))
    assert sorted(r.n_dropped for r in out if r.doc_id == 3) == [1, 1]
    kept = line_dedup.drop_lines(df)
    assert kept.columns == df.columns
    texts = {(r.doc_id, r.text, r.n_chars) for r in kept.collect()}
    assert (0, "own 0", 5) in texts and (3, "x", 1) in texts and (4, f"{LONG}\nown 4", len(LONG) + 6) in texts
    assert line_dedup.line_digest(df.limit(0)).count() == 0
