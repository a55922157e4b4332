import json
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexis.llm import token_count, url_filter


def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_count.default_path())


def test_counts_equal_the_library(documents, frame):
    t = _tokenizer()
    rows = documents.select("doc_id", "text").collect()
    odd = [(9001, None), (9002, ""), (9003, "<|endoftext|> a<|endoftext|>"), (9004, " \n  x\u00a0 y\t\tz  "), (9005, "it's 5'6\" 'll"),
           (9006, ("word two's  three\n" * 9000) + "<|endoftext|> end"), (9007, "x" * 200000), (None, "no id"), (9003, "again")]
    df = documents.select("doc_id", "text", "lang", "source", "n_chars").union(frame(odd))
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_count.count_tokens(df).collect())
    want = Counter()
    for i, x in [(r.doc_id, r.text) for r in rows] + odd:
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        want[(i, len((x or "").encode()), n, n > 1024)] += 1
    assert got == want


def test_pieces_are_safe():
    t = _tokenizer()
    text = "a  b c\u3000 d e <|endoftext|> f \u2003g 12 34 don't  stop\n\n now " * 40
    cut = token_count.pieces(text, 7)
    assert "".join(cut) == text and len(cut) > 50
    count = lambda x: len(t.encode(x, add_special_tokens=False).ids)
    assert sum(map(count, cut)) == count(text)
    assert token_count.pieces("x" * 100, 7) == ["x" * 100]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies(frame, name):
    import public_tokenizers

    rows = [(1, "Some words, twice. Some words, twice."), (2, None)]
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(frame(rows), public_tokenizers.path(name)).collect()}
    assert got[1] > 5 and got[2] == 0


def test_token_cases(frame, clashing):
    df = clashing(frame([(1, "a b"), (1, "a b")]))
    assert [r.n_tokens for r in token_count.count_tokens(df).collect()] == [2, 2]
    assert token_count.count_tokens(df.limit(0)).count() == 0


def _brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        tail = rest[end:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for rule, verdict in url_filter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


URLS = ["https://a.example.net/en/1?x=1", "http://EXAMPLE.com/de/", "http://example.com/de", "http://www.example.com/de/x#y", "http://x.org/fr/",
        "http://org/fr/a", "http://xorg/fr/", "http://net", "http://net/", "http://net?/", "http://a.net#/x", "ftp://u:p@h.net:80/p?q#f",
        "no scheme net/en/", "", None, "://", "http://", "http:///net/", "x://É.NET/é?ü", "http://a.b://c.net/en/", "http://q.org?fr/"]


def test_rules_and_parts(spark):
    df = spark.createDataFrame([(i, u, "<html>") for i, u in enumerate(URLS)], "page_id bigint, url string, html string")
    for r in url_filter.judge(df).collect():
        host, path, best = _brute_url(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best[0] if best else None), URLS[r.page_id]
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")


def test_pages(spark, clashing):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = url_filter.judge(clashing(pages)).collect()
    urls = {r.page_id: r.url for r in pages.collect()}
    assert len(out) == len(urls)
    for r in out:
        host, path, best = _brute_url(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best[0] if best else None)
    assert {c: t for c, t in url_filter.judge(pages).dtypes} == {
        "page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"}


def test_trees_learn_lexical_features(spark):
    """Labelled urls with many digits and parameters are blocked; so are
    unlabelled ones like them."""
    rows = []
    for i in range(300):
        if i % 2:
            rows.append((i, f"http://spam{i}{i * 77}.bad/{i * 991}{i * 37}/{i}?a={i}&b={i * 3}&c={i}"))
        else:
            rows.append((i, f"http://good.fine/guide/chapter/{'abcdefghij'[i % 10]}"))
    rows += [(1000, "http://spam77123.else/98176123/77?a=1&b=22&c=13"), (1001, "http://calm.else/guide/chapter/d"), (1002, None), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    rules = (("bad/", "block"), ("fine/", "allow"))
    out = {r.page_id: r.verdict for r in url_filter.judge(df, rules).collect()}
    assert out[1000] == "block" and out[1001] == "allow" and out[1002] in ("allow", "block")
    only = url_filter.judge(df, (("bad/", "block"),)).collect()
    assert {r.verdict for r in only} == {"block"}
    assert {r.verdict for r in url_filter.judge(df, ()).collect()} == {"allow"}
    assert url_filter.judge(df.limit(0)).count() == 0


def test_entropy(spark):
    texts = ["aab", "", "abcd" * 5]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", url_filter._entropy(F.col("t")).alias("e"))
    for r in df.collect():
        n = Counter(r.t)
        want = -sum(c / len(r.t) * math.log2(c / len(r.t)) for c in n.values()) if r.t else 0.0
        assert math.isclose(r.e, want, abs_tol=1e-9)


def test_vocabulary_has_no_space_inside_a_special_token():
    made = json.load(open(token_count.default_path()))
    assert all(" " not in t["content"] and not t["lstrip"] and not t["rstrip"] for t in made["added_tokens"])
