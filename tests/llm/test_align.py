import hashlib
import json
import random
from collections import Counter

import pytest

from lexis.llm import align as A

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = A.default_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def symbols():
    """The printable form of every byte, by the published rule."""
    shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    out, extra = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def groups_of(text, encoders):
    """Groups as lists of ids, token by token with the libraries themselves."""
    a, b = encoders
    if not text:
        return []
    byte = symbols()
    ia = a.encode(" " + text, add_special_tokens=False).ids
    ib = b.encode(text)
    ba = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
    bb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ib for p in [b.id_to_piece(i)]]
    if not b"".join(ba) == b"".join(bb) == (" " + text).encode():
        return []
    ends_a, ends_b, n = [], [], 0
    for x in ba:
        n += len(x)
        ends_a.append(n)
    n = 0
    for x in bb:
        n += len(x)
        ends_b.append(n)
    out, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(cut) + 1, ends_b.index(cut) + 1
        out.append((ia[i:k], ib[j:m]))
        i, j = k, m
    return out


def brute(rows, encoders):
    per = [(i, groups_of(t, encoders)) for i, t in rows]
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for _, g in per]
    count = Counter(p for c in links for p in c)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (i, g), c in zip(per, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def mine(df, **kw):
    return sorted((tuple(r) for r in A.alignments(df, **kw).collect()), key=str)


ODD = [None, "", " ", "\n", "a", "  two  spaces  ", "tab\tand\r\nline", "<|endoftext|> <s> </s> <unk>", "U+2581 ▁ here", "▁", "é à ü ß",
       "🙂🙃 👩‍👩‍👧‍👦 ok", "日本語のテキスト と かな", "x" * 5000, "=" * 700 + " " + "-" * 301, "ﬁ ligature ½ Ⅷ", "a b c", "\x00\x01 \x7f",
       "don't we'll I'd", "1234567890 " * 30, " lead", "trail ", "Ünïcödé " * 400, "word́ combining", "﻿bom", "a  b " * 600]


def test_equals_brute_force_on_the_tables(spark, documents, encoders):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert mine(documents) == brute(rows, encoders)


def test_odd_texts(spark, frame, clashing, encoders):
    rnd = random.Random(3)
    rows = list(enumerate(ODD)) + [(3, "twice the same id"), (3, "twice the same id"), (None, "no id")]
    rows += [(100 + i, "".join(rnd.choice("ab é\n.,1ß日🙂 '") for _ in range(rnd.randint(1, 400)))) for i in range(60)]
    df = frame(rows)
    want = brute(rows, encoders)
    assert mine(df) == want
    assert mine(clashing(df).selectExpr("*", "1 AS row", "2 AS pairs", "3 AS times")) == want
    # few pairs broadcast, the others joined by shuffle; and none
    assert mine(df, limit=20) == want
    assert mine(df, limit=0) == want
    assert mine(frame([]).where("false")) == []


def test_lanes_and_small_chunks_change_nothing(monkeypatch, encoders, prose):
    texts = [prose(900, 1), None, ODD[13], prose(3, 2), "a" * 3000 + " " + "é" * 2000, *ODD, "word " * 3000, "É. " * 900]
    paths = A.default_paths()

    def result(split):
        return [(*r[:5], dict(zip(r[5].tolist(), r[6].tolist()))) for r in A.merge(texts, paths, split)]

    whole = result(False)
    monkeypatch.setattr(A, "LANE", 16)
    assert result(True) == whole
    monkeypatch.setattr(A, "EXPAND", 50)
    monkeypatch.setattr(A, "WIDE_GROUP", 6)
    assert result(True) == whole
    for text, r in zip(texts, whole):
        g = groups_of(text, encoders)
        assert r[2] == len(g) and r[5] == Counter(x * 32000 + y for ga, gb in g for x in ga for y in gb)


def test_both_libraries_agree_on_the_byte_level_vocabulary(documents, encoders):
    own = A.byte_level(A.default_paths()[0])
    texts = [" " + (r["text"] or "") for r in documents.select("text").collect()] + [t for t in ODD if t]
    assert own.encode(texts) == [encoders[0].encode(t, add_special_tokens=False).ids for t in texts]


def test_vocabulary_that_is_not_in_order(tmp_path):
    """A file whose ids are no ranks goes to its own library."""
    facts = json.load(open(A.default_paths()[0], encoding="utf-8"))
    assert A._merges_in_order(facts["model"])
    facts["model"]["merges"] = facts["model"]["merges"][1:]
    assert not A._merges_in_order(facts["model"])
