"""English Porter2 ("Snowball English") stems as column expressions.

Written from the published algorithm.  Each step maps an array of small structs
(word, region starts) to the next one with ``transform``; a lambda variable is a
value, not an expression, so the steps do not blow up into one another and no
Python worker is needed.  ``stem_word`` is the same algorithm for one word, for
kernels that meet every distinct word once; a test holds both to the same stems.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values from the published algorithm
# ---------------------------------------------------------------------------
VOWEL = "[aeiouy]"
NON_VOWEL = "[^aeiouy]"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_1A = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
R1_PREFIXES = ("gener", "commun", "arsen")
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("abli", "able"), ("entli", "ent"), ("ization", "ize"), ("izer", "ize"),
    ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("aliti", "al"), ("alli", "al"),
    ("fulness", "ful"), ("ousli", "ous"), ("ousness", "ous"), ("iveness", "ive"),
    ("iviti", "ive"), ("biliti", "ble"), ("bli", "ble"), ("fulli", "ful"),
    ("lessli", "less"), ("ogi", "og"), ("li", ""),
)
STEP3 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"),
    ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""), ("ative", ""),
)
STEP4 = ("ement", "ment", "able", "ible", "ance", "ence", "ate", "iti", "ion", "ism",
         "ous", "ive", "ize", "al", "er", "ic", "ant", "ent")
FIRST_REGION = "^.*?" + VOWEL + NON_VOWEL
SHORT_SYLLABLE = "(" + NON_VOWEL + VOWEL + "[^aeiouywxY]|^" + VOWEL + NON_VOWEL + ")$"


def _cut(w: Column, n: int, tail: str = "") -> Column:
    """``w`` without its last ``n`` characters, then ``tail``."""
    kept = F.substring(w, F.lit(1), F.length(w) - n)
    return F.concat(kept, F.lit(tail)) if tail else kept


def _region(w: Column, start: Column) -> Column:
    """Start of the region after the first non-vowel that follows a vowel."""
    found = F.length(F.regexp_extract(F.substring(w, start + 1, F.length(w)), FIRST_REGION, 0))
    return F.when(found > 0, start + found).otherwise(F.length(w))


def _ends(w: Column, suffixes) -> Column:
    return reduce(lambda a, b: a | b, [w.endswith(s) for s in suffixes])


def _by_length(table):
    """Suffixes, the longest first: the first that matches is the longest."""
    return sorted(table, key=lambda r: -len(r[0] if isinstance(r, tuple) else r))


def _marked(t: Column) -> Column:
    t = F.when(t.startswith("'"), F.substring(t, F.lit(2), F.length(t))).otherwise(t)
    return F.regexp_replace(F.regexp_replace(t, "^y", "Y"), "(" + VOWEL + ")y", "$1Y")


def _prefix_region(w: Column) -> Column:
    out = _region(w, F.lit(0))
    for p in R1_PREFIXES:
        out = F.when(w.startswith(p), F.lit(len(p))).otherwise(out)
    return out


def _step_0(x):
    return F.regexp_replace(x["w"], "'s'$|'s$|'$", "")


def _step_1a(x):
    w = x["w"]
    return (F.when(w.endswith("sses"), _cut(w, 2))
            .when(_ends(w, ("ied", "ies")), F.when(F.length(w) > 4, _cut(w, 2)).otherwise(_cut(w, 1)))
            .when(_ends(w, ("us", "ss")), w)
            .when(w.endswith("s") & _cut(w, 2).rlike(VOWEL), _cut(w, 1)).otherwise(w))


def _step_1b(x):
    """Drops ed/ing endings; what must follow is left to the next step by
    the marker character '*'."""
    w, r1 = x["w"], x["r1"]

    def removed(n):
        return F.when(_cut(w, n).rlike(VOWEL), F.concat(_cut(w, n), F.lit("*"))).otherwise(w)

    out = F.when(w.endswith("eedly"), F.when(F.length(w) - 5 >= r1, _cut(w, 3)).otherwise(w))
    out = out.when(w.endswith("ingly"), removed(5)).when(w.endswith("edly"), removed(4))
    out = out.when(w.endswith("eed"), F.when(F.length(w) - 3 >= r1, _cut(w, 1)).otherwise(w))
    return out.when(w.endswith("ing"), removed(3)).when(w.endswith("ed"), removed(2)).otherwise(w)


def _step_1b_tail(x):
    m, r1 = x["w"], x["r1"]
    w = _cut(m, 1)
    fixed = (F.when(_ends(m, ("at*", "bl*", "iz*")), _cut(m, 1, "e"))
             .when(_ends(m, [d + "*" for d in DOUBLES]), _cut(m, 2))
             .when((r1 >= F.length(m) - 1) & w.rlike(SHORT_SYLLABLE), _cut(m, 1, "e")).otherwise(w))
    return F.when(m.endswith("*"), fixed).otherwise(m)


def _step_1c(x):
    w = x["w"]
    return F.when((F.length(w) > 2) & w.rlike(NON_VOWEL + "[yY]$"), _cut(w, 1, "i")).otherwise(w)


def _step_2(x):
    w, r1, out = x["w"], x["r1"], None
    for suffix, tail in _by_length(STEP2):
        fits = F.length(w) - len(suffix) >= r1
        if suffix == "ogi":
            fits = fits & w.endswith("logi")
        if suffix == "li":
            fits = fits & w.rlike("[" + LI_ENDINGS + "]li$")
        then = F.when(fits, _cut(w, len(suffix), tail)).otherwise(w)
        out = F.when(w.endswith(suffix), then) if out is None else out.when(w.endswith(suffix), then)
    return out.otherwise(w)


def _step_3(x):
    w, out = x["w"], None
    for suffix, tail in _by_length(STEP3):
        fits = F.length(w) - len(suffix) >= x["r1"]
        if suffix == "ative":
            fits = fits & (F.length(w) - len(suffix) >= x["r2"])
        then = F.when(fits, _cut(w, len(suffix), tail)).otherwise(w)
        out = F.when(w.endswith(suffix), then) if out is None else out.when(w.endswith(suffix), then)
    return out.otherwise(w)


def _step_4(x):
    w, out = x["w"], None
    for suffix in _by_length(STEP4):
        fits = F.length(w) - len(suffix) >= x["r2"]
        if suffix == "ion":
            fits = fits & w.rlike("[st]ion$")
        then = F.when(fits, _cut(w, len(suffix))).otherwise(w)
        out = F.when(w.endswith(suffix), then) if out is None else out.when(w.endswith(suffix), then)
    return out.otherwise(w)


def _step_5(x):
    w, last = x["w"], F.length(x["w"]) - 1
    drop_e = (last >= x["r2"]) | ((last >= x["r1"]) & ~_cut(w, 1).rlike(SHORT_SYLLABLE))
    drop_l = (last >= x["r2"]) & w.endswith("ll")
    return F.when((w.endswith("e") & drop_e) | (w.endswith("l") & drop_l), _cut(w, 1)).otherwise(w)


STEPS = (_step_0, _step_1a, _step_1b, _step_1b_tail, _step_1c, _step_2, _step_3, _step_4, _step_5)


def _applied(step):
    """A step as a function of the struct, idle for words that are done."""
    def apply(x):
        done = x["fixed"]
        if step is _step_1b:  # words that stop after step 1a
            done = F.when(x["w"].isin(list(AFTER_1A)), x["w"]).otherwise(done)
        return F.struct(F.when(done.isNull(), step(x)).otherwise(x["w"]).alias("w"), x["r1"].alias("r1"),
                        x["r2"].alias("r2"), done.alias("fixed"))

    return apply


def stem_tokens(tokens: Column, language: str = "english") -> Column:
    """Porter2 stems of an array of lower-case tokens."""
    if language != "english":
        raise ValueError(f"stemmer language {language!r} is not supported (english only)")
    words = list(EXCEPTIONS)

    def begin(t):
        fixed = F.lit(None).cast("string")
        for word, out in EXCEPTIONS.items():
            fixed = F.when(t == word, F.lit(out)).otherwise(fixed)
        fixed = F.when(F.length(t) <= 2, t).when(t.isin(words), fixed)
        return F.struct(_marked(t).alias("w"), fixed.alias("fixed"))

    cur = F.transform(F.transform(tokens, begin), lambda x: F.struct(
        x["w"].alias("w"), _prefix_region(x["w"]).alias("r1"), x["fixed"].alias("fixed")))
    cur = F.transform(cur, lambda x: F.struct(x["w"].alias("w"), x["r1"].alias("r1"), _region(x["w"], x["r1"]).alias("r2"),
                                              x["fixed"].alias("fixed")))
    for step in STEPS:
        cur = F.transform(cur, _applied(step))
    return F.transform(cur, lambda x: F.coalesce(x["fixed"], F.translate(x["w"], "Y", "y")))


def stem_column(c: Column, language: str = "english") -> Column:
    """F13 for one token."""
    return F.when(c.isNotNull(), stem_tokens(F.array(c), language)[0])


# ---------------------------------------------------------------------------
# the same for one word
# ---------------------------------------------------------------------------
_VOWEL, _FIRST, _SHORT = (re.compile(p) for p in (VOWEL, FIRST_REGION, SHORT_SYLLABLE))
_Y_AFTER, _LAST_Y = re.compile("(" + VOWEL + ")y"), re.compile(NON_VOWEL + "[yY]$")
_POSSESSIVE = re.compile("'s'$|'s$|'$")
_TABLE2, _TABLE3, _TABLE4 = _by_length(STEP2), _by_length(STEP3), _by_length(STEP4)


def _start_of_region(w: str, start: int) -> int:
    found = _FIRST.match(w[start:])
    return start + found.end() if found else len(w)


def _word_1a(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith(("ied", "ies")):
        return w[:-2] if len(w) > 4 else w[:-1]
    if w.endswith(("us", "ss")):
        return w
    return w[:-1] if w.endswith("s") and _VOWEL.search(w[:-2]) else w


def _word_1b(w: str, r1: int) -> str:
    for suffix, keep in (("eedly", 2), ("ingly", 0), ("edly", 0), ("eed", 2), ("ing", 0), ("ed", 0)):
        if w.endswith(suffix):
            kept = w[:len(w) - len(suffix)]
            if keep:
                return kept + "ee" if len(kept) >= r1 else w
            if not _VOWEL.search(kept):
                return w
            if kept.endswith(("at", "bl", "iz")):
                return kept + "e"
            if kept.endswith(DOUBLES):
                return kept[:-1]
            return kept + "e" if r1 >= len(kept) and _SHORT.search(kept) else kept
    return w


def _word_2(w: str, r1: int) -> str:
    for suffix, tail in _TABLE2:
        if w.endswith(suffix):
            kept = w[:len(w) - len(suffix)]
            fits = len(kept) >= r1 and (suffix != "ogi" or kept.endswith("l")) \
                and (suffix != "li" or kept.endswith(tuple(LI_ENDINGS)))
            return kept + tail if fits else w
    return w


def _word_3(w: str, r1: int, r2: int) -> str:
    for suffix, tail in _TABLE3:
        if w.endswith(suffix):
            kept = w[:len(w) - len(suffix)]
            return kept + tail if len(kept) >= r1 and (suffix != "ative" or len(kept) >= r2) else w
    return w


def _word_4(w: str, r2: int) -> str:
    for suffix in _TABLE4:
        if w.endswith(suffix):
            kept = w[:len(w) - len(suffix)]
            return kept if len(kept) >= r2 and (suffix != "ion" or kept.endswith(("s", "t"))) else w
    return w


def stem_word(t: str) -> str:
    """F13 for one lower-case word outside Spark."""
    if len(t) <= 2:
        return t
    if t in EXCEPTIONS:
        return EXCEPTIONS[t]
    w = t[1:] if t.startswith("'") else t
    if w.startswith("y"):
        w = "Y" + w[1:]
    w = _Y_AFTER.sub(r"\1Y", w)
    r1 = next((len(p) for p in R1_PREFIXES if w.startswith(p)), None)
    r1 = _start_of_region(w, 0) if r1 is None else r1
    r2 = _start_of_region(w, r1)
    w = _word_1a(_POSSESSIVE.sub("", w))
    if w in AFTER_1A:
        return w
    w = _word_1b(w, r1)
    if len(w) > 2 and _LAST_Y.search(w):
        w = w[:-1] + "i"
    w = _word_4(_word_3(_word_2(w, r1), r1, r2), r2)
    last = len(w) - 1
    if w.endswith("e") and (last >= r2 or (last >= r1 and not _SHORT.search(w[:-1]))) or w.endswith("ll") and last >= r2:
        w = w[:-1]
    return w.replace("Y", "y")
