"""Column -> Column text functions.

Everything here is a plain Spark SQL expression (``regexp_replace``,
``lower``, ``split`` ...), so it stays inside whole-stage codegen, needs no
Python worker and works unchanged on streaming DataFrames.

Java regexes treat ``\\w``/``\\s`` as ASCII unless ``(?U)`` is given; the
character classes below are written out so that they mean the same as
Python's Unicode ``\\w``/``\\s`` (and so that the DuckDB oracle can use the
very same classes).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Word characters of Python's Unicode ``\w``: letters, numbers, underscore.
WORD = r"\p{L}\p{N}_"
# Whitespace of Python's Unicode ``\s`` (str.isspace): Java's Unicode
# ``\s`` (patterns below carry the (?U) flag) plus the separators \x1c-\x1f.
SPACE = r"\s\x1C-\x1F"
# Stage-1 cleaning patterns, applied in this order.
URL_PATTERN = "(?iU)https?://[^" + SPACE + "]+|www\\.[^" + SPACE + "]+"
WWW_PATTERN = r"[wW][wW][wW]\."  # no other letter has the case of w
MENTION_PATTERN = "@[" + WORD + "]+"
HASHTAG_PATTERN = "#[" + WORD + "]+"
NON_LETTER_PATTERN = "(?U)[^a-z" + SPACE + "]"
MULTISPACE_PATTERN = "(?U)[" + SPACE + "]+"
# Contractions and what they stand for; order matters, since "n't" alone
# would also match inside the two irregular ones.
CONTRACTIONS = (
    ("won't", "will not"),
    ("can't", "can not"),
    ("n't", " not"),
    ("'re", " are"),
    ("'s", " is"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'ve", " have"),
    ("'m", " am"),
)
# Emoji code points (the Emoji property of the public Unicode emoji data, without
# digits, # and *), as ranges in code point order.
EMOJI_RANGES = """
00A9 00AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0
25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653
265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE
26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716
271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07
2B1B-2B1C 2B50 2B55 3030 303D 3297 3299
1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F1E6-1F1FF 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251
1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E
1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC
1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6D7
1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA70-1FA7C
1FA80-1FA89 1FA8F-1FAC6 1FACE-1FADC 1FADF-1FAE9 1FAF0-1FAF8
""".split()
_EMOJI = "[" + "".join("-".join(f"\\x{{{x}}}" for x in r.split("-")) for r in EMOJI_RANGES) + "]"
# What may follow an emoji and belongs to it: a selector, a skin tone, tags.
_AFTER_EMOJI = r"[\x{FE0E}\x{FE0F}\x{1F3FB}-\x{1F3FF}\x{E0020}-\x{E007F}\x{20E3}]*"
# Keycaps first (so that the ASCII base goes with its cap), then sequences of
# emoji glued by joiners; a joiner or selector alone is no emoji and stays.
KEYCAP_PATTERN = r"[#*0-9]\x{FE0F}?\x{20E3}"
EMOJI_PATTERN = KEYCAP_PATTERN + "|" + _EMOJI + _AFTER_EMOJI + r"(?:\x{200D}" + _EMOJI + _AFTER_EMOJI + ")*"
NON_ASCII_PATTERN = r"[^\x{0}-\x{7F}]"
# The only characters outside A-Z whose lower case contains an ASCII letter:
# capital I with dot above (-> "i" + combining dot) and the Kelvin sign (-> "k").
LOWERS_TO_ASCII = "\u0130\u212a"
# Characters that can still matter after lower-casing (see clean_text).
PRE_LOWER_PATTERN = "(?U)[^A-Za-z" + LOWERS_TO_ASCII + SPACE + "]"
SLUG_PATTERN = "[^a-z0-9]+"


def coalesce_text(c: Column) -> Column:
    """Null -> '' and cast to string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip_urls(c: Column, repl: str = " ") -> Column:
    """URLs (http(s)://... or www....) -> space."""
    return F.regexp_replace(c, URL_PATTERN, repl)


def strip_mentions(c: Column, repl: str = " ") -> Column:
    """@mentions -> space."""
    return F.regexp_replace(c, MENTION_PATTERN, repl)


def strip_hashtags(c: Column, repl: str = " ") -> Column:
    """whole #hashtags -> space."""
    return F.regexp_replace(c, HASHTAG_PATTERN, repl)


def letters_only(c: Column, runs: bool = False) -> Column:
    """every char that is not a-z or whitespace -> space (case-sensitive).
    ``runs=True`` replaces a whole run by one space (the same text once
    whitespace is collapsed or split, with far fewer replacements)."""
    return F.regexp_replace(c, NON_LETTER_PATTERN + ("+" if runs else ""), " ")


def collapse_space(c: Column) -> Column:
    """collapse whitespace runs to one space and trim."""
    return F.trim(F.regexp_replace(c, MULTISPACE_PATTERN, " "))


def clean_text(c: Column) -> Column:
    """stage-1 cleaning (null -> '', URLs, mentions, hashtags, lower,
    non-letters, whitespace).  One nested expression, no UDF.

    ``letters_only(lower(x))`` is computed as
    ``letters_only(lower(blank(x)))`` where ``blank`` first turns every
    character that cannot lower-case to a-z or whitespace into a space:
    the result is the same after whitespace collapsing, and ``lower`` then
    runs on (almost) pure ASCII, Spark's fast path."""
    text = coalesce_text(c)
    # a pattern that needs a character is tried only on texts that hold it
    out = F.when(text.contains("://") | text.rlike(WWW_PATTERN), strip_urls(text)).otherwise(text)
    out = F.when(text.contains("@"), strip_mentions(out)).otherwise(out)
    out = F.when(text.contains("#"), strip_hashtags(out)).otherwise(out)
    out = F.lower(F.regexp_replace(out, PRE_LOWER_PATTERN + "+", " "))
    # of what is left only the dotted capital I has a lower case beyond a-z
    out = F.when(text.contains(LOWERS_TO_ASCII[0]), letters_only(out, runs=True)).otherwise(out)
    return collapse_space(out)


def expand_contractions(c: Column) -> Column:
    """F8: ordered, case-insensitive contraction expansion (no word boundary)."""
    return reduce(
        lambda acc, rule: F.regexp_replace(acc, "(?i)" + rule[0], rule[1]),
        CONTRACTIONS,
        c,
    )


def strip_emoji(c: Column) -> Column:
    """remove emoji and the joiners, selectors and tones inside them."""
    return F.regexp_replace(c, EMOJI_PATTERN, "")


def ascii_only(c: Column) -> Column:
    """delete non-ASCII code points (no space left behind)."""
    return F.regexp_replace(c, NON_ASCII_PATTERN, "")


def normalize_prefix(c: Column, runs: bool = False) -> Column:
    """The character-level part of full normalisation, before tokenising:
    lower -> contractions -> emoji -> ASCII -> letters only.

    Lower-casing is moved after the ASCII step (same result, fast ASCII
    path): the contraction patterns are case-insensitive and contain
    neither i nor k, emoji have no case, and the two characters whose lower
    case is ASCII (dotted capital I, Kelvin sign) are mapped to i and k
    before non-ASCII characters are deleted.  Of the emoji step only the
    keycap part can change the result (every other emoji is non-ASCII and
    is deleted next), so only keycaps are matched here.  ``runs=True`` for
    callers that split on whitespace afterwards (see ``letters_only``)."""
    out = coalesce_text(c)
    out = F.regexp_replace(expand_contractions(out), KEYCAP_PATTERN, "")
    out = ascii_only(F.translate(out, LOWERS_TO_ASCII, "ik"))
    return letters_only(F.lower(out), runs=runs)


def whitespace_tokens(c: Column) -> Column:
    """F11 (wide form): split on whitespace runs, empty tokens dropped."""
    return F.filter(F.split(c, MULTISPACE_PATTERN), lambda t: t != "")


def char_count(c: Column) -> Column:
    """length in code points; null counts as 0."""
    return F.length(coalesce_text(c))


def word_count(c: Column) -> Column:
    """number of whitespace-separated words; '' -> 0."""
    return F.size(whitespace_tokens(coalesce_text(c)))


def slugify(c: Column) -> Column:
    """lower-case, runs of non-alphanumerics -> '_', strip '_'."""
    return F.trim(F.regexp_replace(F.lower(c), SLUG_PATTERN, "_"), F.lit("_"))


def percent_label(c: Column) -> Column:
    """fraction -> 'xx.xx%', rounded like Python's ``%.2f``: to the nearest
    by the double's exact value, ties to even.

    200 * y is kept as two exact products of halves of y's digits, so that the
    sign of its distance to a tie (an odd number) is exact."""
    y = F.abs(c.cast("double") * F.lit(100.0))
    high = y.cast("float").cast("double")
    low = y - high
    base = F.floor(y * 100)
    over = (high * 200 - (base * 2 + 1)) + low * 200  # sign of y's distance to the tie above base
    under = (high * 200 - (base * 2 - 1)) + low * 200  # and to the tie below
    n = base + F.when(over > 0, 1).when(over == 0, base % 2).when(under < 0, -1).when(under == 0, -(base % 2)).otherwise(0)
    digits = F.concat((n / 100).cast("bigint").cast("string"), F.lit("."),
                      F.lpad((n % 100).cast("string"), 2, "0"), F.lit("%"))
    return F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), digits)


def argmax(c: Column) -> Column:
    """0-based index of the first maximum of a numeric array."""
    return F.array_position(c, F.array_max(c)) - F.lit(1)
