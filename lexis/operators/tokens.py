"""Token-level normalisation.

As rows, documents become ``(id, pos, token)``; as a column, an array of tokens
that is filtered and stemmed inside its row.  Only lemmas need a lookup in a
vocabulary, and only tokens that a rule could shorten take part in it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.functions.stem import stem_tokens, stem_word
from lexis.functions.stopwords import EXTRA_STOPWORDS, STANDARD_STOPWORDS
from lexis.functions.text import MULTISPACE_PATTERN, normalize_prefix
from lexis.operators.rows import require_columns
from lexis.session import cut_lineage, ship_package, written

MAX_BROADCAST_WORDS = 100_000
MAX_STEMS = 1 << 20  # stems a Python worker remembers
# A text of these characters only is its own ``normalize_prefix``.
NOT_PLAIN_PATTERN = "[^a-z ]"
# Fixed values.
# Noun suffix-detachment rules (WordNet morphology), in rule order.
NOUN_RULES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


def stopword_list(extra=EXTRA_STOPWORDS, base=None) -> list[str]:
    """Union (distinct) of the standard list and the extra words."""
    words = set(STANDARD_STOPWORDS if base is None else base) | set(extra)
    return sorted(words)


def stopwords_frame(spark: SparkSession, words=None) -> DataFrame:
    words = stopword_list() if words is None else sorted(set(words))
    return spark.createDataFrame([(w,) for w in words], "token string")


def tokenize(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """whitespace tokens in long form ``(id, pos, token)``; empty tokens
    dropped, ``pos`` is the position in the split text."""
    require_columns(df, text_col, id_col)
    return (
        df.select(F.col(id_col), F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")),
                                                      MULTISPACE_PATTERN)).alias("pos", "token"))
        .where(F.col("token") != "")
    )


def min_length(tokens: DataFrame, n: int = 2) -> DataFrame:
    """Keep tokens of at least ``n`` characters."""
    return tokens.where(F.length("token") >= n)


def remove_stopwords(tokens: DataFrame, words=None) -> DataFrame:
    """Anti join against the stop words (a broadcast up to
    MAX_BROADCAST_WORDS of them, else by shuffle)."""
    words = stopword_list() if words is None else sorted(set(words))
    stop = stopwords_frame(tokens.sparkSession, words)
    return tokens.join(F.broadcast(stop) if len(words) <= MAX_BROADCAST_WORDS else stop, "token", "left_anti")


def lemma_rules(vocab: DataFrame, lexicon: DataFrame | None = None,
                word_col: str = "token") -> DataFrame:
    """F12 (rules): noun lemma of each distinct token: among the token itself
    and its suffix-rule candidates, those present in ``lexicon`` (default:
    the vocabulary itself); the shortest wins, ties in rule order; a token
    with no candidate is its own lemma.  Returns ``(token, lemma)``."""
    vocab = vocab.select(F.col(word_col).alias("token")).distinct()
    lex = vocab if lexicon is None else lexicon
    lex = lex.select(F.col(lex.columns[0]).alias("_word")).distinct()
    t = F.col("token")
    cands = [F.struct(F.lit(-1).alias("rule"), t.alias("cand"))]
    for i, (suf, repl) in enumerate(NOUN_RULES):
        stemmed = F.concat(F.expr(f"substring(token, 1, length(token) - {len(suf)})"), F.lit(repl))
        cands.append(F.struct(F.lit(i).alias("rule"),
                              F.when(t.endswith(suf), stemmed).alias("cand")))
    exploded = vocab.select("token", F.explode(F.array(*cands)).alias("c")).select(
        "token", "c.rule", "c.cand").where(F.col("cand").isNotNull())
    found = exploded.join(lex.withColumnRenamed("_word", "cand"), "cand")
    best = found.groupBy("token").agg(
        F.min(F.struct(F.length("cand").alias("n"), F.col("rule"), F.col("cand"))).alias("b"))
    return vocab.join(best, "token", "left").select(
        "token", F.coalesce(F.col("b.cand"), F.col("token")).alias("lemma"))


def apply_lookup(tokens: DataFrame, table: DataFrame, key: str = "token",
                 value: str = "lemma") -> DataFrame:
    """Replace each token by its looked-up value, identity on a miss; of
    several values of a token the smallest counts.  Only values that differ take part
    in the join (a broadcast up to MAX_BROADCAST_WORDS of them, else by shuffle)."""
    m = table.groupBy(F.col(key).alias("token")).agg(F.min(value).alias("_v")).where("_v <> token")
    m = written(m, "lookup")
    joined = tokens.join(F.broadcast(m) if m.count() <= MAX_BROADCAST_WORDS else m, "token", "left")
    return joined.withColumn("token", F.coalesce(F.col("_v"), F.col("token"))).drop("_v")


def token_array(c: Column, *, remove_stop: bool = True, min_token_length: int = 2, stopwords=None) -> Column:
    """The prepared tokens of a text: lower -> contractions -> emoji -> ASCII ->
    letters -> tokens -> min length -> stop words.  What stage-1 cleaning left is split as it is."""
    plain = F.coalesce(~c.rlike(NOT_PLAIN_PATTERN), F.lit(False))
    toks = F.when(plain, F.split(c, " ")).otherwise(F.split(normalize_prefix(c, runs=True), MULTISPACE_PATTERN))
    toks = F.filter(toks, lambda t: F.length(t) >= max(1, min_token_length))
    return without_stopwords(toks, stopwords) if remove_stop else toks


def without_stopwords(toks: Column, stopwords=None) -> Column:
    words = stopword_list() if stopwords is None else sorted(set(stopwords))
    return F.filter(toks, lambda t: ~t.isin(words)) if words else toks


def fit_lexicon(df: DataFrame, text_col: str, **options) -> DataFrame:
    """The words lemmas are looked up in: distinct prepared tokens of ``df``,
    kept with a model so that every later text is normalised alike."""
    return words_of(df.select(token_array(F.col(text_col), **options).alias("_tokens")))


def words_of(rows: DataFrame) -> DataFrame:
    """The distinct words of rows with ``_tokens``, as ``fit_lexicon`` gives them."""
    return cut_lineage(rows.select(F.explode("_tokens").alias("token")).distinct())


def prepared_tokens(df: DataFrame, text_col: str, **options) -> DataFrame:
    """``df`` with ``_tokens`` instead of ``text_col`` and a number ``_row`` of each row, written: it is read
    for its words and for what becomes of them."""
    rows = df.withColumn("_tokens", token_array(F.col(text_col), **options)).drop(text_col)
    return written(rows.withColumn("_row", F.monotonically_increasing_id()), "tokens")


def _lemma_maps(rows: DataFrame, id_col: str, lemma_table: DataFrame | None, lexicon: DataFrame | None) -> DataFrame:
    """(id, _lemmas): per row the map of its tokens that have another lemma.
    Only tokens that a rule could shorten leave their rows."""
    words = F.array_distinct("_tokens")
    if lemma_table is None:
        words = F.filter(words, lambda t: reduce(or_, [t.endswith(suffix) for suffix, _ in NOUN_RULES]))
    wanted = rows.select(id_col, F.explode(words).alias("token"))
    if lemma_table is None:
        lemma_table = lemma_rules(wanted, rows.select(F.explode("_tokens").alias("token")) if lexicon is None else lexicon)
    lemma_table = lemma_table.toDF("token", "lemma").groupBy("token").agg(F.min("lemma").alias("lemma")).where("lemma <> token")
    return wanted.join(lemma_table, "token").groupBy(id_col).agg(
        F.map_from_entries(F.collect_set(F.struct("token", "lemma"))).alias("_lemmas"))


_STEMS: dict = {}


def _stem(word: str) -> str:
    if word not in _STEMS:
        if len(_STEMS) >= MAX_STEMS:
            _STEMS.clear()
        _STEMS[word] = stem_word(word)
    return _STEMS[word]


def finished_texts(stem: bool, drop: list):
    """Kernel: lists of tokens, and of their words with another lemma and these lemmas, to texts: lemma -> stem ->
    without the words of ``drop`` and empties -> joined by spaces.  Every distinct word of a batch is met once."""
    drop = {*drop, ""}

    def run(tokens: pa.Array, words: pa.Array, lemmas: pa.Array) -> pa.Array:
        lemma = dict(zip(words.flatten().to_pylist(), lemmas.flatten().to_pylist()))
        flat = tokens.flatten().dictionary_encode()
        out = [lemma.get(w, w) for w in flat.dictionary.to_pylist()]
        if stem:
            out = [_stem(w) for w in out]
        code = flat.indices.to_numpy(zero_copy_only=False)
        kept = np.array([w not in drop for w in out], bool)[code]
        ends = np.cumsum(tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        ends = np.concatenate([[0], np.concatenate([[0], np.cumsum(kept)])[ends]]).astype(np.int32)
        left = pa.array(out, pa.string()).take(pa.array(code[kept], pa.int32()))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), left), " ")

    return run


def join_tokens(tokens: DataFrame, df: DataFrame, id_col: str, out_col: str) -> DataFrame:
    """tokens back to one space-joined string per row of ``df`` (in
    ``pos`` order); rows without tokens get ''.  Groups are single
    documents, bounded by the document's own length."""
    joined = tokens.groupBy(id_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))),
                                 lambda x: x["token"]), " ").alias("_joined"))
    return df.join(joined, id_col, "left").withColumn(
        out_col, F.coalesce(F.col("_joined"), F.lit(""))).drop("_joined")


def normalize_text(df: DataFrame, text_col: str, id_col: str, *,
                   remove_stop: bool = True, lemmatize: bool = True,
                   stem: bool = True, min_token_length: int = 2,
                   stopwords=None, lemma_table: DataFrame | None = None,
                   lexicon: DataFrame | None = None, language: str = "english") -> DataFrame:
    """Replace ``text_col`` by its normalised form: prepared tokens ->
    lemma -> stem -> stop words and empties again -> joined by spaces.

    Without lemmas everything is a column expression inside the row.  Lemmas come
    from ``lemma_table`` (token, lemma; the smallest of several), or from the noun rules over ``lexicon``
    (see ``fit_lexicon``; by default the words of ``df`` itself); stems are then made of a batch's distinct words."""
    require_columns(df, text_col, id_col)
    options = {"remove_stop": remove_stop, "min_token_length": min_token_length, "stopwords": stopwords}
    if lemmatize:
        return normalize_tokens(prepared_tokens(df, text_col, **options), text_col, remove_stop=remove_stop, stem=stem,
                                stopwords=stopwords, lemma_table=lemma_table, lexicon=lexicon,
                                language=language).select(df.columns)
    toks = F.col("_tokens")
    rows = df.withColumn("_tokens", token_array(F.col(text_col), **options)).drop(text_col)
    if stem:
        rows = rows.withColumn("_tokens", stem_tokens(toks, language))
        if remove_stop:
            rows = rows.withColumn("_tokens", without_stopwords(toks, stopwords))
    joined = F.array_join(F.filter("_tokens", lambda t: t != ""), " ")
    return rows.withColumn(text_col, joined).select(df.columns)


def normalize_tokens(rows: DataFrame, text_col: str, *, remove_stop: bool = True, stem: bool = True, stopwords=None,
                     lemma_table: DataFrame | None = None, lexicon: DataFrame | None = None,
                     language: str = "english") -> DataFrame:
    """F16 from the prepared tokens on: ``rows`` with ``_row`` (unique) and ``_tokens``, which ``text_col`` replaces."""
    if stem and language != "english":
        raise ValueError(f"stemmer language {language!r} is not supported (english only)")
    ship_package(rows.sparkSession)
    words = sorted(set(stopword_list() if stopwords is None else stopwords)) if remove_stop else []
    found = rows.join(_lemma_maps(rows, "_row", lemma_table, lexicon), "_row", "left").drop("_row")
    text = F.arrow_udf(finished_texts(stem, words), "string")
    none = F.array().cast("array<string>")
    return found.withColumn(text_col, text(F.col("_tokens"), F.coalesce(F.map_keys("_lemmas"), none),
                                           F.coalesce(F.map_values("_lemmas"), none))).drop("_tokens", "_lemmas")
