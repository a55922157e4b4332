"""URL filters (operator 7): rules first, boosted trees for the rest.

A rule names a host (and with it all subdomains) and a path prefix; the longest
rule that fits decides.  Urls that a rule decides are the labelled urls from
which gradient-boosted trees learn; the trees judge the urls no rule fits, by
lexical features: lengths, depth, digit ratio, entropy, parameter counts and
statistics of the suffix.  How often a suffix is blocked is no feature, because
the rules that label the urls name suffixes themselves.

Scale: features are column expressions over the url alone (pages aren't
read); suffix counts are aggregated map-side and joined back with a plain join.
The trees are fitted on a bounded sample of distinct labelled urls (SAMPLE, by
hash); every url is judged.

Defined cases: a null url, or one without ``://``, has empty host and path, fits
no rule and is judged by its (empty) features.  Without labelled urls of both
verdicts the method gives the only verdict seen (allow if none).  Repeated rows
are judged alike.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import ascii_lower
from lexis.session import written

# Rules in force: (host and path prefix, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
SAMPLE = 20_000
TREES, DEPTH, STEP, SEED = 20, 4, 0.2, 7
FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "longest_label", "digit_ratio", "hyphens",
            "entropy", "params", "query_length", "suffix_length", "suffix_share", "domain_share")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # later ones win
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.size(chars).cast("double")
    parts = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
    return F.aggregate(parts, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))


def lexical(rows: DataFrame) -> DataFrame:
    """The features of (url, host, path) rows."""
    url = F.coalesce("url", F.lit(""))
    labels = F.split("host", r"\.")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    rows = rows.withColumn("_suffix", F.element_at(labels, -1)) \
        .withColumn("_domain", F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), "."))
    # made in the tasks that read the urls, so that the joins move numbers only
    rows = rows.withColumns({
        "url_length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": F.regexp_count("path", F.lit("/")), "labels": F.size(labels),
        "longest_label": F.array_max(F.transform(labels, lambda x: F.length(x))),
        "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)),
        "hyphens": F.regexp_count("host", F.lit("-")), "entropy": _entropy(url),
        "params": F.regexp_count(query, F.lit("[^&]+")), "query_length": F.length(query),
        "suffix_length": F.length("_suffix"),
    })
    total = F.lit(float(max(1, rows.count())))
    for key in ("_suffix", "_domain"):
        counts = rows.groupBy(key).agg((F.count(F.lit(1)) / total).alias(key[1:] + "_share"))
        rows = rows.join(counts, key)
    return rows.drop("_suffix", "_domain")


def judge(pages: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict."""
    url = F.col("url").cast("string")
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", url.alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = lexical(rows.withColumn("rule", rule).withColumn("ruled", verdict))
    numbers = [F.col(c).cast("double").alias(c) for c in FEATURES]
    rows = written(rows.select("page_id", "url", "host", "path", "rule", "ruled", *numbers), "urls")

    train = rows.where("ruled is not null").dropDuplicates(["url"]).orderBy(F.xxhash64("url")).limit(sample)
    train = written(train.select((F.col("ruled") == "block").cast("double").alias("label"), *FEATURES), "url-sample")
    seen = [r[0] for r in train.groupBy("label").count().orderBy("label").collect()]
    if len(seen) < 2:
        method = F.lit("block" if seen == [1.0] else "allow")
        return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"))
    gather = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, predictionCol="_block")
    model = trees.fit(gather.transform(train).select("label", "features"))
    out = model.transform(gather.transform(rows))
    method = F.when(F.col("_block") == 1.0, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"))
