"""Composite pipelines: the classical text-classification pipeline (M1), saved
models (S5) and scoring with them (S6).

M1: load (dedup + label codes) -> stage-1 clean -> exact stratified split ->
normalise (lexicon of the train side) -> TF-IDF fitted on train -> classifier
suite -> ranked results (+ saved models).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.functions.text import clean_text
from lexis.operators import classify as C
from lexis.operators import evaluate as EV
from lexis.operators import split as SP
from lexis.operators import tfidf as TF
from lexis.operators.tokens import normalize_text, normalize_tokens, prepared_tokens, words_of
from lexis.session import cut_lineage, written
from lexis.sources.files import load_labeled_text

# Arguments of normalize_text that also shape the lexicon.
_TOKEN_OPTIONS = ("remove_stop", "min_token_length", "stopwords")


@dataclass
class TextFeatures:
    """What turns raw texts into features, as fitted on the train side: the
    normaliser's options and lexicon, and the vocabulary with its weights."""

    vocabulary: TF.TfidfModel
    width: int
    fold: dict  # {model: slots} of models that get folded terms
    normalizer: dict | None  # None: stage-1 cleaning only
    lexicon: DataFrame | None

    def normalize(self, df: DataFrame, text_col: str, id_col: str) -> DataFrame:
        """Stage-1 clean and, if asked for, normalise ``text_col``.  A text's
        result depends on nothing but the text and the fitted lexicon."""
        df = df.withColumn(text_col, clean_text(F.col(text_col)))
        if self.normalizer is None:
            return df
        return normalize_text(df, text_col, id_col, lexicon=self.lexicon, **self.normalizer)

    def sparse(self, df: DataFrame, text_col: str, id_col: str, keep=()) -> DataFrame:
        """(id, keep..., indices, weights) of normalised texts; a text
        without known terms has empty arrays.  Rows are told apart by a number of their own,
        so ids may be null or repeated."""
        rows = written(df.select(F.monotonically_increasing_id().alias("_row"), id_col, *keep, text_col), "rows")
        tf = TF.counted_terms(rows, text_col, "_row", unique=True)
        found = TF.sparse_rows(TF.transform(tf, self.vocabulary, "_row", index=True), "_row")
        return rows.select("_row", id_col, *keep).join(found, "_row", "left").drop("_row")

    def vectors(self, rows: DataFrame, model_name: str) -> DataFrame:
        """What a model takes: sparse rows, or vectors."""
        if model_name in self.fold:
            rows = TF.folded(rows, self.input_width(model_name))
        return rows if model_name in C.SPARSE else TF.vectors(rows, self.input_width(model_name))

    def input_width(self, model_name: str) -> int:
        return min(self.width, self.fold.get(model_name, self.width))


@dataclass
class Prepared:
    train: DataFrame  # id, label_id, label, indices, weights
    test: DataFrame
    labels: list
    features: TextFeatures
    id_col: str = "doc_id"
    made: dict = field(default_factory=dict)

    def inputs(self, model_name: str) -> tuple[DataFrame, DataFrame]:
        """Train and test rows as a model takes them; models that take the
        same share them."""
        key = (model_name in C.SPARSE, self.features.fold.get(model_name))
        if key not in self.made:
            self.made[key] = (self.features.vectors(self.train.select("label", "indices", "weights"), model_name),
                              self.features.vectors(self.test, model_name))
        return self.made[key]


@dataclass
class TextModel:
    """A fitted (or loaded) classifier with all it needs to score raw texts."""

    name: str
    model: object
    features: TextFeatures
    labels: list = field(default_factory=list)


def prepare_classification(df: DataFrame, text_col: str, label_col: str, id_col: str, *,
                           test_size: float = 0.25, seed: int = 42, normalize: bool = True,
                           normalizer: dict | None = None, min_df=2e-5, max_df=0.70, use_idf: bool = True,
                           fold: int | dict | None = None, drop_duplicates: bool = True) -> Prepared:
    """Steps of M1 up to the sparse features.  ``normalizer`` holds arguments
    of ``normalize_text`` (stop words, lemmas, stems, least token length); ``fold`` the
    number of slots of models that shall get folded terms (default: none; a number: all
    but the linear and kernel machines and Naive Bayes)."""
    if isinstance(fold, int):
        fold = {name: fold for name in C.SUITE_ORDER if "Support" not in name and name != "Naive Bayes"}
    fold = dict(fold or {})
    loaded, labels = load_labeled_text(df.select(id_col, text_col, label_col), text_col, label_col,
                                       order_col=id_col, drop_duplicates=drop_duplicates,
                                       row_id=None)
    loaded = written(loaded, "loaded")
    split = SP.stratified_split(loaded, label_col, id_col, test_size=test_size, seed=seed)
    data = written(split.select(id_col, "label_id", F.col("label_id").cast("double").alias("label"), "split", text_col), "split")
    options = dict(normalizer or {}) if normalize else None
    train_side = F.col("split") == "train"
    if normalize and options.get("lemmatize", True) and options.get("lemma_table") is None:
        # tokens are written once, for the lexicon and for the texts
        tokens = prepared_tokens(data.withColumn(text_col, clean_text(F.col(text_col))), text_col,
                                 **{k: v for k, v in options.items() if k in _TOKEN_OPTIONS})
        features = TextFeatures(None, 0, fold, options, words_of(tokens.where(train_side)))
        rest = {k: v for k, v in options.items() if k not in ("lemmatize", "min_token_length")}
        normalized = normalize_tokens(tokens, text_col, lexicon=features.lexicon, **rest).select(data.columns)
    else:
        features = TextFeatures(None, 0, fold, options, None)
        normalized = features.normalize(data, text_col, id_col)
    data = written(normalized, "normalized")
    keep = ("split",)
    tf = TF.counted_terms(data, text_col, id_col, keep)
    features.vocabulary = TF.fit(tf.where(train_side), data.where(train_side).count(), min_df=min_df, max_df=max_df,
                                 use_idf=use_idf, index=True)
    features.width = features.vocabulary.size
    rows = TF.sparse_rows(TF.transform(tf, features.vocabulary, id_col, index=True), id_col)
    rows = cut_lineage(data.drop(text_col).join(rows, id_col, "left"))
    return Prepared(rows.where(train_side).drop("split"), rows.where(~train_side).drop("split"), labels, features, id_col)


def fit_and_predict(prep: Prepared, name: str, params: C.SuiteParams | None = None):
    """Fit one suite member on train, predict test.  Returns (model, preds)."""
    train, test = prep.inputs(name)
    model = C.fit_model(name, train, prep.features.input_width(name), len(prep.labels), params)
    pred = model.transform(test).select(prep.id_col, "label_id", F.col("prediction").cast("int").alias("prediction"))
    return model, pred


def run_suite(prep: Prepared, names=C.SUITE_ORDER, params: C.SuiteParams | None = None):
    """Every model in suite order -> ranked results DataFrame
    ``(model, accuracy, position, rank)`` and the fitted models.  Accuracies
    are ranked as they are, unrounded."""
    results, models = [], {}
    for name in names:
        model, pred = fit_and_predict(prep, name, params)
        acc = pred.agg(F.avg((F.col("prediction") == F.col("label_id")).cast("double"))).first()[0]
        results.append((name, float(acc)))
        models[name] = model
    return EV.rank_results(EV.results_frame(prep.train.sparkSession, results)), models


def run_pipeline(df: DataFrame, text_col: str, label_col: str, id_col: str, *, names=C.SUITE_ORDER,
                 params: C.SuiteParams | None = None, out_dir: str | None = None, **prepare) -> DataFrame:
    """M1 end to end: ranked results; models are saved under ``out_dir`` if
    given.  Further arguments go to ``prepare_classification``."""
    prep = prepare_classification(df, text_col, label_col, id_col, **prepare)
    ranked, models = run_suite(prep, names, params)
    if out_dir:
        save_models(models, prep, out_dir)
    return ranked


def model_slug(name: str) -> str:
    """Folder of a model: the rule of ``slugify`` for one name."""
    return "_".join("".join(ch if ch.isascii() and ch.isalnum() else " " for ch in name.lower()).split())


def save_models(models: dict, prep: Prepared, out_dir: str) -> dict:
    """The fitted features (vocabulary, lexicon, options, class names) and
    every model under ``out_dir``; returns {name: path}."""
    spark, f = prep.train.sparkSession, prep.features
    table = None if f.normalizer is None else f.normalizer.get("lemma_table")
    options = None if f.normalizer is None else {k: v for k, v in f.normalizer.items() if k != "lemma_table"}
    if options and options.get("stopwords") is not None:
        options["stopwords"] = sorted(options["stopwords"])
    facts = {"width": f.width, "fold": f.fold, "normalizer": options, "n_docs": f.vocabulary.n_docs,
             "use_idf": f.vocabulary.use_idf, "lexicon": f.lexicon is not None, "lemma_table": table is not None,
             "labels": prep.labels}
    f.vocabulary.vocab.write.mode("overwrite").parquet(f"{out_dir}/vocabulary")
    if f.lexicon is not None:
        f.lexicon.write.mode("overwrite").parquet(f"{out_dir}/lexicon")
    if table is not None:
        table.toDF("token", "lemma").write.mode("overwrite").parquet(f"{out_dir}/lemma_table")
    spark.createDataFrame([(json.dumps(facts),)], "facts string").write.mode("overwrite").parquet(f"{out_dir}/facts")
    paths = {}
    for name, model in models.items():
        paths[name] = f"{out_dir}/{model_slug(name)}"
        if name in C.SPARSE:
            model.save(paths[name], spark)
        else:
            from pyspark.ml import PipelineModel

            PipelineModel(stages=[model]).write().overwrite().save(paths[name])
    return paths


def load_model(spark: SparkSession, out_dir: str, name: str) -> TextModel:
    """Any model of the suite, as ``save_models`` left it."""
    facts = json.loads(spark.read.parquet(f"{out_dir}/facts").first()[0])
    options = facts["normalizer"]
    if facts["lemma_table"]:
        options["lemma_table"] = spark.read.parquet(f"{out_dir}/lemma_table")
    vocab = TF.TfidfModel(spark.read.parquet(f"{out_dir}/vocabulary"), facts["n_docs"], facts["use_idf"])
    lexicon = spark.read.parquet(f"{out_dir}/lexicon") if facts["lexicon"] else None
    features = TextFeatures(vocab, facts["width"], facts["fold"], options, lexicon)
    path = f"{out_dir}/{model_slug(name)}"
    if name in C.SPARSE:
        model = C.SPARSE[name].load(path, spark)
    else:
        from pyspark.ml import PipelineModel

        model = PipelineModel.load(path)
    return TextModel(name, model, features, facts["labels"])


def score_texts(df: DataFrame, model: TextModel, text_col: str, id_col: str) -> DataFrame:
    """Raw texts -> (id, prediction, predicted_label).  The same in a
    batch, alone, or in a micro-batch of a stream."""
    from lexis.operators.rows import decode_labels

    ready = model.features.normalize(df.select(id_col, text_col), text_col, id_col)
    rows = model.features.vectors(model.features.sparse(ready, text_col, id_col), model.name)
    out = model.model.transform(rows).select(id_col, F.col("prediction").cast("int").alias("prediction"))
    return decode_labels(out, model.labels)
