"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from lexis.plans import (feature_queries, load_queries, model_queries,  # noqa: F401
                         sequence_queries, text_queries, token_queries)
from lexis.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


FLAGSHIP_MODELS = ("Naive Bayes", "Decision Tree")


def flagship(spark, sf_dir):
    """The classical pipeline (M1) on ``documents`` labelled by ``lang``: dedup
    -> clean -> normalise -> stratified split -> TF-IDF fitted on train -> two
    models of the suite, ranked by test accuracy.  ``pipeline_ml`` runs all."""
    from lexis.plans import pipeline
    from lexis.plans.registry import table

    return pipeline.run_pipeline(table(spark, sf_dir, "documents"), "text", "lang", "doc_id", names=FLAGSHIP_MODELS)
