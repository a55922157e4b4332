"""The queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from lexis.llm import (align, chat, decontaminate, fingerprint, line_dedup, manifest, mixing, near_dup, neighbours, quality,
                       token_count, toxicity, url_filter)
from lexis.llm.common import read

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_quality_classifier")
def quality_classifier(spark, sf_dir):
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op2_mixing", mixing.oracle())
def mixing_weights(spark, sf_dir):
    return mixing.mixture(read(spark, sf_dir, "documents"))


@query("op3_minhash_near_dedup")
def near_dedup(spark, sf_dir):
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"))


@query("op4_line_dedup", line_dedup.ORACLE)
def line_dedup_digest(spark, sf_dir):
    return line_dedup.line_digest(read(spark, sf_dir, "documents"))


@query("op5_token_counts")
def token_counts(spark, sf_dir):
    return token_count.count_tokens(read(spark, sf_dir, "documents"))


@query("op6_decontamination")
def decontamination(spark, sf_dir):
    return decontaminate.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op7_url_filter")
def url_verdicts(spark, sf_dir):
    return url_filter.judge(read(spark, sf_dir, "pages"))


@query("op8_toxicity")
def toxicity_scores(spark, sf_dir):
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op9_nearest_neighbours")
def nearest_neighbours(spark, sf_dir):
    return neighbours.search(read(spark, sf_dir, "embeddings"))


@query("op10_chat_formatting", chat.ORACLE)
def chat_formatting(spark, sf_dir):
    return chat.format_conversations(read(spark, sf_dir, "conversations"))


@query("op11_document_fingerprints")
def document_fingerprints(spark, sf_dir):
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


@query("op12_merkle_manifest", manifest.ORACLE)
def merkle_manifest(spark, sf_dir):
    return manifest.manifest(read(spark, sf_dir, "documents"))


@query("op13_tokenizer_alignment")
def tokenizer_alignment(spark, sf_dir):
    return align.alignments(read(spark, sf_dir, "documents"))
