"""The corpus pipeline: five stages over ``documents``, each written as
Parquet and read again as the next one's input."""

from __future__ import annotations

from lexis.llm import decontaminate, line_dedup, mixing, near_dup, quality
from lexis.llm.common import read
from lexis.session import written


def good_quality(spark, docs, sf_dir):
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def unique_lines(spark, docs, sf_dir):
    """Documents without the long lines that others keep."""
    return line_dedup.drop_lines(docs)


def unique_documents(spark, docs, sf_dir):
    """One document of every group of near copies."""
    return near_dup.drop_near_duplicates(docs)


def uncontaminated(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark, docs, sf_dir):
    """A sample whose sources, languages and topics have the target shares."""
    return mixing.sample_mixture(docs)


STAGES = [
    ("quality", good_quality),
    ("line_dedup", unique_lines),
    ("near_dedup", unique_documents),
    ("decontamination", uncontaminated),
    ("mixing", mixture),
]

# The quality classifier and the MinHash components have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order, from ``documents`` to the sampled mixture."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
