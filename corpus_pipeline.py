"""A training corpus from ``documents``: rules, classifier, near and substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next one's documents. All but the last return the columns of ``documents``.

Every stage keeps its operator's cases for NULLs, empty and long texts, repeated rows and
empty tables. Columns of their own, whatever their names, travel unchanged to the last
stage, which needs ``doc_id`` and ``text`` only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanewise.llm import classifier, host_rules, packing, simhash, substrings
from lanewise.llm.queries import BYTE_BPE, BYTE_RANKS, vocabulary
from lanewise.llm.tables import table
from lanewise.session import delete_folder, intermediates, materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host is not rejected."""
    return host_rules.keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score above the threshold, learned from labels of ``docs``."""
    return classifier.keep_preferred(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the smallest doc_id."""
    return simhash.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller doc_id has.

    A document that loses words keeps the rest, joined by single spaces, and its ``n_chars``
    follows; one that loses all words stays with an empty text.
    """
    return substrings.remove_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens; one row per piece of a document."""
    return packing.pack_documents(docs, vocabulary(BYTE_BPE), vocabulary(BYTE_RANKS))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

# The learned scores, the hash majorities and the tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``. What a stage wrote on its way is deleted when its
    rows are written, and those when the next stage has read them."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with intermediates(spark):
            kept = stage(spark, docs, sf_dir)
            docs = materialize(kept, f"pipeline-{name.replace(' ', '-')}", lasting=True)
        for folder in before:
            delete_folder(spark, folder)
        before = sorted({path.rsplit("/", 1)[0] for path in docs.inputFiles()})
    return docs
