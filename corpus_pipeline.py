"""From raw documents to packed training sequences, a stage at a time over settled tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import near_dedup, packing, quality_classifier, quality_rules
from millrace.llm.common import settle, table


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.kept_documents(docs, table(spark, sf_dir, "labels"))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or are outliers go."""
    return quality_rules.kept_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.kept_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier_stage),
    ("quality rules", quality_rules_stage),
    ("near dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: Trained models and robust estimates have no SQL form; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
