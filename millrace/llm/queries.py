"""The corpus operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    bpe,
    hnsw,
    licenses,
    near_dedup,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    quotations,
    spelling,
    url_filter,
    warc,
    wavelet,
)
from millrace.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op4_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.quality_scores(documents, labels)


def op6_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.reply_ordered(table(spark, sf_dir, "conversations"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_passages(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"))


def op13_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_archive(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    run.__name__: run
    for run in (
        op1_quality_rules,
        op2_near_dedup,
        op3_url_filter,
        op4_hnsw,
        op5_quality_classifier,
        op6_quotations,
        op7_warc,
        op8_licenses,
        op9_bpe,
        op10_packing,
        op11_spelling,
        op12_periodic_runs,
        op13_wavelet,
    )
}
SQL: dict[str, str] = {"op8_licenses": licenses.LICENSE_SQL}
