"""Row filters, column masks, tag policies and share exports as frame operators."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class RowRule:
    """Members of ``group`` see the rows where ``predicate`` is true."""

    group: str
    predicate: str = "true"


@dataclass(frozen=True)
class Mask:
    """Members of ``group`` see the value, everyone else sees ``expression`` (SQL over ``value``)."""

    group: str
    expression: str


def apply_row_filter(
    df: DataFrame, rules: Sequence[RowRule], groups: Collection[str]
) -> DataFrame:
    """Rows that any rule of the caller's groups shows; a caller without one sees nothing.

    Membership is known before planning, so rules of other groups vanish from the plan and the
    remaining predicates can reach the scan.
    """
    visible = F.lit(False)
    for rule in rules:
        if rule.group in groups:
            visible = visible | F.coalesce(F.expr(rule.predicate), F.lit(False))
    return df.where(visible)


def _masked(df: DataFrame, column: str, mask: Mask, groups: Collection[str]) -> Column:
    if mask.group in groups:
        return F.col(column)
    quoted = f"`{column}`"
    shown = F.expr(mask.expression.replace("{value}", quoted))
    return shown.cast(df.schema[column].dataType).alias(column)


def apply_masks(df: DataFrame, masks: Mapping[str, Mask], groups: Collection[str]) -> DataFrame:
    return df.select(
        *[_masked(df, c, masks[c], groups) if c in masks else F.col(c) for c in df.columns]
    )


def apply_tag_policies(
    df: DataFrame,
    column_tags: Mapping[str, Collection[str]],
    policies: Mapping[str, Mask],
    groups: Collection[str],
) -> DataFrame:
    """Mask every column that carries a tag with a policy, whatever table it sits in."""
    masks = {}
    for column, tags in column_tags.items():
        for tag, mask in policies.items():
            if tag in tags and column in df.columns:
                masks.setdefault(column, mask)
    return apply_masks(df, masks, groups)


def export_share(
    df: DataFrame, path: str, table: str, partition_by: Sequence[str], predicate: str = "true"
) -> DataFrame:
    """Write the shared slice and return its manifest: table, partition values, row count.

    The manifest is counted from the written files, so it states what a reader will get.
    """
    df.where(predicate).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{table}")
    return (
        read_share(df.sparkSession, path, table)
        .groupBy(*partition_by)
        .agg(F.count("*").alias("rows"))
        .withColumn("table_name", F.lit(table))
    )


def read_share(spark, path: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{table}")
