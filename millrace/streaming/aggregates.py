"""Incremental aggregates: partial figures per micro-batch, merged on read.

``aggregate_flow`` keeps sums. Figures that don't add up have forms that do: ``value_flow`` keeps how
often each value of a key is there, so distinct counts, minima and maxima stay right when rows are
taken back, in whatever order; ``distinct_flow`` keeps bitmaps of whole numbers that only ever come.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.flows import batch_flow
from millrace.streaming.folds import is_due, read_folded, write_base


def aggregate_flow(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    *,
    keys: Sequence[str],
    value: str,
    trigger: str = "availableNow",
) -> StreamingQuery:
    """Keep count and sum of ``value`` per key up to date without reading old input again."""

    def partial(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*keys).agg(
            F.count(value).alias("n_values"),
            F.count("*").alias("n_rows"),
            F.sum(value).alias("total"),
        )

    return batch_flow(rows, target, checkpoint, trigger, partial)


def read_aggregate(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The full aggregate: partials are added up, the average follows from sum and count."""
    average = F.try_divide(F.col("total").cast("double"), F.col("n_values"))
    partials = read_folded(spark, target, _base(target))
    return _added(partials, keys).withColumn("average", average)


def fold_aggregate(
    spark: SparkSession, target: str, keys: Sequence[str], ratio: float = 1.0
) -> bool:
    """Add the partials up into a base where they outgrew the old one; tells whether it did.

    Run it between stream runs.
    """
    due = is_due(spark, target, _base(target), ratio)
    if due:
        write_base(spark, target, _base(target), lambda partials: _added(partials, keys))
    return due


def _base(target: str) -> str:
    return f"{target}/_base"


def _added(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    figures = ("n_rows", "n_values", "total")
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in figures])


def value_flow(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    *,
    keys: Sequence[str],
    value: str,
    change: str = "1",
    trigger: str = "availableNow",
) -> StreamingQuery:
    """Keep how often each ``value`` of a key is there, from rows that come and rows taken back.

    ``change`` is an SQL expression: 1 for a row that comes, -1 for one that is taken back, which may
    arrive before the row itself. A batch stores its net changes per key and value, so a hot key is
    spread over its values.
    """

    def partial(batch: DataFrame) -> DataFrame:
        return _netted(batch.select(*keys, value, F.expr(change).cast("long").alias("n")), keys, value)

    return batch_flow(rows, target, checkpoint, trigger, partial)


def _netted(changes: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return changes.groupBy(*keys, value).agg(F.sum("n").alias("n")).where("n <> 0")


def read_values(spark: SparkSession, target: str, keys: Sequence[str], value: str) -> DataFrame:
    """Rows, values, distinct values, smallest and largest value of every key that has rows left."""
    held = _netted(read_folded(spark, target, _base(target)), keys, value).where("n > 0")
    return held.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col("n"))), F.lit(0)).alias("n_values"),
        F.count(value).alias("n_distinct"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
    )


def fold_values(
    spark: SparkSession, target: str, keys: Sequence[str], value: str, ratio: float = 1.0
) -> bool:
    """Net the changes of all batches into a base where they outgrew the old one.

    Values taken back as often as they came vanish; one taken back before it came stays noted.
    """
    due = is_due(spark, target, _base(target), ratio)
    if due:
        write_base(spark, target, _base(target), lambda changes: _netted(changes, keys, value))
    return due


def distinct_flow(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    *,
    keys: Sequence[str],
    value: str,
    trigger: str = "availableNow",
) -> StreamingQuery:
    """Keep the distinct whole numbers of each key as bitmaps of 32,768 numbers each."""

    def partial(batch: DataFrame) -> DataFrame:
        number = F.col(value).cast("long")
        return (
            batch.where(number.isNotNull())
            .groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
        )

    return batch_flow(rows, target, checkpoint, trigger, partial)


def read_distinct(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """``n_distinct`` of every key: bitmaps of a bucket are merged, then their bits counted."""
    merged = _merged_bits(read_folded(spark, target, _base(target)), keys)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n_distinct"))


def fold_distinct(spark: SparkSession, target: str, keys: Sequence[str], ratio: float = 1.0) -> bool:
    """Merge the bitmaps of all batches into a base where they outgrew the old one."""
    due = is_due(spark, target, _base(target), ratio)
    if due:
        write_base(spark, target, _base(target), lambda partials: _merged_bits(partials, keys))
    return due


def _merged_bits(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    return partials.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
