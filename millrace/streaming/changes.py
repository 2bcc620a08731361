"""Streaming change-data flows: small deltas written per batch, merged by sequence on read.

A micro-batch only writes what it brings, so its cost follows the change volume and not the
table. Order never depends on arrival: the sequence decides on read, which also makes late and
shuffled batches harmless. ``fold`` merges the deltas into a new base, ``fold_when_due`` does so
when they outgrow the old one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import cdc
from millrace.streaming.flows import batch_flow
from millrace.streaming.folds import is_due, read_folded, read_parts, write_base

_FLAG = cdc.WAS_DELETED
# Sequence of the newest truncating change a batch or base knows of.
_CLEARED = "__cleared"
_REDUCE = {1: cdc.current_with_tombstones, 2: cdc.one_per_sequence}


def apply_changes(
    changes: DataFrame,
    target: str,
    checkpoint: str,
    *,
    keys: Sequence[str],
    sequence_by: str,
    delete_when: str | None = None,
    truncate_when: str | None = None,
    scd: int = 1,
    trigger: str = "availableNow",
) -> StreamingQuery:
    """Feed a change stream into a type 1 or type 2 target.

    Type 1 batches are reduced to one row per key, deletes kept as tombstones; type 2 batches
    keep one row per key and sequence. ``truncate_when`` marks changes that empty a type 1
    target: all up to the last of them is forgotten, also what arrives after it. Give it from the
    first run of a target on.
    """
    reduce = _REDUCE[scd]
    if truncate_when is not None and scd != 1:
        raise ValueError("only a type 1 target can be truncated")

    def shape(batch: DataFrame) -> DataFrame:
        rows = reduce(batch, keys, sequence_by, delete_when)
        if truncate_when is None:
            return rows
        truncating = batch.where(cdc.flag_true(truncate_when))
        return rows.withColumn(_CLEARED, truncating.agg(F.max(sequence_by)).scalar())

    return batch_flow(changes, f"{target}/deltas", checkpoint, trigger, shape)


def _stored(spark: SparkSession, target: str, sequence_by: str) -> DataFrame:
    """Base and batches with the stored delete flag under a plain name, and what truncates forget."""
    rows = read_folded(spark, f"{target}/deltas", f"{target}/base")
    rows = rows.withColumnRenamed(cdc.DELETED, _FLAG)
    if _CLEARED not in rows.columns:
        return rows
    cleared = rows.agg(F.max(_CLEARED)).scalar()
    return rows.where(F.coalesce(F.col(sequence_by) > cleared, F.lit(True))).drop(_CLEARED)


def read_current(
    spark: SparkSession,
    target: str,
    *,
    keys: Sequence[str],
    sequence_by: str,
    except_cols: Sequence[str] = (),
) -> DataFrame:
    """Current rows of a type 1 target."""
    return cdc.scd1(
        _stored(spark, target, sequence_by),
        keys,
        sequence_by,
        delete_when=_FLAG,
        except_cols=[_FLAG, *except_cols],
    )


def _chain(spark: SparkSession, target: str, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """All changes of a type 2 target, chained; only keys met since the last fold are worked on."""
    base, fresh = read_parts(spark, f"{target}/deltas", f"{target}/base")
    if base is not None and cdc.END in base.columns:
        if fresh is None:
            return base
        fresh = fresh.withColumnRenamed(cdc.DELETED, _FLAG)
        return cdc.rechained(base, fresh, keys, sequence_by, delete_when=_FLAG)
    rows = _stored(spark, target, sequence_by)
    return cdc.chained(rows, keys, sequence_by, delete_when=_FLAG).drop(_FLAG)


def read_history(
    spark: SparkSession,
    target: str,
    *,
    keys: Sequence[str],
    sequence_by: str,
    except_cols: Sequence[str] = (),
) -> DataFrame:
    """Version rows of a type 2 target.

    The base holds them ready; changes that came after it, early or late in the sequence, cost a
    new chain for their own keys only.
    """
    return cdc.versions_of(_chain(spark, target, keys, sequence_by), sequence_by, except_cols)


def fold(
    spark: SparkSession, target: str, *, keys: Sequence[str], sequence_by: str, scd: int = 1
) -> int:
    """Write a new base holding all batches so far; returns the last batch it contains.

    Run it between stream runs. The newest truncating change stays in the base, so that it also
    clears what comes late. A type 2 base holds the changes chained.
    """
    if scd == 2:
        chain = lambda _: _chain(spark, target, keys, sequence_by)
        return write_base(spark, f"{target}/deltas", f"{target}/base", chain)

    def merge(rows: DataFrame) -> DataFrame:
        rows = rows.withColumnRenamed(cdc.DELETED, _FLAG)
        if _CLEARED not in rows.columns:
            return cdc.current_with_tombstones(rows, keys, sequence_by, _FLAG).drop(_FLAG)
        cleared = rows.agg(F.max(_CLEARED)).scalar()
        left = rows.where(F.coalesce(F.col(sequence_by) >= cleared, F.lit(True))).drop(_CLEARED)
        folded = cdc.current_with_tombstones(left, keys, sequence_by, _FLAG).drop(_FLAG)
        return folded.withColumn(_CLEARED, cleared)

    return write_base(spark, f"{target}/deltas", f"{target}/base", merge)


def fold_when_due(
    spark: SparkSession,
    target: str,
    *,
    keys: Sequence[str],
    sequence_by: str,
    scd: int = 1,
    ratio: float = 1.0,
) -> bool:
    """Fold when the batches after the base outgrew it by ``ratio``; tells whether it did."""
    due = is_due(spark, f"{target}/deltas", f"{target}/base", ratio)
    if due:
        fold(spark, target, keys=keys, sequence_by=sequence_by, scd=scd)
    return due
