"""Change-data application: current state (type 1) and full history (type 2).

A change frame has key columns, value columns, an operation and a typed sequence. Order comes
from the sequence alone, never from arrival. Of several changes with the same key and sequence
one wins: a delete before others, then the larger row hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.operators.sizing import (
    RANGE,
    KeyRanges,
    broadcast_if_small,
    close_seams,
    hot_ranges,
    with_next,
    with_range,
)

START, END = "__START_AT", "__END_AT"
DELETED, WAS_DELETED = "__deleted", "__was_deleted"


def flag_true(condition: str | None) -> Column:
    """A predicate as a strict boolean: NULL counts as not true."""
    return F.lit(False) if condition is None else F.coalesce(F.expr(condition), F.lit(False))


def _check_sequence(changes: DataFrame, sequence_by: str) -> None:
    if isinstance(changes.schema[sequence_by].dataType, T.StringType):
        raise ValueError(
            f"sequence column {sequence_by} is text; parse it to a timestamp or number first"
        )


def _winner_per(
    changes: DataFrame, by: Sequence[str], sequence_by: str, delete_when: str | None
) -> DataFrame:
    """One winning change per ``by`` group, with its delete flag; combines before the shuffle."""
    rest = [c for c in changes.columns if c not in by]
    flagged = changes.withColumn(DELETED, flag_true(delete_when))
    # Helper columns are not part of the row, so stored and fresh changes rank alike.
    content = sorted(c for c in changes.columns if c not in (WAS_DELETED, RANGE))
    rank = F.struct(sequence_by, DELETED, F.xxhash64(*content))
    row = F.max_by(F.struct(*rest, DELETED), rank)
    return (
        flagged.groupBy(*by)
        .agg(row.alias("__row"))
        .select(*by, *[F.col(f"__row.{c}").alias(c) for c in [*rest, DELETED]])
    )


def current_with_tombstones(
    changes: DataFrame, keys: Sequence[str], sequence_by: str, delete_when: str | None = None
) -> DataFrame:
    """Latest change per key, deletes included and flagged, so late events cannot revive a key."""
    _check_sequence(changes, sequence_by)
    return _winner_per(changes, keys, sequence_by, delete_when).select(*changes.columns, DELETED)


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    *,
    delete_when: str | None = None,
    truncate_when: str | None = None,
    except_cols: Sequence[str] = (),
) -> DataFrame:
    """Current state: the last change of each key unless that change deletes it.

    ``truncate_when`` marks changes that empty the table: everything up to the last of them
    is forgotten.
    """
    _check_sequence(changes, sequence_by)
    if truncate_when is not None:
        cleared = (
            changes.where(flag_true(truncate_when)).agg(F.max(sequence_by).alias("t")).scalar()
        )
        changes = changes.where(F.coalesce(F.col(sequence_by) > cleared, F.lit(True)))
    state = current_with_tombstones(changes, keys, sequence_by, delete_when)
    return state.where(~F.col(DELETED)).drop(DELETED, *except_cols)


def one_per_sequence(
    changes: DataFrame, keys: Sequence[str], sequence_by: str, delete_when: str | None = None
) -> DataFrame:
    """Changes with ties of (key, sequence) settled and the delete flag added."""
    _check_sequence(changes, sequence_by)
    settled = _winner_per(changes, [*keys, sequence_by], sequence_by, delete_when)
    return settled.select(*changes.columns, DELETED)


def chained(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    *,
    delete_when: str | None = None,
    ranges: KeyRanges | None = None,
) -> DataFrame:
    """Settled changes, deletes included and flagged, each with the sequence that follows it.

    The rows are shuffled once, by key, and sorted once: settling ties and finding the next change
    both work on that order. Hot keys (``ranges``, looked for when not given) are cut into ranges
    of the sequence, each a task of its own. Where one sequence value is piled high with copies,
    ties are settled before the shuffle instead, so the copies collapse where they are read.
    """
    _check_sequence(changes, sequence_by)
    if ranges is None:
        ranges = hot_ranges(changes, keys, sequence_by)
    by = [*keys, RANGE] if ranges else list(keys)
    rows = with_range(changes, keys, sequence_by, ranges) if ranges else changes
    placed = rows if ranges.piled else rows.repartition(*by)
    settled = _winner_per(placed, [*by, sequence_by], sequence_by, delete_when)
    linked = with_next(settled, by, sequence_by, END)
    if ranges:
        linked = close_seams(linked, rows, keys, sequence_by, END)
    return linked.select(*changes.columns, DELETED, END)


def versions_of(chain: DataFrame, sequence_by: str, except_cols: Sequence[str] = ()) -> DataFrame:
    """Version rows with their validity out of chained changes."""
    kept = [c for c in chain.columns if c not in {DELETED, END, *except_cols}]
    return chain.where(~F.col(DELETED)).select(*kept, F.col(sequence_by).alias(START), END)


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    *,
    delete_when: str | None = None,
    except_cols: Sequence[str] = (),
    ranges: KeyRanges | None = None,
) -> DataFrame:
    """Full history with validity columns; a delete closes the open version and adds none.

    Every change ends where the next one of its key starts (see ``chained``).
    """
    chain = chained(changes, keys, sequence_by, delete_when=delete_when, ranges=ranges)
    return versions_of(chain, sequence_by, except_cols)


def rechained(
    chain: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    *,
    delete_when: str | None = None,
) -> DataFrame:
    """A stored chain with further changes worked in, however late they come.

    Only keys that ``changes`` name are chained anew, so what is shuffled follows the changes. The
    rows of all other keys pass as they are: beside a set of keys that is small enough to broadcast
    (its size is checked) they are not even moved. ``delete_when`` speaks of ``changes`` alone.
    NULL keys are a key like others.
    """
    met = changes.select(*[F.col(k).alias(f"__met_{k}") for k in keys]).distinct()
    met = broadcast_if_small(met)
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"__met_{k}")) for k in keys))
    fresh = changes.withColumn(WAS_DELETED, flag_true(delete_when))
    stored = chain.withColumnRenamed(DELETED, WAS_DELETED)
    rows = stored.join(met, same, "left_semi").drop(END).unionByName(fresh, allowMissingColumns=True)
    anew = chained(rows, keys, sequence_by, delete_when=WAS_DELETED).drop(WAS_DELETED)
    return chain.join(met, same, "left_anti").unionByName(anew, allowMissingColumns=True)
