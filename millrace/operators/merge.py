"""MERGE, UPDATE and DELETE as frame-to-frame operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.joins import salted_join
from millrace.operators.sizing import hot_slots

ACTION = "__action"


class DuplicateMatch(ValueError):
    """Several source rows match one target row."""


def _any_null(keys: Sequence[str]) -> Column:
    flag = F.lit(False)
    for key in keys:
        flag = flag | F.col(key).isNull()
    return flag


def check_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when two source rows would update one target row.

    Counting combines before the shuffle, and the target is only read when the source really
    repeats a key.
    """
    keys = list(keys)
    repeated = source.where(~_any_null(keys)).groupBy(*keys).count().where("count > 1").select(*keys)
    if repeated.isEmpty():
        return
    if not target.join(repeated, keys, "left_semi").isEmpty():
        raise DuplicateMatch(f"several source rows match one target row on {keys}")


def _matched_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], hot: Mapping[int, int]
) -> DataFrame:
    """Rows ``t`` and ``s`` of both sides paired on the keys, NULL where one side is missing.

    One full outer join, unless a key is so frequent in the target that its rows would land in
    one task: a full outer join cannot be split. Then the target is looked up in the source with
    the hot keys salted, and the source rows without a target are added by an anti join against
    the target's distinct keys.
    """
    left = target.select(*keys, F.struct(*target.columns).alias("t"))
    right = source.select(*keys, F.struct(*source.columns).alias("s"))
    if not hot:
        return left.join(right, keys, "full_outer").select("t", "s")
    paired = salted_join(left, right, keys, "left", hot=hot).select("t", "s")
    fresh = right.join(target.select(*keys).distinct(), keys, "left_anti")
    return paired.unionByName(fresh.select("s"), allowMissingColumns=True)


def merge_actions(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    when: str | None = None,
    update: Mapping[str, str] | None = None,
    insert: Mapping[str, str] | None = None,
    not_matched_by_source_delete: bool = False,
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Every resulting row tagged insert, update, keep or delete.

    ``when`` and the values of ``update`` are SQL text over the rows ``s`` and ``t``, those of
    ``insert`` over ``s``; without ``update`` all source columns replace the target's, without
    ``insert`` all of them are inserted, and a column that a given ``insert`` leaves out is NULL.
    With both lists the source may have any columns besides the keys. A guard that is NULL does
    not update. Rows with a NULL key match nothing, so they bypass the join instead of sharing
    one task.
    """
    keys, columns = list(keys), target.columns
    check_single_match(target, source, keys)
    if insert is None:
        others = [] if update is None else [c for c in source.columns if c not in columns]
        source = source.select(*columns, *others)
    unmatched = "delete" if not_matched_by_source_delete else "keep"
    hot = hot_slots(target, keys) if hot is None else hot
    paired = _matched_rows(
        target.where(~_any_null(keys)), source.where(~_any_null(keys)), keys, hot
    )
    keyless_source = source.where(_any_null(keys)).select(F.struct(*source.columns).alias("s"))
    paired = paired.unionByName(keyless_source, allowMissingColumns=True)
    guard = F.lit(True) if when is None else F.coalesce(F.expr(when), F.lit(False))
    action = (
        F.when(F.col("t").isNull(), F.lit("insert"))
        .when(F.col("s").isNull(), F.lit(unmatched))
        .when(guard, F.lit("update"))
        .otherwise(F.lit("keep"))
    )
    all_columns = {c: f"s.`{c}`" for c in columns}
    assigned = all_columns if update is None else dict(update)
    inserted = all_columns if insert is None else dict(insert)

    def resolved(name: str) -> Column:
        kind = target.schema[name].dataType
        given = F.expr(inserted[name]).cast(kind) if name in inserted else F.lit(None).cast(kind)
        value = F.when(F.col(ACTION) == "insert", given)
        if name in assigned:
            value = value.when(F.col(ACTION) == "update", F.expr(assigned[name]).cast(kind))
        return value.otherwise(F.col(f"t.`{name}`")).alias(name)

    joined = paired.withColumn(ACTION, action).select(*[resolved(c) for c in columns], ACTION)
    keyless_target = target.where(_any_null(keys)).withColumn(ACTION, F.lit(unmatched))
    return joined.unionByName(keyless_target)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """The target after the merge; options as for ``merge_actions``."""
    tagged = merge_actions(target, source, keys, **options)
    return tagged.where(F.col(ACTION) != "delete").drop(ACTION)


def update_where(df: DataFrame, condition: str, assignments: Mapping[str, str]) -> DataFrame:
    """Change rows whose predicate is true; column types stay as they are."""
    hit = F.coalesce(F.expr(condition), F.lit(False))
    return df.select(
        *[
            F.when(hit, F.expr(assignments[f.name]).cast(f.dataType))
            .otherwise(F.col(f.name))
            .alias(f.name)
            if f.name in assignments
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def delete_where(df: DataFrame, condition: str) -> DataFrame:
    """Remove rows whose predicate is true; a NULL predicate keeps the row."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(False)))
