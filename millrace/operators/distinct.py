"""Exact distinct counts of several columns per group, without copying rows per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.sizing import keeps_order
from millrace.scratch import scratch_dir


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column | str]) -> DataFrame:
    """One row per group with the number of different values of each column.

    ``columns`` maps a result's name to the column or expression it counts. As in SQL, NULL is no
    value, and NULL keys form a group of their own; without ``keys`` there is one row.

    Several distinct aggregates in one ``agg`` copy every row once per column, with all columns in
    each copy. Here each column is counted by itself in two levels: copies of a value are dropped in
    the task that reads them, what is left is dealt by group *and* value, so that a group with a third
    of all rows is spread like the others, and only partial counts meet by group. A scan reads each
    column once; the keys are read once per column. A frame that is not read straight from files
    is written once to the shared checkpoint folder first, so that it isn't computed per column.
    """
    keys, names = list(keys), list(columns)
    if not names:
        return df.select(*keys).distinct()
    values = {name: F.expr(c) if isinstance(c, str) else c for name, c in columns.items()}
    narrow = df.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[value.alias(f"__v{i}") for i, value in enumerate(values.values())],
    )
    if len(names) > 1 and not keeps_order(narrow):
        path = scratch_dir(df.sparkSession, "distinct")
        narrow.write.parquet(path)
        narrow = df.sparkSession.read.schema(narrow.schema).parquet(path)
    groups = [f"__k{i}" for i in range(len(keys))]

    def counted(i: int) -> DataFrame:
        pairs = narrow.select(*groups, f"__v{i}").distinct()
        return pairs.groupBy(*groups).agg(F.count(f"__v{i}").alias(f"__n{i}"))

    parts = [counted(i) for i in range(len(names))]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # every group is in each part once, so the sum picks that part's count
    return (
        both.groupBy(*groups)
        .agg(*[F.sum(f"__n{i}").alias(f"__n{i}") for i in range(len(names))])
        .select(
            *[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)],
            *[F.col(f"__n{i}").alias(name) for i, name in enumerate(names)],
        )
    )
