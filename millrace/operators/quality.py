"""Data-quality rules: warn, drop or fail, with their counts and a quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate that rows should satisfy; a NULL result is a violation."""

    name: str
    condition: str
    action: str = WARN

    def __post_init__(self) -> None:
        if self.action not in (WARN, DROP, FAIL):
            raise ValueError(f"unknown action {self.action!r}")

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def expect_all(rules: Mapping[str, str], action: str = WARN) -> list[Rule]:
    return [Rule(name, condition, action) for name, condition in rules.items()]


def _all_hold(rules: Sequence[Rule]) -> Column:
    verdict = F.lit(True)
    for rule in rules:
        verdict = verdict & rule.holds
    return verdict


def kept(rules: Sequence[Rule]) -> Column:
    """TRUE for rows no drop rule removes."""
    return _all_hold([r for r in rules if r.action == DROP])


def _counts(rules: Sequence[Rule]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("input_records"),
        F.count_if(kept(rules)).alias("output_records"),
        *[F.count_if(~r.holds).alias(f"failed_{i}") for i, r in enumerate(rules)],
    ]


def count_names(rules: Sequence[Rule]) -> list[str]:
    """Names of the counts that an observation of the rules holds."""
    return ["input_records", "output_records", *[f"failed_{i}" for i in range(len(rules))]]


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], observation: Observation | str | None = None
) -> DataFrame:
    """Rows that pass the drop rules; the job stops at the first row that breaks a fail rule.

    With an observation the rule counts come out of the same pass that consumes the result. For
    a stream it is a name, and the counts are in the progress of each micro-batch.
    """
    out = df if observation is None else df.observe(observation, *_counts(rules))
    for rule in rules:
        if rule.action == FAIL:
            stop = F.raise_error(F.lit(f"rule {rule.name} violated: {rule.condition}"))
            out = out.where(F.when(rule.holds, F.lit(True)).otherwise(stop.cast("boolean")))
    return out.where(kept(rules))


def rule_metrics(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """(dataset, name, passed_records, failed_records), from a single aggregation."""
    totals = df.agg(*_counts(rules))
    entries = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(rule.name).alias("name"),
            (F.col("input_records") - F.col(f"failed_{i}")).alias("passed_records"),
            F.col(f"failed_{i}").alias("failed_records"),
        )
        for i, rule in enumerate(rules)
    ]
    return totals.select(F.inline(F.array(*entries)))


def flow_metrics(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row per flow: records kept, records dropped by any rule, and their ratio."""
    dropped = F.col("input_records") - F.col("output_records")
    return df.agg(*_counts(rules)).select(
        F.lit(dataset).alias("dataset"),
        "output_records",
        dropped.alias("dropped_records"),
        F.try_divide(dropped.cast("double"), F.col("output_records")).alias("failure_rate"),
    )


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, in rule order."""
    names = [F.when(~rule.holds, F.lit(rule.name)) for rule in rules]
    return F.array_compact(F.array(*names))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that hold every rule, and the others with the names of the rules they break."""
    good = df.where(_all_hold(rules))
    bad = df.where(~_all_hold(rules)).withColumn("failed_rules", failed_rules(rules))
    return good, bad


# The names of the gate comparisons.
COMPARATORS = {
    "GREATER_THAN": lambda count, limit: count > limit,
    "GREATER_THAN_OR_EQUAL": lambda count, limit: count >= limit,
    "EQUAL_TO": lambda count, limit: count == limit,
    "NOT_EQUAL": lambda count, limit: count != limit,
    "LESS_THAN": lambda count, limit: count < limit,
    "LESS_THAN_OR_EQUAL": lambda count, limit: count <= limit,
}


def row_count_gate(df: DataFrame, comparator: str, threshold: int) -> DataFrame:
    """(row_count, passed): whether the next step may run."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "passed", COMPARATORS[comparator](F.col("row_count"), threshold)
    )
