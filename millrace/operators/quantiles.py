"""Exact discrete quantiles without gathering the column in one place."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

FEW_VALUES = 10_000
_ACCURACY = 10_000
_MARGIN = 2.0 / _ACCURACY


@dataclass
class _Search:
    """The value of one rank, known to lie in [low, high]; ``below`` rows are under low."""

    rank: int
    low: object
    high: object
    below: int
    rows: int

    @property
    def inside(self) -> Column:
        return F.col("v").between(self.low, self.high)


def exact_quantiles(
    df: DataFrame, column: str, shares: Sequence[float], few: int = FEW_VALUES
) -> list:
    """The smallest value with at least ``share`` of the non-NULL rows at or below it.

    All shares are searched together. A round takes from one sketch pass a bracket around each
    wanted rank and counts in a second pass how many rows lie in and below it; the bracket holds
    about a thousandth of the rows, so a few rounds serve any size. When at most ``few`` different
    values are left they are counted per value, and only those counts reach the driver.
    """
    values = df.select(F.col(column).alias("v")).where("v IS NOT NULL")
    whole = values.agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    ).first()
    if not whole["n"]:
        return [None] * len(shares)
    searches = [
        _Search(max(1, math.ceil(whole["n"] * s)), whole["low"], whole["high"], 0, whole["n"])
        for s in shares
    ]
    open_searches = list(searches)
    while open_searches:
        open_searches = _narrow(values, open_searches, few)
    wanted = F.lit(False)
    for search in searches:
        wanted = wanted | search.inside
    counted = values.where(wanted).groupBy("v").agg(F.count("*").alias("n")).collect()
    counts = sorted((row["v"], row["n"]) for row in counted)
    return [_pick(counts, search) for search in searches]


def _narrow(values: DataFrame, searches: list[_Search], few: int) -> list[_Search]:
    """One round; returns the searches that still cover too many values."""
    sketches = []
    for i, s in enumerate(searches):
        own = F.when(s.inside, F.col("v"))
        at = (s.rank - s.below) / s.rows
        ends = F.array(F.lit(max(0.0, at - _MARGIN)), F.lit(min(1.0, at + _MARGIN)))
        sketches.append(F.approx_count_distinct(own).alias(f"values_{i}"))
        sketches.append(F.percentile_approx(own, ends, _ACCURACY).alias(f"ends_{i}"))
    sketched = values.agg(*sketches).first()
    rest = [(i, s) for i, s in enumerate(searches) if sketched[f"values_{i}"] > few]
    if not rest:
        return []
    counts = []
    for i, s in rest:
        low, high = sketched[f"ends_{i}"]
        for end, value in (("low", low), ("high", high)):
            counts.append(F.count_if(s.inside & (F.col("v") < value)).alias(f"under_{end}_{i}"))
            counts.append(F.count_if(s.inside & (F.col("v") <= value)).alias(f"upto_{end}_{i}"))
    counted = values.agg(*counts).first()
    for i, s in rest:
        low, high = sketched[f"ends_{i}"]
        wanted = s.rank - s.below
        under_low, upto_low = counted[f"under_low_{i}"], counted[f"upto_low_{i}"]
        under_high, upto_high = counted[f"under_high_{i}"], counted[f"upto_high_{i}"]
        if wanted <= under_low:
            s.high, s.rows = low, upto_low
        elif wanted <= upto_high:
            s.low, s.high, s.below, s.rows = low, high, s.below + under_low, upto_high - under_low
        else:
            s.low, s.below, s.rows = high, s.below + under_high, s.rows - under_high
    return [s for _, s in rest]


def _pick(counts: list[tuple], search: _Search):
    below = search.below
    for value, n in counts:
        if search.low <= value <= search.high:
            below += n
            if below >= search.rank:
                return value
