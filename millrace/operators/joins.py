"""Joins Spark has no strategy for: strict interval joins and joins on a skewed key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.times import epoch_micros
from millrace.operators.sizing import hot_slots, with_position, with_slots, with_spread

# An interval of level n is at most 4**n microseconds long and is filed in buckets of an eighth
# of that; level 10 is about one second.
_MIN_LEVEL, _MAX_LEVEL = 10, 31
_BUCKETS = 8


def _level(start: Column, end: Column) -> Column:
    """Smallest level whose length covers the interval."""
    width = F.greatest(end - start, F.lit(1)).cast("double")
    level = F.ceil(F.log2(width) / 2).cast("int")
    return F.least(F.greatest(level, F.lit(_MIN_LEVEL)), F.lit(_MAX_LEVEL))


def _bucket(at: Column, level: Column) -> Column:
    return F.call_function("shiftright", at * F.lit(_BUCKETS), 2 * level)


def _filed(intervals: DataFrame, start: str, end: str) -> tuple[DataFrame, list[int]]:
    """Intervals once per bucket they touch, ``__whole`` where they cover it, and the levels."""
    levelled = (
        intervals.where(F.col(start) < F.col(end))
        .withColumn("__s", epoch_micros(F.col(start)))
        .withColumn("__e", epoch_micros(F.col(end)))
        .withColumn("__level", _level(F.col("__s"), F.col("__e")))
    )
    levels = sorted(row[0] for row in levelled.select("__level").distinct().collect())
    filed = (
        levelled.withColumn("__first", _bucket(F.col("__s"), F.col("__level")))
        .withColumn("__last", _bucket(F.col("__e"), F.col("__level")))
        .withColumn("__bucket", F.explode(F.sequence("__first", "__last")))
        .withColumn(
            "__whole",
            (F.col("__first") < F.col("__bucket")) & (F.col("__bucket") < F.col("__last")),
        )
        .drop("__s", "__e", "__first", "__last")
    )
    return filed, levels or [_MIN_LEVEL]


def _located(points: DataFrame, point: str, levels: Sequence[int]) -> DataFrame:
    return (
        points.where(F.col(point).isNotNull())
        .withColumn("__level", F.explode(F.array(*[F.lit(level) for level in levels])))
        .withColumn("__bucket", _bucket(epoch_micros(F.col(point)), F.col("__level")))
    )


def interval_join(
    intervals: DataFrame,
    points: DataFrame,
    start: str,
    end: str,
    point: str,
    on: Sequence[str] = (),
) -> DataFrame:
    """All pairs with ``start < point < end`` (and equal ``on`` columns), each exactly once.

    An interval is filed under its length class, in buckets of an eighth of the class, so it
    touches at most nine buckets however long it is, and at most about half of the candidates
    drop out at its edges. A point is filed once per class that occurs (at most 22, one for
    windows of a single length). The join is then an equi-join on (level, bucket) with the strict
    bounds re-checked, which Spark can shuffle, split on skew or broadcast like any other, where
    the bare inequality would be a nested loop over all pairs.
    """
    filed, levels = _filed(intervals, start, end)
    located = _located(points, point, levels)
    return (
        filed.join(located, [*on, "__level", "__bucket"])
        .where((F.col(start) < F.col(point)) & (F.col(point) < F.col(end)))
        .drop("__level", "__bucket", "__whole")
    )


def interval_totals(
    intervals: DataFrame,
    points: DataFrame,
    start: str,
    end: str,
    point: str,
    *,
    by: str,
    value: str,
) -> DataFrame:
    """Per interval and ``by`` value of its points: how many there are and their sum.

    The aggregate of ``interval_join`` without most of its pairs. Inside the buckets an interval
    covers whole, the points are added up per bucket and ``by`` value before the join, so a busy
    ``by`` value or a pile of copies is one row there; single points only meet the intervals
    whose edge falls into their bucket. Intervals without points are absent; repeated intervals
    count as one.
    """
    filed, levels = _filed(intervals.distinct(), start, end)
    located = _located(points.select(point, by, value), point, levels)
    bucketed = located.groupBy("__level", "__bucket", by).agg(
        F.count("*").alias("n_points"), F.sum(value).alias("total")
    )
    covered = filed.where("__whole").join(bucketed, ["__level", "__bucket"])
    edges = (
        filed.where("NOT __whole")
        .join(located, ["__level", "__bucket"])
        .where((F.col(start) < F.col(point)) & (F.col(point) < F.col(end)))
        .withColumns({"n_points": F.lit(1).cast("long"), "total": F.col(value)})
    )
    columns = [*intervals.columns, by, "n_points", "total"]
    return (
        covered.select(*columns)
        .unionByName(edges.select(*columns))
        .groupBy(*intervals.columns, by)
        .agg(F.sum("n_points").alias("n_points"), F.sum("total").alias("total"))
    )


def interval_sums(
    intervals: DataFrame, points: DataFrame, start: str, end: str, point: str, value: str
) -> DataFrame:
    """Each interval with ``n_points`` and ``total`` of the points strictly inside it.

    Linear in both inputs: the answer is a difference of two running sums over time, taken at the
    interval's ends. Running sums are formed within buckets of about a minute and carried on from
    bucket to bucket and from day to day, so no task sees more than a bucket's rows or a day's
    buckets. ``value`` is a whole number, so sums don't depend on their order.
    """
    columns = F.struct(*intervals.columns)
    named = with_position(intervals.where(F.col(start) < F.col(end)), "__id").select(
        "__id", columns.alias("__own"), start, end
    )
    none = F.lit(0).cast("long")
    inside = points.where(F.col(point).isNotNull()).select(
        epoch_micros(F.col(point)).alias("at"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("long").alias("__id"),
        F.lit(1).cast("long").alias("n"),
        F.coalesce(F.col(value).cast("long"), none).alias("v"),
    )
    # at one instant an end comes before the points and a start after them: both are strict
    bounds = [
        named.select(
            epoch_micros(F.col(at)).alias("at"), F.lit(kind).alias("kind"), "__id", none.alias("n"), none.alias("v")
        )
        for at, kind in ((end, 0), (start, 2))
    ]
    marks = inside.union(bounds[0]).union(bounds[1])
    marks = marks.withColumn("bucket", F.shiftright("at", 26)).withColumn("day", F.shiftright("at", 37))
    running = Window.partitionBy("day", "bucket").orderBy("at", "kind")
    running = running.rowsBetween(Window.unboundedPreceding, 0)
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    buckets = marks.groupBy("day", "bucket").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    in_day = earlier(Window.partitionBy("day").orderBy("bucket"))
    days = buckets.groupBy("day").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    in_all = earlier(Window.orderBy("day"))
    days = days.select("day", *[F.coalesce(F.sum(c).over(in_all), none).alias(f"{c}_days") for c in "nv"])
    before = buckets.select(
        "day", "bucket", *[F.coalesce(F.sum(c).over(in_day), none).alias(f"{c}_buckets") for c in "nv"]
    ).join(days, "day")
    sign = F.when(F.col("kind") == 0, 1).otherwise(-1)
    at_bounds = (
        marks.withColumns({f"{c}_here": F.sum(c).over(running) for c in "nv"})
        .where("kind <> 1")
        .join(before, ["day", "bucket"])
    )
    sums = at_bounds.groupBy("__id").agg(
        *[
            F.sum(sign * (F.col(f"{c}_here") + F.col(f"{c}_buckets") + F.col(f"{c}_days"))).alias(name)
            for c, name in (("n", "n_points"), ("v", "total"))
        ]
    )
    return named.select("__id", "__own").join(sums, "__id").select("__own.*", "n_points", "total")


def salted_join(
    big: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Equi-join that spreads each hot key of ``big`` over as many tasks as its size asks for.

    Only hot keys are salted, so the rows of ``other`` are copied for those keys alone. The salt
    comes from the row's position, not its content: identical copies spread as well. ``how`` may
    be inner or left, where each row of ``big`` is looked up once.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    hot = hot_slots(big, on) if hot is None else hot
    if not hot:
        return big.join(other, list(on), how)
    spread = with_spread(big, on, hot, "__salt")
    copies = (
        with_slots(other, on, hot)
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__slots") - 1)))
        .drop("__slots")
    )
    return spread.join(copies, [*on, "__salt"], how).drop("__salt")
