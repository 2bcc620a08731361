"""Forecasts of daily series with prediction bounds: a linear trend, with or without weekday levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def forecast_trend(
    daily: DataFrame,
    day: str,
    value: str,
    *,
    keys: Sequence[str] = (),
    span_share: float = 0.5,
    z: float = 1.96,
) -> DataFrame:
    """Forecast ``value`` for the days after the last one, up to ``span_share`` of the history.

    ``daily`` holds one row per key and day. Least squares over the day index: one aggregation
    gives every coefficient, and the horizon is generated from that one row per key, so the cost
    is the daily table itself. The band is the usual prediction interval of the fitted line.
    """
    keys = list(keys)
    firsts = daily.groupBy(*keys).agg(F.min(day).alias("__first"))
    if keys:
        indexed = daily.join(firsts, keys)
    else:
        indexed = daily.withColumn("__first", daily.agg(F.min(day)).scalar())
    indexed = indexed.select(
        *keys,
        F.col(day).alias("__day"),
        F.datediff(day, "__first").cast("double").alias("__x"),
        F.col(value).cast("double").alias("__y"),
    )
    fitted = (
        indexed.groupBy(*keys)
        .agg(
            F.count("*").alias("__n"),
            F.min("__day").alias("__min_day"),
            F.max("__day").alias("__max_day"),
            F.avg("__x").alias("__mean_x"),
            F.regr_slope("__y", "__x").alias("__slope"),
            F.regr_intercept("__y", "__x").alias("__base"),
            F.regr_sxx("__y", "__x").alias("__sxx"),
            F.regr_syy("__y", "__x").alias("__syy"),
            F.regr_sxy("__y", "__x").alias("__sxy"),
        )
        .withColumn("__span", F.datediff("__max_day", "__min_day"))
        .withColumn(
            "__sigma",
            F.sqrt(
                F.try_divide(
                    F.greatest(F.col("__syy") - F.col("__slope") * F.col("__sxy"), F.lit(0.0)),
                    F.col("__n") - 2,
                )
            ),
        )
    )
    horizon = F.floor(F.col("__span") * F.lit(span_share)).cast("int")
    ahead = fitted.where(horizon >= 1).withColumn(
        "__step", F.explode(F.sequence(F.lit(1), horizon))
    )
    at = (F.col("__span") + F.col("__step")).cast("double")
    fit = F.col("__base") + F.col("__slope") * at
    band = (
        F.lit(z)
        * F.col("__sigma")
        * F.sqrt(
            1
            + F.try_divide(F.lit(1.0), F.col("__n"))
            + F.try_divide(F.pow(at - F.col("__mean_x"), 2), F.col("__sxx"))
        )
    )
    return ahead.select(
        *keys,
        F.date_add("__max_day", F.col("__step")).alias(day),
        fit.alias(f"{value}_forecast"),
        (fit + band).alias(f"{value}_upper"),
        (fit - band).alias(f"{value}_lower"),
    )


def stitch_forecast(daily: DataFrame, day: str, value: str, **options) -> DataFrame:
    """History, then a bridge row on the last day, then the forecast, in one chart-ready frame."""
    outputs = [f"{value}_forecast", f"{value}_upper", f"{value}_lower"]
    last_day = daily.agg(F.max(day)).scalar()
    empty = [F.lit(None).cast("double").alias(name) for name in outputs]
    amount = F.col(value).cast("double")
    history = daily.where(F.col(day) < last_day).select(day, *empty, amount.alias(value))
    bridge = daily.where(F.col(day) == last_day).select(
        day, *[amount.alias(name) for name in outputs], amount.alias(value)
    )
    ahead = forecast_trend(daily, day, value, **options)
    return ahead.unionByName(history, allowMissingColumns=True).unionByName(bridge)


def forecast_weekly(
    daily: DataFrame,
    day: str,
    value: str,
    *,
    keys: Sequence[str] = (),
    span_share: float = 0.5,
    z: float = 1.96,
) -> DataFrame:
    """Forecast with a trend and a level for every day of the week, per key.

    Least squares with one slope and seven levels. Its normal equations separate by day of the week:
    sums of squares about the means of each weekday add up to the slope, and each level follows
    from that weekday's means. So two grouped sums fit every key, the second over at most seven rows
    a key. The band is the usual prediction interval. Days without a value do not take part.
    A weekday that the history lacks is listed with a NULL forecast. Without more days than coefficients
    no spread can be estimated and the bounds are NULL; where no weekday comes twice the slope is 0.
    """
    keys = list(keys)
    points = daily.where(F.col(value).isNotNull() & F.col(day).isNotNull()).select(
        *keys,
        F.col(day).cast("date").alias("__day"),
        F.weekday(day).alias("__weekday"),
        F.unix_date(F.col(day).cast("date")).cast("double").alias("__x"),
        F.col(value).cast("double").alias("__y"),
    )
    weekdays = points.groupBy(*keys, "__weekday").agg(
        F.count("*").alias("__n"),
        F.avg("__x").alias("__mean_x"),
        F.avg("__y").alias("__mean_y"),
        F.regr_sxx("__y", "__x").alias("__sxx"),
        F.regr_syy("__y", "__x").alias("__syy"),
        F.regr_sxy("__y", "__x").alias("__sxy"),
        F.min("__day").alias("__min_day"),
        F.max("__day").alias("__max_day"),
    )
    level = F.struct("__n", "__mean_x", "__mean_y")
    slope = F.coalesce(F.try_divide("__sxy", "__sxx"), F.lit(0.0))
    spread = F.greatest(F.col("__syy") - F.col("__slope") * F.col("__sxy"), F.lit(0.0))
    fitted = (
        weekdays.groupBy(*keys)
        .agg(
            F.sum("__sxx").alias("__sxx"),
            F.sum("__syy").alias("__syy"),
            F.sum("__sxy").alias("__sxy"),
            (F.sum("__n") - F.count("*") - 1).alias("__free"),
            F.min("__min_day").alias("__min_day"),
            F.max("__max_day").alias("__max_day"),
            F.map_from_entries(F.collect_list(F.struct("__weekday", level))).alias("__levels"),
        )
        .withColumn("__slope", slope)
        .withColumn(
            "__sigma", F.when(F.col("__free") > 0, F.sqrt(F.try_divide(spread, F.col("__free"))))
        )
    )
    horizon = F.floor(F.datediff("__max_day", "__min_day") * F.lit(span_share)).cast("int")
    ahead = (
        fitted.where(horizon >= 1)
        .withColumn("__step", F.explode(F.sequence(F.lit(1), horizon)))
        .withColumn("__day", F.date_add("__max_day", F.col("__step")))
        .withColumn("__level", F.try_element_at("__levels", F.weekday("__day")))
    )
    off = F.unix_date("__day").cast("double") - F.col("__level.__mean_x")
    fit = F.col("__level.__mean_y") + F.col("__slope") * off
    leverage = F.coalesce(F.try_divide(F.pow(off, F.lit(2)), F.col("__sxx")), F.lit(0.0))
    band = F.lit(z) * F.col("__sigma") * F.sqrt(1 + 1 / F.col("__level.__n") + leverage)
    return ahead.select(
        *keys,
        F.col("__day").alias(day),
        fit.alias(f"{value}_forecast"),
        (fit + band).alias(f"{value}_upper"),
        (fit - band).alias(f"{value}_lower"),
    )
