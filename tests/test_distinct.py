"""Distinct counts of several columns, and the weekly forecast, against plain calculations."""

import datetime as dt
import random
import re

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.functions.forecast import forecast_weekly
from millrace.operators.distinct import distinct_counts

KINDS = "g string, h int, a int, b string, extra int"


def made(n=400, seed=1):
    pick = random.Random(seed)
    none = lambda value: None if pick.random() < 0.2 else value
    return [
        (none(pick.choice("xyz")), none(pick.randrange(3)), none(pick.randrange(40)), none(str(pick.randrange(9))), 1)
        for _ in range(n)
    ] + [("only", 1, None, None, 1)]


def test_distinct_counts_equal_sets(spark, rows):
    data = made()
    frame = spark.createDataFrame(data, KINDS)
    got = rows(distinct_counts(frame, ["g", "h"], {"n_a": "a", "n_b": F.col("b"), "n_low": "a % 5"}))
    want = {}
    for g, h, a, b, _ in data:
        sets = want.setdefault((g, h), (set(), set(), set()))
        for kept, value in zip(sets, (a, b, None if a is None else a % 5)):
            if value is not None:
                kept.add(value)
    assert got == sorted(((*k, *map(len, s)) for k, s in want.items()), key=repr)
    assert ("only", 1, 0, 0, 0) in got


def test_distinct_counts_of_derived_and_empty_frames(spark, rows):
    frame = spark.createDataFrame(made(), KINDS)
    derived = frame.groupBy("g", "a").agg(F.max("b").alias("b"))
    plain = derived.groupBy("g").agg(F.count_distinct("a"), F.count_distinct("b"))
    assert rows(distinct_counts(derived, ["g"], {"a": "a", "b": "b"})) == rows(plain)
    assert rows(distinct_counts(frame, [], {"n": "a", "m": "b"})) == [(40, 9)]
    empty = spark.createDataFrame([], KINDS)
    assert rows(distinct_counts(empty, ["g"], {"n": "a"})) == []
    assert rows(distinct_counts(empty, [], {"n": "a", "m": "b"})) == [(0, 0)]


def test_distinct_plan_copies_no_rows_and_spreads_groups(spark, data):
    text = entry.queries()["agg_distinct_by_group"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert all(any(f"__v{i}" in by for by in dealt) for i in range(4))


def weekly(spark, values, start=dt.date(2024, 1, 1)):
    points = [(start + dt.timedelta(i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(points, "day date, y double")


def test_weekly_series_is_continued(spark):
    shape = [5, 0, 0, 1, 2, 30, 40]
    series = [100 + 0.5 * i + shape[i % 7] for i in range(35)]
    got = forecast_weekly(weekly(spark, series), "day", "y").orderBy("day").collect()
    assert len(got) == 17
    for i, row in enumerate(got, 35):
        assert abs(row["y_forecast"] - (100 + 0.5 * i + shape[i % 7])) < 1e-6
        assert abs(row["y_upper"] - row["y_lower"]) < 1e-3


def test_weekly_bounds_equal_least_squares(spark):
    pick = random.Random(4)
    series = {k: [50 + i * k + 9 * (i % 7 == 5) + pick.gauss(0, 3) for i in range(n)] for k, n in ((1, 40), (2, 61))}
    frames = [weekly(spark, v).withColumn("k", F.lit(k)) for k, v in series.items()]
    both = frames[0].unionByName(frames[1])
    got = forecast_weekly(both, "day", "y", keys=["k"]).orderBy("k", "day").collect()
    want = []
    for k, values in series.items():
        n = len(values)
        design = lambda xs: np.array([[x, *(x % 7 == d for d in range(7))] for x in xs], float)
        x, y = design(range(n)), np.array(values)
        inverse = np.linalg.inv(x.T @ x)
        weights = inverse @ x.T @ y
        sigma = np.sqrt(np.sum((y - x @ weights) ** 2) / (n - 8))
        new = design(range(n, n + (n - 1) // 2))
        half = 1.96 * sigma * np.sqrt(1 + np.einsum("ij,jk,ik->i", new, inverse, new))
        want += [(f, f + b, f - b) for f, b in zip(new @ weights, half)]
    assert np.allclose([(r["y_forecast"], r["y_upper"], r["y_lower"]) for r in got], want)


def test_weekly_forecast_of_thin_history(spark):
    assert forecast_weekly(weekly(spark, []), "day", "y").count() == 0
    assert forecast_weekly(weekly(spark, [4.0]), "day", "y").count() == 0
    got = forecast_weekly(weekly(spark, [1.0, 2.0, None, 4.0, 5.0]), "day", "y", span_share=2).orderBy("day").collect()
    assert [r["y_forecast"] for r in got] == [None, None, 1, 2, None, 4, 5, None]
    assert all(r["y_upper"] is None for r in got)
