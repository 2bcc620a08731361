import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.forecast import forecast_trend, stitch_forecast
from millrace.functions.json import struct_of
from millrace.functions.text import classify_keywords, is_email, is_email_udf, keep_last
from millrace.functions.times import epoch_micros, epoch_to_date, minutes_between
from millrace.operators.diagnostics import run_trends, skew_profile
from millrace.operators.quantiles import exact_quantiles
from millrace.session import cached, shuffle_partitions_for, tune


@pytest.mark.parametrize(
    "address,valid",
    [("a.b+c@x-y.org", True), ("a@b", False), ("a@b.c", False), ("a b@c.de", False),
     ("", False), (None, False), ("a@b.co\n", True), ("a@b.co\r", False)],
)
def test_email(spark, address, valid):
    df = spark.createDataFrame([(address,)], "e STRING")
    assert df.select(is_email(F.col("e"))).first()[0] is valid


def test_email_udf_agrees_with_the_native_check(spark):
    df = spark.createDataFrame(
        [("x@y.zz",), ("x@y",), (None,), ("x@y.zz\n",), ("x@y.zz\r",)], "e STRING"
    )
    assert df.where(is_email(F.col("e")) != is_email_udf("e")).count() == 0


def test_elapsed_minutes_not_boundaries(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01 00:00:50' a, TIMESTAMP_NTZ'2024-01-01 00:01:10' b"
    )
    assert df.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == 0


def test_epoch_units(spark):
    df = spark.sql("SELECT 1704067200L s, -1L before")
    day = dt.date(2024, 1, 1)
    assert df.select(epoch_to_date(F.col("s"), "seconds")).first()[0] == day
    assert df.select(epoch_to_date(F.col("s") * 1000, "millis")).first()[0] == day
    assert df.select(epoch_to_date(F.col("before"))).first()[0] == dt.date(1969, 12, 31)


def test_epoch_does_not_follow_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 00:00:00.000001' t")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(epoch_micros(F.col("t"))).first()[0] == 1719792000000001
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_classification_prefers_score_then_order(spark):
    labels = {"brakes": ["brake", "pad"], "tires": ["tire", "flat"]}
    texts = [("brake and flat tire",), ("brake tire",), ("seat",), (None,)]
    df = spark.createDataFrame(texts, "t STRING")
    got = [r[0] for r in df.select(classify_keywords(F.col("t"), labels, "other")).collect()]
    assert got == ["tires", "brakes", "other", "other"]


def test_mask_keeps_the_tail(spark):
    df = spark.createDataFrame([("123-45-6789",), (None,)], "s STRING")
    got = [r[0] for r in df.select(keep_last(F.col("s"), 4, "XXX-XX-")).collect()]
    assert got == ["XXX-XX-6789", None]


def daily(spark, values):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(days, "day DATE, y DOUBLE")


def test_straight_line_is_continued_without_a_band(spark):
    ahead = forecast_trend(daily(spark, [2 * i + 1 for i in range(11)]), "day", "y").orderBy("day")
    got = ahead.collect()
    assert [r["day"].day for r in got] == [12, 13, 14, 15, 16]
    assert [round(r["y_forecast"], 6) for r in got] == [23, 25, 27, 29, 31]
    assert all(abs(r["y_upper"] - r["y_lower"]) < 1e-4 for r in got)


def test_forecast_per_key_equals_separate_forecasts(spark, rows):
    a, b = daily(spark, [1, 4, 2, 8, 5, 7]), daily(spark, [9, 3, 3, 1])
    both = a.withColumn("k", F.lit("a")).unionByName(b.withColumn("k", F.lit("b")))
    grouped = forecast_trend(both, "day", "y", keys=["k"])
    columns = ["day", "y_forecast", "y_upper", "y_lower"]
    rounded = lambda df: rows(df.select("day", *[F.round(c, 6) for c in columns[1:]]))
    assert rounded(grouped.where("k = 'a'")) == rounded(forecast_trend(a, "day", "y"))
    assert rounded(grouped.where("k = 'b'")) == rounded(forecast_trend(b, "day", "y"))


def test_forecast_of_too_little_history(spark):
    assert forecast_trend(daily(spark, [5]), "day", "y").count() == 0
    two = forecast_trend(daily(spark, [1, 2, 3]), "day", "y").collect()
    assert len(two) == 1 and round(two[0]["y_forecast"], 6) == 4


def test_stitched_chart_has_a_bridge(spark):
    chart = stitch_forecast(daily(spark, [1, 2, 3, 4, 5]), "day", "y").collect()
    bridge = [r for r in chart if r["y"] is not None and r["y_forecast"] is not None]
    assert len(bridge) == 1 and bridge[0]["y"] == bridge[0]["y_upper"] == 5.0
    assert sum(r["y"] is None for r in chart) == 2 and len(chart) == 7


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("few", [3, 50, 10_000])
def test_quantiles_equal_the_sorted_list(spark, seed, few):
    rng = random.Random(seed)
    data = [rng.gauss(0, 100) for _ in range(3000)] + [7.5] * 1500 + [None] * 20
    df = spark.createDataFrame([(v,) for v in data], "v DOUBLE")
    known = sorted(v for v in data if v is not None)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    want = [known[max(1, -int(-len(known) * s // 1)) - 1] for s in shares]
    assert exact_quantiles(df, "v", shares, few) == want


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "v DOUBLE"), "v", [0.5]) == [None]


def test_variant_types_become_struct_fields():
    schema = struct_of("OBJECT<a: BIGINT, b: DECIMAL(3,1), c: OBJECT<d: VOID>, e: ARRAY<STRING>>")
    assert schema.simpleString() == (
        "struct<a:bigint,b:double,c:struct<d:string>,e:array<string>>"
    )
    assert struct_of("VOID").fields == []
    odd = struct_of("OBJECT<`DECIMAL(1,2)`: BIGINT, VOID: VOID, a: ARRAY<VOID>, A: BIGINT>")
    assert odd.simpleString() == "struct<DECIMAL(1,2):bigint,VOID:string,a:array<string>>"


def test_skew_profile(spark):
    df = spark.range(100).selectExpr("CASE WHEN id < 60 THEN 0 ELSE id END AS k")
    row = skew_profile(df, ["k"]).first()
    assert (row["n_keys"], row["n_rows"], row["max_rows"], row["median_rows"]) == (41, 100, 60, 1)
    assert row["max_to_median"] == 60.0


def test_run_flags(spark):
    runs = spark.createDataFrame(
        [("j", 10.0, 1.0, False), ("j", 10.0, 6.0, True), ("j", 30.0, 5.0, False)],
        "job STRING, d DOUBLE, q DOUBLE, failed BOOLEAN",
    )
    got = {r["d"] * 10 + r["q"]: r for r in run_trends(runs, "job", "d", "q", "failed").collect()}
    assert [got[k]["regressed"] for k in sorted(got)] == [False, False, True]
    assert [got[k]["cold_start"] for k in sorted(got)] == [False, True, False]
    assert abs(got[101.0]["failure_rate"] - 1 / 3) < 1e-12


def test_tuning_is_applied_and_reported(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n) for n in names}
    try:
        done = tune(spark, input_bytes=2**40, broadcast_threshold=50 * 2**20)
        assert done[names[0]] == spark.conf.get(names[0]) == "8192"
        assert spark.conf.get(names[1]) == str(50 * 2**20)
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_cache_is_released(spark):
    df = spark.range(5).selectExpr("id + 1 AS id")
    with cached(df) as kept:
        assert kept.count() == 5 and kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(100 * 2**40) == 819_200
