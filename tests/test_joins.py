import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import sizing
from millrace.operators.dedup import first_per_key, latest_per_key
from millrace.operators.joins import interval_join, interval_sums, interval_totals, salted_join
from millrace.operators.sizing import hot_slots

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_interval_join_equals_all_pairs(spark, rows, seed):
    rng = random.Random(seed)
    at = lambda: T0 + dt.timedelta(microseconds=rng.randrange(10**12))
    intervals = []
    for i in range(60):
        start = at()
        length = rng.choice([0, 1, 10**3, 10**6, 4**10, 4**15, 10**11, 10**12])
        intervals.append((i, start, start + dt.timedelta(microseconds=length)))
    intervals += [(98, T0, None), (99, T0 + dt.timedelta(1), T0)]
    points = [(j, at()) for j in range(150)]
    points += [(1000 + i, s) for i, s, _ in intervals[:10]]
    points += [(2000 + i, e) for i, _, e in intervals[:10]] + [(3000, None)]
    left = spark.createDataFrame(intervals, "i LONG, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ")
    right = spark.createDataFrame(points, "j LONG, p TIMESTAMP_NTZ")
    want = sorted(
        ((i, j) for i, s, e in intervals for j, p in points if e and p and s < p < e), key=repr
    )
    assert rows(interval_join(left, right, "s", "e", "p"), "i", "j") == want


def test_interval_totals_equal_the_aggregated_pairs(spark, rows):
    rng = random.Random(5)
    at = lambda: T0 + dt.timedelta(microseconds=rng.randrange(10**11))
    intervals = [
        (i, s, s + dt.timedelta(microseconds=rng.choice([1, 10**5, 4**14, 10**10, 10**11])))
        for i, s in enumerate(at() for _ in range(40))
    ]
    points = [(at(), 1 if rng.random() < 0.4 else rng.randrange(6), rng.randrange(100)) for _ in range(400)]
    points += [points[0]] * 30 + [(s, 2, 5) for _, s, _ in intervals[:8]]
    left = spark.createDataFrame(intervals, "i LONG, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ")
    right = spark.createDataFrame(points, "p TIMESTAMP_NTZ, who LONG, v LONG")
    want = {}
    for i, s, e in intervals:
        for p, who, v in points:
            if s < p < e:
                n, total = want.get((i, who), (0, 0))
                want[i, who] = (n + 1, total + v)
    got = interval_totals(left, right, "s", "e", "p", by="who", value="v")
    assert rows(got, "i", "who", "n_points", "total") == sorted(
        ((*k, *v) for k, v in want.items()), key=repr
    )


def test_repeated_intervals_count_once(spark, rows):
    left = spark.createDataFrame([(1, 0, 10)] * 2, "i LONG, a LONG, b LONG").selectExpr(
        "i", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, a) AS s",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, b) AS e",
    )
    right = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:05' AS p, 3L AS who, 5L AS v")
    got = interval_totals(left, right, "s", "e", "p", by="who", value="v")
    assert rows(got, "i", "who", "n_points", "total") == [(1, 3, 1, 5)]


def test_interval_sums_equal_the_pairs(spark, rows):
    rng = random.Random(9)
    at = lambda: T0 + dt.timedelta(microseconds=rng.randrange(4 * 10**11))
    intervals = [
        (i, s, s + dt.timedelta(microseconds=rng.choice([0, 1, 10**6, 10**8, 10**10, 3 * 10**11])))
        for i, s in enumerate(at() for _ in range(50))
    ]
    points = [(at(), rng.randrange(-50, 50)) for _ in range(300)]
    points += [(s, 7) for _, s, _ in intervals[:9]] + [(e, 11) for _, _, e in intervals[:9]] + [(None, 1)]
    left = spark.createDataFrame(intervals + intervals[:2] + [(98, T0, None)], "i LONG, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ")
    right = spark.createDataFrame(points, "p TIMESTAMP_NTZ, v LONG")
    want = []
    for i, s, e in intervals + intervals[:2]:
        inside = [v for p, v in points if p and s < p < e]
        if s < e:
            want.append((i, len(inside), sum(inside)))
    got = interval_sums(left, right, "s", "e", "p", "v")
    assert rows(got, "i", "n_points", "total") == sorted(want, key=repr)


def test_interval_join_with_key_and_empty_side(spark, rows):
    left = spark.createDataFrame(
        [("a", T0, T0 + dt.timedelta(hours=1)), ("b", T0, T0 + dt.timedelta(hours=1))],
        "k STRING, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ",
    )
    right = spark.createDataFrame([("a", T0 + dt.timedelta(minutes=5))], "k STRING, p TIMESTAMP_NTZ")
    assert rows(interval_join(left, right, "s", "e", "p", on=["k"]), "k") == [("a",)]
    assert rows(interval_join(left.where("false"), right, "s", "e", "p", on=["k"])) == []


def test_dates_count_from_midnight(spark, rows):
    left = spark.sql("SELECT DATE'2024-01-01' AS s, DATE'2024-01-02' AS e")
    right = spark.sql(
        "SELECT 1 AS j, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS p "
        "UNION ALL SELECT 2, TIMESTAMP_NTZ'2024-01-01 12:00:00' "
        "UNION ALL SELECT 3, TIMESTAMP_NTZ'2024-01-02 00:00:00'"
    )
    assert rows(interval_join(left, right, "s", "e", "p"), "j") == [(2,)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, rows, how):
    big = spark.range(2000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id % 5 AS v")
    other = spark.range(0, 1500).selectExpr("id AS k", "id * 2 AS w")
    hot = hot_slots(big, ["k"], rows_per_task=100)
    assert list(hot.values()) == [7]
    salted = salted_join(big, other, ["k"], how, hot=hot)
    assert rows(salted) == rows(big.join(other, ["k"], how))


def test_salt_spreads_identical_rows(spark):
    big = spark.range(4000).selectExpr("1L AS k", "'same' AS v")
    other = spark.createDataFrame([(1, "x")], "k LONG, w STRING")
    hot = hot_slots(big, ["k"], rows_per_task=100)
    spread = salted_join(big.repartition(1), other, ["k"], hot=hot).hint("merge")
    assert spread.count() == 4000


def test_slots_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_CUTS", 10)
    df = spark.range(3000).selectExpr("id % 3 AS k")
    slots = hot_slots(df, ["k"], rows_per_task=1)
    assert len(slots) == 3 and sum(slots.values()) <= 10 + 3
    ranges = sizing.hot_ranges(
        df.selectExpr("k", "monotonically_increasing_id() AS o"), ["k"], "o",
        rows_per_task=1)
    assert sum(map(len, ranges.cuts.values())) <= 10 + 3


def test_salted_join_rejects_other_kinds(spark):
    with pytest.raises(ValueError):
        salted_join(spark.range(1), spark.range(1), ["id"], "full_outer")


def test_latest_and_first_per_key(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, None), (2, 2, "b"), (None, 5, "n"), (None, 6, "m")],
        "k INT, o INT, v STRING",
    )
    assert rows(latest_per_key(df, ["k"], ["o"])) == [(1, 3, None), (2, 2, "b"), (None, 6, "m")]
    assert rows(first_per_key(df, ["k"], ["o"])) == [(1, 1, "a"), (2, 2, "b"), (None, 5, "n")]


def test_union_keeps_and_distinct_removes(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    b = spark.createDataFrame([(2, "b"), (3, "c")], "id INT, v STRING")
    assert a.unionAll(b).count() == 4 and a.union(b).distinct().count() == 3
    assert a.unionAll(a).select(F.count("*")).first()[0] == 4


def test_a_small_sketch_grows_until_no_hot_key_is_missed(spark, monkeypatch):
    monkeypatch.setattr(sizing, "HOT_KEYS", 3)
    monkeypatch.setattr(sizing, "SKETCH_ITEMS", 16)
    df = spark.range(6000).selectExpr("IF(id % 2 = 0, id % 80, 1000 + id) AS k", "id AS o")
    slots = hot_slots(df, ["k"], rows_per_task=50)
    assert len(slots) == 40 and set(slots.values()) == {2}
    ranges = sizing.hot_ranges(df, ["k"], "o", rows_per_task=50)
    assert set(ranges.cuts) == set(slots) and all(len(c) == 1 and 2000 < c[0] < 4000 for c in ranges.cuts.values())
    assert hot_slots(df, ["k"], rows_per_task=100) == {}


def test_ranges_of_a_key_whose_order_is_unknown(spark):
    df = spark.range(100).selectExpr("1L AS k", "CAST(NULL AS LONG) AS o")
    ranges = sizing.hot_ranges(df, ["k"], "o", rows_per_task=10)
    assert list(ranges.cuts.values()) == [[]] and ranges.piled
    assert sizing.hot_ranges(df.where("false"), ["k"], "o", rows_per_task=10) == sizing.KeyRanges()
