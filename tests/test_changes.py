import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.operators.sizing import KeyRanges, broadcast_if_small, hot_ranges, hot_slots
from millrace.streaming.aggregates import aggregate_flow, fold_aggregate, read_aggregate
from millrace.streaming.changes import (
    apply_changes,
    fold,
    fold_when_due,
    read_current,
    read_history,
)

SCHEMA = "id LONG, name STRING, op STRING, seq LONG"
APPLY = {"keys": ["id"], "sequence_by": "seq"}
DELETE = "op = 'DELETE'"


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def current(df, **options):
    return cdc.scd1(df, delete_when=DELETE, except_cols=["op", "seq"], **APPLY, **options)


def history(df, **options):
    return cdc.scd2(df, delete_when=DELETE, except_cols=["op", "seq"], **APPLY, **options)


def test_last_change_wins_whatever_the_arrival(spark, rows):
    df = feed(spark, (1, "new", "UPDATE", 5), (1, "old", "APPEND", 1), (2, "x", "APPEND", 3))
    assert rows(current(df)) == [(1, "new"), (2, "x")]


def test_late_event_does_not_revive_a_deleted_key(spark, rows):
    df = feed(spark, (1, "a", "APPEND", 1), (1, None, "DELETE", 9), (1, "late", "UPDATE", 4))
    assert rows(current(df)) == []
    assert rows(history(df)) == [(1, "a", 1, 4), (1, "late", 4, 9)]


def test_delete_of_an_unseen_key_is_a_no_op(spark, rows):
    df = feed(spark, (7, None, "DELETE", 1), (8, "b", "APPEND", 1))
    assert rows(current(df)) == [(8, "b")]
    assert rows(history(df)) == [(8, "b", 1, None)]


def test_delete_then_insert_opens_a_new_version(spark, rows):
    df = feed(spark, (1, "a", "APPEND", 1), (1, None, "DELETE", 2), (1, "b", "APPEND", 5))
    assert rows(current(df)) == [(1, "b")]
    assert rows(history(df)) == [(1, "a", 1, 2), (1, "b", 5, None)]


def test_tied_sequence_prefers_the_delete(spark, rows):
    df = feed(spark, (1, "a", "APPEND", 3), (1, None, "DELETE", 3))
    assert rows(current(df)) == []
    assert rows(history(df)) == []


def test_tied_updates_settle_the_same_way_in_any_order(spark, rows):
    a, b = (1, "a", "UPDATE", 3), (1, "b", "UPDATE", 3)
    assert rows(history(feed(spark, a, b))) == rows(history(feed(spark, b, a)))
    assert len(rows(history(feed(spark, a, b, a, a)))) == 1


def test_null_operation_is_not_a_delete(spark, rows):
    assert rows(current(feed(spark, (1, "a", None, 1)))) == [(1, "a")]


def test_truncate_forgets_everything_up_to_it(spark, rows):
    df = feed(
        spark, (1, "a", "APPEND", 1), (2, "b", "APPEND", 2), (None, None, "TRUNCATE", 3),
        (2, "c", "UPDATE", 4),
    )
    assert rows(current(df, truncate_when="op = 'TRUNCATE'")) == [(2, "c")]
    without = current(df.where("op <> 'TRUNCATE'"), truncate_when="op = 'TRUNCATE'")
    assert rows(without) == [(1, "a"), (2, "c")]


def test_text_sequence_is_refused(spark):
    df = feed(spark, (1, "a", "APPEND", 1)).withColumn("seq", F.lit("01-31-2024 00:00:00"))
    with pytest.raises(ValueError, match="parse it"):
        current(df)


def test_empty_feed(spark, rows):
    assert rows(current(feed(spark).where("false"))) == []
    assert rows(history(feed(spark).where("false"))) == []


change = st.tuples(
    st.sampled_from([None, 1, 2]),
    st.sampled_from(["a", "b"]),
    st.sampled_from(["APPEND", "UPDATE", "DELETE", None]),
    st.integers(0, 30),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(change, unique_by=lambda c: (c[0], c[3]), max_size=25))
def test_history_equals_a_plain_replay(spark, rows, changes):
    df = spark.createDataFrame(changes, SCHEMA)
    want_current, want_history = [], []
    for key in {c[0] for c in changes}:
        chain = sorted((c for c in changes if c[0] == key), key=lambda c: c[3])
        ends = [c[3] for c in chain[1:]] + [None]
        want_history += [
            (key, c[1], c[3], end) for c, end in zip(chain, ends) if c[2] != "DELETE"
        ]
        want_current += [(key, chain[-1][1])] if chain[-1][2] != "DELETE" else []
    assert rows(current(df)) == sorted(want_current, key=repr)
    assert rows(history(df)) == sorted(want_history, key=repr)
    ranges = hot_ranges(df, ["id"], "seq", rows_per_task=2)
    assert not ranges.piled
    assert rows(history(df, ranges=ranges)) == sorted(want_history, key=repr)


def skewed(spark):
    """One key holds a third of the rows, with exact copies, a NULL key and deletes."""
    ids = spark.range(3000)
    return ids.select(
        F.when(F.col("id") % 3 == 0, 0)
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 40)
        .cast("long")
        .alias("id"),
        F.concat(F.lit("n"), F.col("id") % 7).alias("name"),
        F.when(F.col("id") % 11 == 0, "DELETE").otherwise("UPDATE").alias("op"),
        (F.col("id") % 1700).alias("seq"),
    ).unionAll(spark.range(500).selectExpr("0L AS id", "'copy' AS name", "'UPDATE' AS op", "9L AS seq"))


def test_hot_key_is_found_and_split_exactly(spark, rows):
    df = skewed(spark)
    hot = hot_slots(df, ["id"], rows_per_task=500)
    assert list(hot) == [df.where("id = 0").select(F.xxhash64("id")).first()[0]]
    assert list(hot.values()) == [-(-df.where("id = 0").count() // 500)]
    ranges = hot_ranges(df, ["id"], "seq", rows_per_task=100)
    assert len(ranges.cuts[next(iter(hot))]) > 5 and ranges.piled
    everything = hot_ranges(df, ["id"], "seq", rows_per_task=1)
    expected = rows(history(df, ranges=KeyRanges()))
    assert rows(history(df, ranges=ranges)) == expected
    assert rows(history(df, ranges=everything)) == expected
    assert rows(history(df, ranges=KeyRanges(ranges.cuts))) == expected


def test_one_key_table_is_split_and_not_broadcast(spark, folder):
    """Copies of one row are a few bytes on disk, which must not pass for a small table."""
    spark.range(3_000_000).select(F.lit(7).alias("id"), F.lit("same text").alias("v")).write.parquet(folder + "/t")
    df = spark.read.parquet(folder + "/t")
    assert list(hot_slots(df, ["id"]).values()) == [2]
    assert "broadcast" not in broadcast_if_small(df)._jdf.queryExecution().toString().lower()


def stream(spark, df, src, files):
    df.repartition(files).write.mode("append").parquet(src)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)


@pytest.mark.parametrize("scd", [1, 2])
def test_streamed_batches_equal_one_shot(spark, folder, rows, scd):
    df = skewed(spark)
    first, second = df.where("seq >= 800"), df.where("seq < 800")
    target, checkpoint, src = f"{folder}/t", f"{folder}/c", f"{folder}/src"

    def run(part):
        apply_changes(
            stream(spark, part, src, 3), target, checkpoint, delete_when=DELETE, scd=scd, **APPLY
        )

    read, batch = {1: (read_current, current), 2: (read_history, history)}[scd]
    run(first)
    fold(spark, target, scd=scd, **APPLY)
    run(second)
    result = read(spark, target, except_cols=["op", "seq"], **APPLY)
    assert rows(result) == rows(batch(df))
    fold(spark, target, scd=scd, **APPLY)
    folded = read(spark, target, except_cols=["op", "seq"], **APPLY)
    assert rows(folded) == rows(batch(df))


@pytest.mark.parametrize("seed", range(4))
def test_late_changes_of_some_keys_equal_a_full_recompute(spark, rows, seed):
    pick = random.Random(seed)
    made = [
        (pick.choice([None, *range(12)]), pick.choice("abc"), pick.choice(["UPDATE", "APPEND", "DELETE", None]), pick.randrange(15))
        for _ in range(150)
    ]
    late = [r for r in made if r[0] in (None, 3, 4) and pick.random() < 0.5] + [(99, "new", "UPDATE", 1)]
    early = [r for r in made if r not in late]
    chain = cdc.chained(feed(spark, *early), ["id"], "seq", delete_when=DELETE)
    both = cdc.rechained(chain, feed(spark, *late), ["id"], "seq", delete_when=DELETE)
    assert rows(cdc.versions_of(both, "seq", ["op", "seq"])) == rows(history(feed(spark, *early, *late)))
    none = cdc.rechained(chain, feed(spark), ["id"], "seq", delete_when=DELETE)
    assert rows(none) == rows(chain)


def test_only_met_keys_of_a_stored_history_are_moved(spark, folder, rows):
    target, checkpoint, src = f"{folder}/t", f"{folder}/c", f"{folder}/src"
    apply = lambda df: apply_changes(stream(spark, df, src, 1), target, checkpoint, delete_when=DELETE, scd=2, **APPLY)
    many = spark.range(3000).selectExpr("id % 500 AS id", "'v' || id AS name", "'UPDATE' AS op", "id AS seq")
    apply(many)
    fold(spark, target, scd=2, **APPLY)
    late = feed(spark, (7, "late", "UPDATE", 3), (8, None, "DELETE", 100_000), (9, "dead", "DELETE", 0))
    apply(late)
    result = read_history(spark, target, except_cols=["op", "seq"], **APPLY)
    assert rows(result) == rows(history(many.unionByName(late)))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti, BuildRight" in plan and "SortMergeJoin" not in plan
    fold(spark, target, scd=2, **APPLY)
    folded = read_history(spark, target, except_cols=["op", "seq"], **APPLY)
    assert rows(folded) == rows(history(many.unionByName(late)))
    assert "Exchange" not in folded._jdf.queryExecution().executedPlan().toString()


def test_replayed_batch_leaves_no_duplicates(spark, folder, rows):
    df = feed(spark, (1, "a", "APPEND", 1), (1, "b", "UPDATE", 2))
    target = f"{folder}/t"
    for attempt in ("one", "two"):
        source = stream(spark, df, f"{folder}/src-{attempt}", 1)
        apply_changes(
            source, target, f"{folder}/c-{attempt}", delete_when=DELETE, scd=2, **APPLY
        )
    result = read_history(spark, target, except_cols=["op", "seq"], **APPLY)
    assert rows(result) == [(1, "a", 1, 2), (1, "b", 2, None)]


def test_timestamp_sequences(spark, rows):
    day = lambda d: dt.datetime(2024, 1, d)
    df = spark.createDataFrame(
        [(1, "a", "UPDATE", day(2)), (1, "b", "UPDATE", day(1))],
        "id LONG, name STRING, op STRING, seq TIMESTAMP_NTZ",
    )
    assert rows(history(df)) == [(1, "a", day(2), None), (1, "b", day(1), day(2))]


def test_streamed_truncate_clears_late_rows(spark, folder, rows):
    target, checkpoint, src = f"{folder}/t", f"{folder}/c", f"{folder}/src"
    clear = {"delete_when": DELETE, "truncate_when": "op = 'TRUNCATE'"}
    parts = [
        [(1, "a", "APPEND", 1), (2, "b", "APPEND", 2)],
        [(9, None, "TRUNCATE", 5)],
        [(1, "late", "UPDATE", 4), (3, "c", "APPEND", 7), (2, "tie", "UPDATE", 5)],
        [(2, "later still", "UPDATE", 3)],
    ]
    for n, part in enumerate(parts):
        apply_changes(stream(spark, feed(spark, *part), src, 1), target, checkpoint, **clear, **APPLY)
        if n in (1, 2):  # everything is cleared at the first fold, and stays so
            fold(spark, target, **APPLY)
        seen = [change for p in parts[: n + 1] for change in p]
        want = cdc.scd1(feed(spark, *seen), except_cols=["op", "seq"], **clear, **APPLY)
        got = read_current(spark, target, except_cols=["op", "seq"], **APPLY)
        assert rows(got) == rows(want)
    assert rows(got) == [(3, "c")]
    with pytest.raises(ValueError, match="type 1"):
        apply_changes(feed(spark, *parts[0]), target, checkpoint, scd=2, **clear, **APPLY)


def test_fold_waits_until_batches_outgrow_the_base(spark, folder, rows):
    target, checkpoint, src = f"{folder}/t", f"{folder}/c", f"{folder}/src"

    def run(first, last, files):
        part = spark.range(first, last).selectExpr("id", "'x' AS name", "'UPDATE' AS op", "id AS seq")
        apply_changes(stream(spark, part, src, files), target, checkpoint, **APPLY)
        return fold_when_due(spark, target, **APPLY)

    assert not run(0, 10, 1)
    assert run(10, 30_000, 2)
    assert not run(0, 20, 2)
    current = read_current(spark, target, except_cols=["op", "seq"], **APPLY)
    assert current.count() == 30_000
    # batches inside the base are not read again
    assert sum("batch_id=" in f for f in current.inputFiles()) == 2


def test_folded_aggregate_reads_only_new_batches(spark, folder, rows):
    src, target = f"{folder}/src", f"{folder}/t"
    for low in (0, 100):
        part = spark.range(low, low + 100).selectExpr("id % 3 AS k", "id AS v")
        aggregate_flow(stream(spark, part, src, 3), target, f"{folder}/c", keys=["k"], value="v")
        assert fold_aggregate(spark, target, ["k"], ratio=0.5)
        merged = read_aggregate(spark, target, ["k"])
        assert not any("batch_id=" in f for f in merged.inputFiles())
    want = spark.range(200).selectExpr("id % 3 AS k", "id AS v").groupBy("k").agg({"v": "sum"})
    assert rows(merged, "k", "total") == rows(want)
