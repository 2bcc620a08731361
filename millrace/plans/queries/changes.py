"""Change-data queries: current state and history, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.cdc import END, START, scd1, scd2
from millrace.operators.sizing import hot_ranges
from millrace.plans.catalog import query
from millrace.plans.queries.common import change_feed
from millrace.streaming.changes import (
    apply_changes,
    fold,
    fold_when_due,
    read_current,
    read_history,
)

_FEED = {"keys": ["user_id"], "sequence_by": "ts"}
_DELETE = "operation = 'DELETE'"

_CURRENT_SQL = """
    SELECT user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'
"""
_HISTORY_SQL = """
    SELECT user_id, event_type, value, ts AS "__START_AT", next_ts AS "__END_AT" FROM (
        SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_ts FROM events)
    WHERE event_type <> 'error'
"""


@query(_CURRENT_SQL)
def scd1_current(t):
    feed = change_feed(t.events)
    return scd1(feed, delete_when=_DELETE, except_cols=["operation", "ts"], **_FEED)


@query(_HISTORY_SQL)
def scd2_history(t):
    feed = change_feed(t.events)
    return scd2(feed, delete_when=_DELETE, except_cols=["operation", "ts"], **_FEED)


@query(_HISTORY_SQL)
def scd2_hot_key_split(t):
    """The same history with the busiest keys cut into time ranges that run as separate tasks."""
    feed = change_feed(t.events)
    ranges = hot_ranges(feed, ["user_id"], "ts")
    return scd2(
        feed, delete_when=_DELETE, except_cols=["operation", "ts"], ranges=ranges, **_FEED
    )


def _shuffled_stream(t):
    """The feed as files in an order unrelated to time, two files per micro-batch."""
    src = t.scratch("feed")
    feed = change_feed(t.events)
    feed.repartition(6, F.xxhash64("ts")).write.parquet(src)
    return (
        t.spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 2).parquet(src)
    )


@query(_CURRENT_SQL)
def scd1_streamed(t):
    target, checkpoint = t.scratch("current"), t.scratch("checkpoint")
    stream = _shuffled_stream(t)
    apply_changes(stream, target, checkpoint, delete_when=_DELETE, scd=1, **_FEED)
    fold(t.spark, target, scd=1, **_FEED)
    return read_current(t.spark, target, except_cols=["operation", "ts"], **_FEED)


@query(_HISTORY_SQL)
def scd2_out_of_order(t):
    target, checkpoint = t.scratch("history"), t.scratch("checkpoint")
    stream = _shuffled_stream(t)
    apply_changes(stream, target, checkpoint, delete_when=_DELETE, scd=2, **_FEED)
    return read_history(t.spark, target, except_cols=["operation", "ts"], **_FEED)


@query(_HISTORY_SQL)
def scd2_late_changes(t):
    """Some changes of every second user come after the base was written, anywhere in the sequence."""
    target, checkpoint, src = t.scratch("history"), t.scratch("checkpoint"), t.scratch("feed")
    feed = change_feed(t.events)
    late = F.coalesce((F.col("user_id") % 2 == 0) & (F.pmod(F.xxhash64("ts"), F.lit(8)) == 0), F.lit(False))

    def arrive(rows):
        rows.write.mode("append").parquet(src)
        stream = t.spark.readStream.schema(feed.schema).parquet(src)
        apply_changes(stream, target, checkpoint, delete_when=_DELETE, scd=2, **_FEED)

    arrive(feed.where(~late))
    fold(t.spark, target, scd=2, **_FEED)
    arrive(feed.where(late))
    return read_history(t.spark, target, except_cols=["operation", "ts"], **_FEED)


_TRUNCATE = "operation = 'APPEND' AND value > 150"
_TRUNCATED_SQL = """
    WITH cut AS (SELECT max(ts) AS t FROM events WHERE event_type = 'signup' AND value > 150)
    SELECT user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
        FROM events WHERE ts > (SELECT t FROM cut))
    WHERE rn = 1 AND event_type <> 'error'
"""


@query(_TRUNCATED_SQL)
def scd1_truncate(t):
    """Sign-ups above a value empty the table; only later changes count."""
    return scd1(
        change_feed(t.events),
        delete_when=_DELETE,
        truncate_when=_TRUNCATE,
        except_cols=["operation", "ts"],
        **_FEED,
    )


@query(_TRUNCATED_SQL)
def scd1_truncate_streamed(t):
    """The same from a stream out of order: what arrives after a truncating change is cleared too."""
    target, checkpoint = t.scratch("current"), t.scratch("checkpoint")
    apply_changes(
        _shuffled_stream(t), target, checkpoint, delete_when=_DELETE, truncate_when=_TRUNCATE, **_FEED
    )
    fold_when_due(t.spark, target, **_FEED)
    return read_current(t.spark, target, except_cols=["operation", "ts"], **_FEED)


@query(
    f"""
    SELECT user_id, count(*) AS version_count, count(DISTINCT event_type) AS type_count,
           count(DISTINCT value) AS value_count,
           count(*) FILTER (WHERE "__END_AT" IS NULL) AS open_count
    FROM ({_HISTORY_SQL}) GROUP BY user_id HAVING count(*) > 1
    """
)
def scd2_change_counts(t):
    history = scd2(
        change_feed(t.events), delete_when=_DELETE, except_cols=["operation", "ts"], **_FEED
    )
    return (
        history.groupBy("user_id")
        .agg(
            F.count(START).alias("version_count"),
            F.count_distinct("event_type").alias("type_count"),
            F.count_distinct("value").alias("value_count"),
            F.count_if(F.col(END).isNull()).alias("open_count"),
        )
        .where("version_count > 1")
    )


@query(
    f"""
    SELECT 'full' AS mode, count(*) AS n_rows FROM events WHERE ts >= TIMESTAMP '2024-01-16'
    UNION ALL SELECT 'append', count(*) FROM events
    UNION ALL SELECT 'cdc', count(*) FROM ({_CURRENT_SQL})
    """
)
def sync_modes(t):
    """Two deliveries of one feed under the three modes: replace, add, apply changes."""
    feed = change_feed(t.events)
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    deliveries = [feed.where(~late), feed.where(late)]
    full, appended = t.scratch("full"), t.scratch("append")
    for delivery in deliveries:
        delivery.write.mode("overwrite").parquet(full)
        delivery.write.mode("append").parquet(appended)
    results = {
        "full": t.spark.read.parquet(full),
        "append": t.spark.read.parquet(appended),
        "cdc": scd1(t.spark.read.parquet(appended), delete_when=_DELETE, **_FEED),
    }
    out = None
    for mode, rows in results.items():
        counted = rows.agg(F.count("*").alias("n_rows")).withColumn("mode", F.lit(mode))
        out = counted if out is None else out.unionByName(counted)
    return out.select("mode", "n_rows")
