"""Quality rules, quarantine, gates, and monitoring over the event log of dataset runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Observation, functions as F

from millrace.operators import eventlog
from millrace.operators.quality import (
    DROP,
    FAIL,
    Rule,
    apply_rules,
    expect_all,
    flow_metrics,
    quarantine,
    row_count_gate as gate,
    rule_metrics,
)
from millrace.plans.catalog import query
from millrace.plans.datasets import DatasetGraph, read_events

_LABELLED_SQL = "(SELECT doc_id, lang, text, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"


def labelled(t):
    """Documents with their labels; most have none, so the rules meet NULLs."""
    return t.documents.select("doc_id", "lang", "text").join(t.labels, "doc_id", "left")


_RULES = {"has_quality": "quality IS NOT NULL", "not_toxic": "toxic = 0", "long": "length(text) > 500"}


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount, n_rows, failed_quantity FROM lineitem,
        (SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT l_quantity > 5) AS failed_quantity
         FROM lineitem)
    """
)
def expect_warn(t):
    """All rows stay; the counts come from the observation of the pass that writes them."""
    seen = Observation()
    path = t.scratch("checked-lines")
    rules = [Rule("quantity", "l_quantity > 5")]
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    apply_rules(rows, rules, seen).write.parquet(path)
    counts = seen.get
    return t.spark.read.parquet(path).select(
        "*",
        F.lit(counts["input_records"]).cast("long").alias("n_rows"),
        F.lit(counts["failed_0"]).cast("long").alias("failed_quantity"),
    )


@query(f"SELECT doc_id, quality FROM {_LABELLED_SQL} WHERE toxic = 0")
def expect_drop(t):
    """A NULL label does not satisfy the rule, so unlabelled documents are dropped."""
    return apply_rules(labelled(t), [Rule("not_toxic", "toxic = 0", DROP)]).select(
        "doc_id", "quality"
    )


@query(
    f"""
    SELECT 'has_quality' AS name, count(*) FILTER (WHERE quality IS NULL) AS failed_records,
           count(*) FILTER (WHERE quality IS NULL) > 0 AS stops FROM {_LABELLED_SQL}
    UNION ALL SELECT 'has_text', count(*) FILTER (WHERE text IS NULL),
           count(*) FILTER (WHERE text IS NULL) > 0 FROM {_LABELLED_SQL}
    """
)
def expect_fail_report(t):
    """Which fail rules would stop the flow."""
    rules = expect_all({"has_quality": "quality IS NOT NULL", "has_text": "text IS NOT NULL"}, FAIL)
    report = rule_metrics(labelled(t), rules, "documents")
    return report.select("name", "failed_records", (F.col("failed_records") > 0).alias("stops"))


@query(
    f"""
    SELECT doc_id, lang FROM {_LABELLED_SQL}
    WHERE quality IS NOT NULL AND toxic = 0 AND length(text) > 500
    """
)
def expect_all_drop(t):
    return apply_rules(labelled(t), expect_all(_RULES, DROP)).select("doc_id", "lang")


@query(
    f"""
    WITH d AS (SELECT coalesce(quality IS NOT NULL, false) AS a, coalesce(toxic = 0, false) AS b,
                      coalesce(length(text) > 500, false) AS c FROM {_LABELLED_SQL})
    SELECT 'documents' AS dataset, 'has_quality' AS name, count(*) FILTER (WHERE a)
           AS passed_records, count(*) FILTER (WHERE NOT a) AS failed_records FROM d
    UNION ALL SELECT 'documents', 'not_toxic', count(*) FILTER (WHERE b),
           count(*) FILTER (WHERE NOT b) FROM d
    UNION ALL SELECT 'documents', 'long', count(*) FILTER (WHERE c),
           count(*) FILTER (WHERE NOT c) FROM d
    """
)
def quality_metrics(t):
    return rule_metrics(labelled(t), expect_all(_RULES), "documents")


@query(
    f"""
    WITH d AS (SELECT count(*) AS n,
                      count(*) FILTER (WHERE quality IS NOT NULL AND toxic = 0
                                       AND length(text) > 500) AS k FROM {_LABELLED_SQL})
    SELECT 'documents' AS dataset, k AS output_records, n - k AS dropped_records,
           (n - k) / k AS failure_rate FROM d
    """
)
def quality_flow_metrics(t):
    """Dropped counts rows failing any rule; the rate is dropped over kept."""
    return flow_metrics(labelled(t), expect_all(_RULES, DROP), "documents")


@query(
    f"""
    WITH d AS (SELECT doc_id, quality IS NOT NULL AS a, coalesce(toxic = 0, false) AS b,
                      length(text) > 500 AS c FROM {_LABELLED_SQL})
    SELECT doc_id, concat_ws(',', CASE WHEN NOT a THEN 'has_quality' END,
           CASE WHEN NOT b THEN 'not_toxic' END, CASE WHEN NOT c THEN 'long' END) AS failed
    FROM d WHERE NOT (a AND b AND c)
    """
)
def quarantine_rows(t):
    _, bad = quarantine(labelled(t), expect_all(_RULES))
    return bad.select("doc_id", F.concat_ws(",", "failed_rules").alias("failed"))


@query(
    """
    SELECT 'GREATER_THAN' AS comparator, count(*) AS row_count, count(*) > 0 AS passed FROM orders
    UNION ALL SELECT 'EQUAL_TO', count(*), count(*) = 0 FROM orders WHERE o_totalprice < 0
    """
)
def row_count_gate(t):
    some = gate(t.orders, "GREATER_THAN", 0).withColumn("comparator", F.lit("GREATER_THAN"))
    none = gate(t.orders.where("o_totalprice < 0"), "EQUAL_TO", 0).withColumn(
        "comparator", F.lit("EQUAL_TO")
    )
    return some.unionByName(none).select("comparator", "row_count", "passed")


# ---- event log ------------------------------------------------------------------------------

_FLOW_RULES = [Rule("worth_keeping", "value > 5", DROP), Rule("moderate", "value <= 100")]
#: Two runs take what came until their day; each builds a table of purchases and one of the rest.
_RUN_DAYS = (datetime(2024, 1, 16), datetime(2024, 2, 1))

_FLOWS_SQL = """
    SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN DATE '2024-01-16' ELSE DATE '2024-02-01' END AS day,
           CASE WHEN event_type = 'purchase' THEN 'purchases' ELSE 'others' END AS table_name,
           count(*) FILTER (WHERE value > 5) AS output_records,
           count(*) FILTER (WHERE NOT value > 5) AS dropped_records,
           count(*) FILTER (WHERE value <= 100) AS moderate_passed,
           count(*) FILTER (WHERE NOT value <= 100) AS moderate_failed
    FROM events GROUP BY ALL
"""


def quality_graph() -> DatasetGraph:
    graph = DatasetGraph()

    @graph.stored("purchases", inputs=["delivery"], rules=_FLOW_RULES)
    def purchases(delivery):
        return delivery.where("event_type = 'purchase'")

    @graph.stored("others", inputs=["delivery"], rules=_FLOW_RULES)
    def others(delivery):
        return delivery.where("event_type <> 'purchase'")

    return graph


def quality_log(t):
    """The event log that two runs over the halves of the events wrote."""
    folder, since = t.scratch("checked-events"), None
    rows = t.events.select("event_id", "event_type", "value", "ts")
    for day in _RUN_DAYS:
        until = rows.where(F.col("ts") < F.lit(day).cast("timestamp_ntz"))
        part = until if since is None else until.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
        quality_graph().run(t.spark, {"delivery": part}, folder, logged_at=day)
        since = day
    return read_events(t.spark, folder)


@query(
    f"""
    SELECT 'worth_keeping' AS name, table_name AS dataset, day, output_records AS passed_records,
           dropped_records AS failed_records FROM ({_FLOWS_SQL})
    UNION ALL SELECT 'moderate', table_name, day, moderate_passed, moderate_failed FROM ({_FLOWS_SQL})
    """
)
def eventlog_expectations(t):
    rules = eventlog.expectation_rows(quality_log(t))
    return rules.withColumn("day", F.col("timestamp").cast("date")).drop("timestamp", "update_id")


_SUMS_SQL = """
    CAST(sum(output_records) AS BIGINT) AS output_records,
    CAST(sum(dropped_records) AS BIGINT) AS dropped_records,
    CAST(sum(dropped_records) AS DOUBLE) / nullif(sum(output_records), 0) AS failure_rate
"""


@query(f"SELECT day AS date, {_SUMS_SQL} FROM ({_FLOWS_SQL}) GROUP BY day")
def quality_daily(t):
    return eventlog.quality_by(quality_log(t), "date")


@query(f"SELECT day AS date, table_name, {_SUMS_SQL} FROM ({_FLOWS_SQL}) GROUP BY ALL")
def quality_daily_table(t):
    return eventlog.quality_by(quality_log(t), "date", "table_name")


@query(
    f"""
    SELECT day AS date, 'worth_keeping' AS name, CAST(sum(output_records) AS BIGINT)
           AS passed_records, CAST(sum(dropped_records) AS BIGINT) AS failed_records
    FROM ({_FLOWS_SQL}) GROUP BY day
    UNION ALL SELECT day, 'moderate', CAST(sum(moderate_passed) AS BIGINT),
           CAST(sum(moderate_failed) AS BIGINT) FROM ({_FLOWS_SQL}) GROUP BY day
    """
)
def quality_daily_rule(t):
    return (
        eventlog.expectation_rows(quality_log(t))
        .groupBy(F.col("timestamp").cast("date").alias("date"), "name")
        .agg(
            F.sum("passed_records").alias("passed_records"),
            F.sum("failed_records").alias("failed_records"),
        )
    )


@query(
    f"""
    SELECT table_name, {_SUMS_SQL} FROM ({_FLOWS_SQL})
    WHERE day = (SELECT max(day) FROM ({_FLOWS_SQL})) GROUP BY table_name
    """
)
def quality_latest_table(t):
    """Only the day of the newest update."""
    latest = eventlog.latest_only(quality_log(t))
    return eventlog.quality_by(latest, "table_name")


@query(
    """
    SELECT 'worth_keeping' AS name, count(*) FILTER (WHERE value > 5) AS passed_records,
           count(*) FILTER (WHERE NOT value > 5) AS failed_records, TRUE AS by_batch FROM events
    UNION ALL SELECT 'moderate', count(*) FILTER (WHERE value <= 100),
           count(*) FILTER (WHERE NOT value <= 100), TRUE FROM events
    """
)
def stream_rule_counts(t):
    """Rule counts of a stream that keeps running: every micro-batch logs its own, also those of a
    delivery that arrives after the run has returned."""
    src, folder = t.scratch("deliveries"), t.scratch("running")
    first, second = t.events.where("event_id % 3 > 0"), t.events.where("event_id % 3 = 0")
    first.write.parquet(f"{src}/first")
    graph = DatasetGraph()

    @graph.streamed("kept", inputs=["deliveries"], rules=_FLOW_RULES)
    def kept(deliveries):
        return deliveries.select("event_id", "value")

    stream = t.spark.readStream.schema(t.events.schema).parquet(f"{src}/*")
    graph.run(t.spark, {"deliveries": stream}, folder, trigger="1 second")
    try:
        second.write.parquet(f"{src}/second")
        graph.queries["kept"].processAllAvailable()
    finally:
        graph.queries["kept"].stop()
    rules = eventlog.expectation_rows(read_events(t.spark, folder))
    return rules.groupBy("name").agg(
        F.sum("passed_records").alias("passed_records"),
        F.sum("failed_records").alias("failed_records"),
        (F.count("*") >= 2).alias("by_batch"),
    )
