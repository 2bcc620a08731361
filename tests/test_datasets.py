from datetime import datetime
from graphlib import CycleError

import pytest

from millrace import scratch
from millrace.operators import eventlog
from millrace.operators.quality import DROP, FAIL, Rule
from millrace.plans.datasets import DatasetGraph, read_events


def small_graph():
    graph = DatasetGraph()

    @graph.stored("gold", inputs=["silver"], comment="per key", properties={"layer": "gold"})
    def gold(silver):
        return silver.groupBy("k").count()

    @graph.streamed("silver", inputs=["bronze"], rules=[Rule("has_k", "k IS NOT NULL", DROP)])
    def silver(bronze):
        return bronze.selectExpr("id", "k")

    @graph.stored("checked", inputs=["silver"], rules=[Rule("even", "id % 2 = 0")])
    def checked(silver):
        return silver

    return graph


def test_inputs_decide_the_order():
    names = [d.name for d in small_graph().order()]
    assert names.index("silver") < names.index("gold")
    assert ("bronze", "silver") in small_graph().edges()


def test_cycles_are_refused():
    graph = DatasetGraph()
    graph.stored("a", inputs=["b"])(lambda b: b)
    graph.stored("b", inputs=["a"])(lambda a: a)
    with pytest.raises(CycleError):
        graph.order()


def test_names_are_unique():
    graph = DatasetGraph()
    graph.stored("a")(lambda: None)
    with pytest.raises(ValueError):
        graph.view("a")(lambda: None)


def test_streamed_dataset_takes_only_new_rows(spark, folder, rows):
    src, out = f"{folder}/src", f"{folder}/out"

    def run():
        bronze = spark.readStream.schema("id LONG, k STRING").parquet(src)
        return small_graph().run(spark, {"bronze": bronze}, out)

    spark.sql("SELECT 1L id, 'a' k UNION ALL SELECT 2L, NULL").write.parquet(src)
    assert rows(run()["gold"]) == [("a", 1)]
    spark.sql("SELECT 3L id, 'a' k").write.mode("append").parquet(src)
    assert rows(run()["gold"]) == [("a", 2)]
    assert rows(run()["gold"]) == [("a", 2)]

    log = read_events(spark, out)
    assert log.where("event_type = 'create_update'").count() == 3
    found = eventlog.expectation_rows(log).orderBy("timestamp").collect()
    counts = [(r["name"], r["passed_records"], r["failed_records"]) for r in found]
    assert [c for c in counts if c[0] == "even"] == [("even", 0, 1), ("even", 0, 2), ("even", 0, 2)]
    streamed = [c for c in counts if c[0] == "has_k"]
    assert streamed == [("has_k", 1, 1), ("has_k", 1, 0), ("has_k", 0, 0)]
    lineage = rows(eventlog.table_lineage(log))
    assert lineage == [("bronze", "silver"), ("silver", "checked"), ("silver", "gold")]


def test_column_sources_are_recorded(spark, folder, rows):
    graph = DatasetGraph()
    graph.stored("slim", inputs=["src", "other"])(lambda src, other: src.join(other, "id"))
    graph.stored("sums", inputs=["slim"], columns={"n": "slim.id", "x": ["slim.a", "slim.b"]})(
        lambda slim: slim.groupBy("a").agg({"id": "count"}).toDF("a", "n").selectExpr("*", "1 AS x", "2 AS y")
    )
    frames = {"src": spark.sql("SELECT 1L id, 2 a"), "other": spark.sql("SELECT 1L id, 3 b")}
    graph.run(spark, frames, folder)
    log = read_events(spark, folder)
    assert rows(eventlog.column_lineage(log)) == sorted([
        ("other", "b", "slim", "b"), ("other", "id", "slim", "id"), ("src", "a", "slim", "a"),
        ("src", "id", "slim", "id"), ("slim", "a", "sums", "a"), ("slim", "id", "sums", "n"),
        ("slim", "a", "sums", "x"), ("slim", "b", "sums", "x"),
    ], key=repr)
    assert rows(eventlog.flow_progress(log), "table_name", "output_records") == [("slim", 1), ("sums", 1)]
    assert eventlog.expectation_rows(log).count() == 0


def test_fail_rule_stops_the_run(spark, folder):
    graph = DatasetGraph()

    @graph.stored("bad", inputs=["src"], rules=[Rule("never", "id < 0", FAIL)])
    def bad(src):
        return src

    with pytest.raises(Exception, match="never"):
        graph.run(spark, {"src": spark.range(3)}, folder)


def changes_graph():
    graph = DatasetGraph()
    applied = {"keys": ["id"], "sequence_by": "seq", "delete_when": "op = 'DELETE'",
               "except_cols": ["op", "seq"]}

    @graph.streamed("clean", inputs=["feed"], rules=[Rule("has_id", "id IS NOT NULL", DROP)])
    def clean(feed):
        return feed

    graph.changes("current", "clean", scd=1, **applied)
    graph.changes("history", "clean", scd=2, **applied)
    return graph


def test_changes_follow_the_feed_across_runs(spark, folder, rows):
    src, out = f"{folder}/src", f"{folder}/out"
    schema = "id LONG, v STRING, op STRING, seq LONG"

    def run(*changes):
        if changes:
            spark.createDataFrame(list(changes), schema).write.mode("append").parquet(src)
        feed = spark.readStream.schema(schema).parquet(src)
        return changes_graph().run(spark, {"feed": feed}, out)

    first = run((1, "a", "APPEND", 5), (2, "b", "APPEND", 1), (None, "x", "APPEND", 1))
    assert rows(first["current"]) == [(1, "a"), (2, "b")]
    later = run((1, "late", "UPDATE", 2), (2, None, "DELETE", 9))
    assert rows(later["current"]) == [(1, "a")]
    assert rows(later["history"]) == [(1, "a", 5, None), (1, "late", 2, 5), (2, "b", 1, 9)]
    assert rows(run()["history"]) == rows(later["history"])


def test_interval_trigger_keeps_the_streams_running(spark, folder, rows):
    src, schema = f"{folder}/src", "id LONG, v STRING, op STRING, seq LONG"
    spark.createDataFrame([(1, "a", "APPEND", 5)], schema).write.parquet(src)
    feed = spark.readStream.schema(schema).parquet(src)
    out = changes_graph().run(spark, {"feed": feed}, f"{folder}/out", trigger="1 second")
    try:
        assert rows(out["current"]) == [(1, "a")]
        assert len(spark.streams.active) == 3
    finally:
        for query in spark.streams.active:
            query.stop()


def test_changes_of_an_empty_feed(spark, folder, rows):
    spark.sql("SELECT 1L id, 'a' v, 'x' op, 1L seq").where("false").write.parquet(f"{folder}/src")
    feed = spark.readStream.schema("id LONG, v STRING, op STRING, seq LONG").parquet(f"{folder}/src")
    out = changes_graph().run(spark, {"feed": feed}, f"{folder}/out")
    assert rows(out["current"]) == [] and out["history"].columns == [
        "id", "v", "__START_AT", "__END_AT",
    ]


def test_only_append_only_inputs_are_followed(spark, folder):
    graph = DatasetGraph()
    graph.stored("table", inputs=["src"])(lambda src: src)
    graph.streamed("next", inputs=["table"])(lambda table: table)
    with pytest.raises(ValueError, match="append-only"):
        graph.run(spark, {"src": spark.range(3)}, folder)


def test_every_batch_of_a_running_stream_is_logged_once(spark, folder, rows):
    src, out = f"{folder}/src", f"{folder}/out"
    schema = "id LONG, k STRING"

    def deliver(*new):
        spark.createDataFrame(list(new), schema).coalesce(1).write.mode("append").parquet(src)

    def run(trigger):
        graph = small_graph()
        graph.run(spark, {"bronze": spark.readStream.schema(schema).parquet(src)}, out, trigger=trigger)
        return graph

    def counts():
        found = eventlog.expectation_rows(read_events(spark, out)).where("name = 'has_k'")
        return rows(found, "passed_records", "failed_records")

    deliver((1, "a"))
    graph = run("1 second")
    try:
        assert counts() == [(1, 0)]
        for k in range(3):
            deliver((10 + k, None), (20 + k, "b"))
            graph.queries["silver"].processAllAvailable()
        assert counts() == [(1, 0)] + [(1, 1)] * 3
    finally:
        graph.queries["silver"].stop()
    # the last batch is replayed: neither its rows nor its counts are there twice
    last = max(int(n) for n in scratch.child_names(spark, f"{out}/_checkpoints/silver/commits") if n.isdigit())
    fs, path = scratch._file_system(spark, f"{out}/_checkpoints/silver/commits/{last}")
    fs.delete(path, False)
    run("availableNow")
    assert counts()[:4] == [(1, 0)] + [(1, 1)] * 3 and sum(p for p, _ in counts()) == 4
    assert spark.read.parquet(f"{out}/silver/batch_id=*").count() == 4


def test_a_backfill_states_its_time(spark, folder, rows):
    graph = DatasetGraph()
    graph.stored("t", inputs=["src"])(lambda src: src)
    graph.run(spark, {"src": spark.range(3)}, folder, logged_at=datetime(2020, 2, 3, 4))
    assert rows(eventlog.flow_progress(read_events(spark, folder)), "date") == [(datetime(2020, 2, 3).date(),)]
