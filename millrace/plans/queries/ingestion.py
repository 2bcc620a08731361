"""Incremental ingestion, schema evolution and streaming flows over derived file drops."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import scratch
from millrace.plans.catalog import query
from millrace.plans.queries.common import cents, total
from millrace.sources import evolution
from millrace.sources.ingest import ingest_csv, ingest_files, ingest_json, read_ingested
from millrace.streaming.aggregates import (
    aggregate_flow,
    distinct_flow,
    fold_aggregate,
    fold_distinct,
    fold_values,
    read_aggregate,
    read_distinct,
    read_values,
    value_flow,
)
from millrace.streaming.flows import append_flow, multi_flow, read_flows

_EVENT_SCHEMA = "event_id LONG, user_id LONG, event_type STRING, value DOUBLE"


def _second_half():
    return F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")


@query(
    """
    SELECT o_orderpriority, count(*) AS n_orders, count(DISTINCT o_orderkey) AS n_keys,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders GROUP BY o_orderpriority
    """
)
def ingest_incremental(t):
    """Two drops, three runs: each run takes the files the checkpoint has not seen."""
    src, target, checkpoint = t.scratch("landing"), t.scratch("bronze"), t.scratch("checkpoint")
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    early = F.year("o_orderdate") < 1998

    def run():
        ingest_json(t.spark, f"{src}/*", target, checkpoint, max_files=4)

    t.orders.where(early).select(*columns).write.json(f"{src}/drop1")
    run()
    t.orders.where(~early).select(*columns).write.json(f"{src}/drop2")
    run()
    run()
    return (
        read_ingested(t.spark, target, checkpoint)
        .groupBy("o_orderpriority")
        .agg(
            F.count("*").alias("n_orders"),
            F.count_distinct("o_orderkey").alias("n_keys"),
            total("o_totalprice").alias("revenue"),
        )
    )


def _evolving_drops(t):
    """Events as JSON drops: the second brings ``channel`` and writes clicks' value as text."""
    src = t.scratch("landing")
    base = t.events.select("ts", "event_id", "user_id", "event_type", "value")
    base.where(~_second_half()).drop("ts").write.json(f"{src}/drop1")
    late = base.where(_second_half()).drop("ts").withColumn(
        "channel", F.concat(F.lit("ch-"), F.col("event_type"))
    )
    late.where("event_type <> 'click'").write.json(f"{src}/drop2")
    odd = late.where("event_type = 'click'").withColumn("value", F.lit("unknown"))
    odd.write.mode("append").json(f"{src}/drop2")
    return src


def _evolve(t, mode):
    src, target, checkpoint = _evolving_drops(t), t.scratch("bronze"), t.scratch("checkpoint")
    evolution.SchemaStore(t.spark, checkpoint).save(
        evolution.T.StructType.fromDDL(_EVENT_SCHEMA)
    )
    ingest_json(t.spark, f"{src}/*", target, checkpoint, mode=mode)
    return read_ingested(t.spark, target, checkpoint, mode)


@query(
    """
    SELECT event_type, count(*) AS n_rows,
           count(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1 END) AS with_channel,
           count(CASE WHEN ts < TIMESTAMP '2024-01-16' OR event_type <> 'click' THEN 1 END)
               AS with_value
    FROM events GROUP BY event_type
    """
)
def evolve_add_columns(t):
    return (
        _evolve(t, evolution.ADD)
        .groupBy("event_type")
        .agg(
            F.count("*").alias("n_rows"),
            F.count("channel").alias("with_channel"),
            F.count("value").alias("with_value"),
        )
    )


@query(
    """
    SELECT event_type, count(*) AS n_rows,
           count(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1 END) AS rescued,
           count(CASE WHEN ts < TIMESTAMP '2024-01-16' OR event_type <> 'click' THEN 1 END)
               AS with_value
    FROM events GROUP BY event_type
    """
)
def evolve_rescue(t):
    return (
        _evolve(t, evolution.RESCUE)
        .groupBy("event_type")
        .agg(
            F.count("*").alias("n_rows"),
            F.count(evolution.RESCUED).alias("rescued"),
            F.count("value").alias("with_value"),
        )
    )


@query(
    """
    SELECT event_type, count(*) AS n_rows, 'event_id,user_id,event_type,value' AS columns
    FROM events GROUP BY event_type
    """
)
def evolve_none(t):
    rows = _evolve(t, evolution.NONE).drop("_source_file", "_load_time")
    return (
        rows.groupBy("event_type")
        .agg(F.count("*").alias("n_rows"))
        .withColumn("columns", F.lit(",".join(rows.columns)))
    )


@query(
    """
    SELECT event_id, 'ch-' || event_type AS channel,
           CASE WHEN event_type = 'click' THEN 'unknown' END AS bad_value
    FROM events WHERE ts >= TIMESTAMP '2024-01-16'
    """
)
def rescued_data(t):
    """What did not fit the stored schema, read back out of the rescued JSON."""
    rescued = F.col(evolution.RESCUED)
    return (
        _evolve(t, evolution.RESCUE)
        .where(rescued.isNotNull())
        .select(
            "event_id",
            F.get_json_object(rescued, "$.channel").alias("channel"),
            F.get_json_object(rescued, "$.value").alias("bad_value"),
        )
    )


def _evolve_csv(t, mode):
    """Events as delimited drops: the second has another column order, a new column, and text for
    clicks' values."""
    src, target, checkpoint = t.scratch("landing"), t.scratch("bronze"), t.scratch("checkpoint")
    base = t.events.select("ts", "event_id", "user_id", "event_type", "value")
    base.where(~_second_half()).drop("ts").write.option("header", True).csv(f"{src}/drop1")
    ingest_csv(t.spark, f"{src}/*", target, checkpoint, mode=mode)
    value = F.when(F.col("event_type") == "click", "unknown").otherwise(F.col("value").cast("string"))
    base.where(_second_half()).select(
        value.alias("value"), F.concat(F.lit("ch-"), "event_type").alias("channel"), "event_type", "event_id", "user_id"
    ).write.option("header", True).csv(f"{src}/drop2")
    ingest_csv(t.spark, f"{src}/*", target, checkpoint, mode=mode)
    return read_ingested(t.spark, target, checkpoint, mode)


@query(
    """
    SELECT event_type, count(*) AS n_rows,
           count(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1 END) AS with_channel,
           CAST(sum(CASE WHEN ts < TIMESTAMP '2024-01-16' OR event_type <> 'click'
                         THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS total_value
    FROM events GROUP BY event_type
    """
)
def evolve_csv_columns(t):
    rows = _evolve_csv(t, evolution.ADD)
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n_rows"),
        F.count("channel").alias("with_channel"),
        total("value").alias("total_value"),
    )


@query(
    """
    SELECT event_id, 'ch-' || event_type AS channel,
           CASE WHEN event_type = 'click' THEN 'unknown' END AS bad_value
    FROM events WHERE ts >= TIMESTAMP '2024-01-16'
    """
)
def rescued_csv(t):
    """What did not fit the schema of the first drop, read back out of the rescued column."""
    rescued = F.col(evolution.RESCUED)
    return (
        _evolve_csv(t, evolution.RESCUE)
        .where(rescued.isNotNull())
        .select(
            "event_id",
            F.get_json_object(rescued, "$.channel").alias("channel"),
            F.get_json_object(rescued, "$.value").alias("bad_value"),
        )
    )


@query(
    """
    SELECT event_id, CAST(ts AS DATE) AS day, upper(event_type) AS kind,
           value * CAST(1.1 AS DOUBLE) AS gross
    FROM events WHERE value > 10
    """
)
def stream_bronze_to_silver(t):
    """A second stream reads the first one's table and writes the cleaned rows."""
    src, bronze, silver = t.scratch("landing"), t.scratch("bronze"), t.scratch("silver")
    t.events.repartition(4).write.parquet(src)
    schema = t.events.schema
    raw = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(src)
    append_flow(raw, bronze, t.scratch("checkpoint-bronze"))
    clean = (
        t.spark.readStream.schema(schema)
        .parquet(bronze)
        .where("value > 10")
        .select(
            "event_id",
            F.col("ts").cast("date").alias("day"),
            F.upper("event_type").alias("kind"),
            (F.col("value") * F.lit(1.1)).alias("gross"),
        )
    )
    append_flow(clean, silver, t.scratch("checkpoint-silver"))
    return t.spark.read.parquet(silver)


@query("SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus")
def stream_trigger_available_now(t):
    """Everything available is processed in several batches, then the stream stops."""
    src, target, checkpoint = t.scratch("landing"), t.scratch("out"), t.scratch("checkpoint")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    orders.repartition(4).write.option("header", True).csv(src)
    ingest_files(
        t.spark, src, "csv", target, checkpoint,
        schema="o_orderkey LONG, o_orderstatus STRING", max_files=2, header=True,
    )
    rows = read_ingested(t.spark, target, checkpoint, evolution.NONE)
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n_orders"))


@query(
    """
    SELECT event_type AS flow, count(*) AS n_rows, min(event_id) AS first_id,
           max(event_id) AS last_id
    FROM events GROUP BY event_type
    """
)
def multi_flow_append(t):
    """One flow per event type into the same target."""
    src, target = t.scratch("landing"), t.scratch("target")
    t.events.write.partitionBy("event_type").parquet(src)
    kinds = [
        name.removeprefix("event_type=")
        for name in scratch.child_names(t.spark, src)
        if name.startswith("event_type=")
    ]
    schema = "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, value DOUBLE, props STRING"
    flows = {
        kind: t.spark.readStream.schema(schema).parquet(f"{src}/event_type={kind}")
        for kind in kinds
    }
    multi_flow(flows, target, t.scratch("checkpoint"))
    return (
        read_flows(t.spark, target)
        .groupBy("flow")
        .agg(
            F.count("*").alias("n_rows"),
            F.min("event_id").alias("first_id"),
            F.max("event_id").alias("last_id"),
        )
    )


@query(
    """
    SELECT event_type, count(*) AS n_rows,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS average
    FROM events GROUP BY event_type
    """
)
def mv_incremental_agg(t):
    """Partial sums per micro-batch, over two runs, add up to the full recompute."""
    src, target, checkpoint = t.scratch("landing"), t.scratch("mv"), t.scratch("checkpoint")
    schema = t.events.schema

    def run():
        rows = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 2)
        rows = rows.parquet(f"{src}/*").withColumn("value", cents("value"))
        aggregate_flow(rows, target, checkpoint, keys=["event_type"], value="value")
        fold_aggregate(t.spark, target, ["event_type"])

    t.events.where(~_second_half()).repartition(4).write.parquet(f"{src}/drop1")
    run()
    t.events.where(_second_half()).repartition(4).write.parquet(f"{src}/drop2")
    run()
    merged = read_aggregate(t.spark, target, ["event_type"])
    return merged.select(
        "event_type",
        "n_rows",
        (F.col("total") / 100).alias("total"),
        (F.col("total") / 100 / F.col("n_values")).alias("average"),
    )


@query(
    """
    SELECT event_type, count(*) AS n_rows, count(value) AS n_values,
           count(DISTINCT value) AS n_distinct, min(value) AS least, max(value) AS most
    FROM events WHERE NOT (value > 60 OR value < 2) GROUP BY event_type
    """
)
def mv_after_deletes(t):
    """Distinct counts and bounds stay right when rows are taken back, some of them before they come.

    The first drop brings the early rows and takes back late ones that only the second drop brings;
    the second also takes back early rows, among them each type's largest and smallest values.
    """
    src, target, checkpoint = t.scratch("changes"), t.scratch("mv"), t.scratch("checkpoint")
    rows = t.events.select("event_type", "value", "ts")
    gone, late = F.expr("value > 60 OR value < 2"), _second_half()
    comes, goes = F.lit(1).alias("change"), F.lit(-1).alias("change")
    early_drop = rows.where(~late).select("*", comes).union(rows.where(gone & late).select("*", goes))
    late_drop = rows.where(late).select("*", comes).union(rows.where(gone & ~late).select("*", goes))
    for number, drop in enumerate((early_drop, late_drop)):
        drop.write.parquet(f"{src}/drop{number}")
        stream = t.spark.readStream.schema(drop.schema).option("maxFilesPerTrigger", 4)
        value_flow(
            stream.parquet(f"{src}/*"), target, checkpoint,
            keys=["event_type"], value="value", change="change",
        )
        fold_values(t.spark, target, ["event_type"], "value")
    return read_values(t.spark, target, ["event_type"], "value")


@query("SELECT event_type, count(DISTINCT user_id) AS n_distinct FROM events GROUP BY event_type")
def mv_distinct_bitmaps(t):
    """Distinct users per type, merged from the bitmaps of each micro-batch."""
    src, target, checkpoint = t.scratch("landing"), t.scratch("mv"), t.scratch("checkpoint")
    for number, part in enumerate((~_second_half(), _second_half())):
        t.events.where(part).select("event_type", "user_id").write.parquet(f"{src}/drop{number}")
        stream = t.spark.readStream.schema("event_type STRING, user_id LONG").parquet(f"{src}/*")
        distinct_flow(stream, target, checkpoint, keys=["event_type"], value="user_id")
        fold_distinct(t.spark, target, ["event_type"])
    return read_distinct(t.spark, target, ["event_type"])
