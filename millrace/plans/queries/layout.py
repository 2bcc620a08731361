"""File layout, plan hints and diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.diagnostics import (
    file_profile,
    run_trends,
    skew_profile as profile_skew,
    skippable_files,
)
from millrace.plans.catalog import query
from millrace.plans.queries.common import NET_PRICE_SQL, net_total, total
from millrace.session import cached
from millrace.sinks.layout import (
    append_clustered,
    buckets_for,
    compact,
    set_clustering,
    write_bucketed,
    write_clustered,
)

_LINES_SQL = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem
"""


@query(
    """
    SELECT o_orderstatus, count(*) AS n_orders FROM orders WHERE o_orderpriority = '3-MEDIUM'
    GROUP BY o_orderstatus
    """
)
def partition_pruned_read(t):
    path = t.scratch("orders-partitioned")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    orders.write.partitionBy("o_orderpriority").parquet(path)
    return (
        t.spark.read.parquet(path)
        .where("o_orderpriority = '3-MEDIUM'")
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("n_orders"))
    )


@query(
    f"""
    SELECT o_orderstatus, count(*) AS n_lines, CAST(sum({NET_PRICE_SQL}) AS DOUBLE) AS revenue
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderstatus
    """
)
def bucketed_join(t):
    """Both sides bucketed on the join key: the join itself needs no shuffle."""
    orders, lines = t.table_name("orders"), t.table_name("lines")
    buckets = buckets_for(t.lineitem)
    write_bucketed(
        t.orders.select("o_orderkey", "o_orderstatus"),
        orders, t.scratch("orders-bucketed"), "o_orderkey", buckets,
    )
    write_bucketed(
        t.lineitem.select("l_orderkey", "l_extendedprice", "l_discount"),
        lines, t.scratch("lines-bucketed"), "l_orderkey", buckets,
    )
    left, right = t.spark.table(orders).hint("merge"), t.spark.table(lines)
    return (
        left.join(right, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("n_lines"), net_total().alias("revenue"))
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders
    """
)
def compact_files(t):
    small, large = t.scratch("orders-small"), t.scratch("orders-compact")
    t.orders.repartition(24).write.parquet(small)
    compact(t.spark, small, large)
    return t.spark.read.parquet(large)


@query(_LINES_SQL)
def zorder_layout(t):
    """Every line is still there after the rewrite; only the file bounds change."""
    path = t.scratch("lines-zorder")
    write_clustered(t.lineitem, path, ["l_partkey", "l_shipdate"])
    return t.spark.read.parquet(path)


@query()
def zorder_file_overlap(t):
    """Files a one-column range must read under the clustered and the arrival-order layout."""
    plain, clustered = t.scratch("lines-plain"), t.scratch("lines-clustered")
    t.lineitem.repartition(16).write.parquet(plain)
    write_clustered(t.lineitem, clustered, ["l_partkey", "l_suppkey"], 16)
    top = t.part.agg(F.max("p_partkey")).scalar()
    out = None
    for layout, path in (("arrival", plain), ("clustered", clustered)):
        profile = file_profile(t.spark.read.parquet(path), ["l_partkey", "l_suppkey"])
        row = skippable_files(profile, "l_partkey", F.lit(0), top / 10).withColumn(
            "layout", F.lit(layout)
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def cluster_by_columns(t):
    """Clustering columns may change between appends: files already there keep theirs."""
    path = t.scratch("events-clustered")
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    set_clustering(t.spark, path, ["event_type", "ts"])
    append_clustered(t.events.where(~late).select(*columns), path)
    set_clustering(t.spark, path, ["user_id", "ts"])
    append_clustered(t.events.where(late).select(*columns), path)
    return t.spark.read.parquet(path)


@query()
def file_skipping_profile(t):
    path = t.scratch("orders-ranged")
    t.orders.repartitionByRange(8, "o_orderdate").write.parquet(path)
    return file_profile(t.spark.read.parquet(path), ["o_orderdate", "o_totalprice"])


@query(
    """
    SELECT count(*) AS n_rows, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day,
           min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM orders
    """
)
def file_profile_totals(t):
    """The files' own rows and bounds, put together, are those of the table."""
    return file_skipping_profile(t).agg(
        F.sum("rows").alias("n_rows"),
        F.min("min_o_orderdate").alias("first_day"),
        F.max("max_o_orderdate").alias("last_day"),
        F.min("min_o_totalprice").alias("lowest"),
        F.max("max_o_totalprice").alias("highest"),
    )


@query("SELECT max(l_partkey) AS top, TRUE AS fewer_read FROM lineitem")
def zorder_fewer_files(t):
    """A range on a clustered column reads fewer files than in arrival order."""
    files = lambda layout: F.max(F.when(F.col("layout") == layout, F.col("files_read")))
    seen = zorder_file_overlap(t).agg((files("clustered") < files("arrival")).alias("fewer_read"))
    return seen.withColumn("top", t.lineitem.agg(F.max("l_partkey")).scalar())


@query("SELECT 6 AS wide, 2 AS narrow, count(*) AS n_lines FROM lineitem")
def repartition_coalesce(t):
    """Partition counts after a full reshuffle and after merging without one."""
    wide = t.lineitem.select("l_orderkey").repartition(6, "l_orderkey")
    narrow = wide.coalesce(2)
    counts = narrow.agg(F.count("*").alias("n_lines"))
    return counts.select(
        F.lit(wide.rdd.getNumPartitions()).alias("wide"),
        F.lit(narrow.rdd.getNumPartitions()).alias("narrow"),
        "n_lines",
    )


@query(
    """
    WITH slim AS (
        SELECT l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
        FROM lineitem GROUP BY l_suppkey)
    SELECT 'suppliers' AS figure, CAST(count(*) AS DOUBLE) AS value FROM slim
    UNION ALL SELECT 'largest', max(quantity) FROM slim
    """
)
def cached_reuse(t):
    """One aggregate, cached while two reports are written from it, then released."""
    path = t.scratch("supplier-report")
    sums = t.lineitem.groupBy("l_suppkey").agg(total("l_quantity").alias("quantity"))
    with cached(sums) as slim:
        suppliers = slim.agg(F.count("*").cast("double").alias("value"))
        largest = slim.agg(F.max("quantity").alias("value"))
        for figure, report in (("suppliers", suppliers), ("largest", largest)):
            report.withColumn("figure", F.lit(figure)).write.mode("append").parquet(path)
    return t.spark.read.parquet(path).select("figure", "value")


@query(
    """
    WITH sizes AS (
        SELECT CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_partkey END AS k, count(*) AS n
        FROM lineitem GROUP BY 1)
    SELECT count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_rows, max(n) AS max_rows,
           median(n) AS median_rows, max(n) / median(n) AS max_to_median
    FROM sizes
    """
)
def skew_profile(t):
    key = F.when(F.col("l_returnflag") == "A", F.lit(0)).otherwise(F.col("l_partkey"))
    return profile_skew(t.lineitem.select(key.alias("k")), ["k"])


@query(
    """
    WITH runs AS (
        SELECT user_id AS job, CAST(ts AS DATE) AS run_day,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS duration,
               max(CASE WHEN event_type = 'view' THEN value ELSE 0 END) AS queue_minutes,
               bool_or(event_type = 'error') AS failed
        FROM events GROUP BY ALL),
    jobs AS (
        SELECT job, median(duration) AS median_duration,
               CAST(count(*) FILTER (WHERE failed) AS DOUBLE) / count(*) AS failure_rate
        FROM runs GROUP BY job)
    SELECT r.*, median_duration, failure_rate,
           duration >= 3 * median_duration AS regressed, queue_minutes > 5 AS cold_start
    FROM runs r JOIN jobs USING (job)
    """
)
def run_trend_flags(t):
    """One run per user and day; a job's history is at most one run per day."""
    runs = t.events.groupBy(
        F.col("user_id").alias("job"), F.col("ts").cast("date").alias("run_day")
    ).agg(
        total("value").alias("duration"),
        F.max(F.when(F.col("event_type") == "view", F.col("value")).otherwise(0.0)).alias(
            "queue_minutes"
        ),
        F.bool_or(F.col("event_type") == "error").alias("failed"),
    )
    return run_trends(runs, "job", "duration", "queue_minutes", "failed")


@query(
    f"""
    SELECT r_name, CAST(sum({NET_PRICE_SQL}) AS DOUBLE) AS revenue, count(*) AS n_lines
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name
    """
)
def for_each_region(t):
    """All regions in one job instead of one job per region."""
    return (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name")
        .agg(net_total().alias("revenue"), F.count("*").alias("n_lines"))
    )
