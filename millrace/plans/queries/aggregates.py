"""Aggregations, windows over aggregates, sorting and top-k."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from millrace.operators.dedup import latest_per_key
from millrace.operators.distinct import distinct_counts
from millrace.operators.grouped import map_groups
from millrace.plans.catalog import query
from millrace.plans.queries.common import NET_PRICE_SQL, cents, exact_sum, net_total, total


@query(
    f"""
    SELECT l_returnflag, l_linestatus,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_base,
           CAST(sum({NET_PRICE_SQL}) AS DOUBLE) AS revenue,
           count(*) AS n_lines
    FROM lineitem GROUP BY ALL
    """
)
def scan_parquet(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        total("l_quantity").alias("sum_qty"),
        total("l_extendedprice").alias("sum_base"),
        net_total().alias("revenue"),
        F.count("*").alias("n_lines"),
    )


@query(
    """
    SELECT CAST(o_orderdate AS DATE) AS booked_on,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS booked,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE)
               AS still_open,
           count(DISTINCT o_orderpriority) AS priorities, count(DISTINCT o_custkey) AS buyers,
           avg(o_custkey) AS mean_key, max(o_orderkey) AS last_order
    FROM orders GROUP BY ALL
    """
)
def agg_daily_revenue(t):
    open_price = F.when(F.col("o_orderstatus") == "O", cents("o_totalprice"))
    return t.orders.groupBy(F.col("o_orderdate").cast("date").alias("booked_on")).agg(
        total("o_totalprice").alias("booked"),
        exact_sum(open_price, 100).alias("still_open"),
        F.count_distinct("o_orderpriority").alias("priorities"),
        F.count_distinct("o_custkey").alias("buyers"),
        F.avg("o_custkey").alias("mean_key"),
        F.max("o_orderkey").alias("last_order"),
    )


@query(
    """
    SELECT o.o_orderstatus, count(*) AS n_rows, count(l.l_orderkey) AS n_lines,
           count(1) AS n_literal
    FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY ALL
    """
)
def agg_counts(t):
    lines = t.lineitem.select("l_orderkey")
    return (
        t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_orderstatus")
        .agg(
            F.count("*").alias("n_rows"),
            F.count("l_orderkey").alias("n_lines"),
            F.count(F.lit(1)).alias("n_literal"),
        )
    )


@query(
    """
    SELECT l_shipdate::DATE AS ship_date, l_returnflag,
           count(*) FILTER (WHERE l_quantity > 25) AS big_lines,
           count(*) FILTER (WHERE l_discount > 0.05) AS discounted_lines
    FROM lineitem GROUP BY ALL
    """
)
def agg_count_if(t):
    return t.lineitem.groupBy(
        F.col("l_shipdate").cast("date").alias("ship_date"), "l_returnflag"
    ).agg(
        F.count_if(F.col("l_quantity") > 25).alias("big_lines"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted_lines"),
    )


@query(
    """
    SELECT o_custkey, count(DISTINCT o_orderstatus) AS status_count,
           count(DISTINCT o_orderpriority) AS priority_count,
           count(DISTINCT CAST(o_orderdate AS DATE)) AS day_count
    FROM orders GROUP BY o_custkey
    """
)
def agg_multi_distinct(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count_distinct("o_orderstatus").alias("status_count"),
        F.count_distinct("o_orderpriority").alias("priority_count"),
        F.count_distinct(F.col("o_orderdate").cast("date")).alias("day_count"),
    )


@query("SELECT count(DISTINCT o_custkey) AS exact_customers, true AS within_error FROM orders")
def agg_approx_distinct(t):
    """The sketch has a standard error of 5 %; three of them bound it in practice."""
    both = t.orders.agg(
        F.count_distinct("o_custkey").alias("exact_customers"),
        F.approx_count_distinct("o_custkey", rsd=0.05).alias("approx"),
    )
    error = F.abs(F.col("approx") - F.col("exact_customers")) / F.col("exact_customers")
    return both.select("exact_customers", (error <= 0.15).alias("within_error"))


@query(
    """
    SELECT count(o_totalprice) AS n,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean,
           round(stddev_samp(o_totalprice), 2) AS stddev,
           min(o_totalprice) AS min, quantile_disc(o_totalprice, 0.25) AS q25,
           quantile_disc(o_totalprice, 0.5) AS q50, quantile_disc(o_totalprice, 0.75) AS q75,
           max(o_totalprice) AS max
    FROM orders
    """
)
def agg_summary(t):
    from millrace.operators.quantiles import exact_quantiles

    orders = t.orders.select("o_totalprice")
    q25, q50, q75 = exact_quantiles(orders, "o_totalprice", [0.25, 0.5, 0.75])
    return orders.agg(
        F.count("o_totalprice").alias("n"),
        (total("o_totalprice") / F.count("*")).alias("mean"),
        F.round(F.stddev_samp("o_totalprice"), 2).alias("stddev"),
        F.min("o_totalprice").alias("min"),
        F.lit(q25).alias("q25"),
        F.lit(q50).alias("q50"),
        F.lit(q75).alias("q75"),
        F.max("o_totalprice").alias("max"),
    )


@query(
    """
    SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           count(o_orderkey) AS invoices, max(o_custkey) AS last_customer
    FROM orders GROUP BY ALL
    """
)
def agg_dict(t):
    totals = (
        t.orders.withColumn("cents", cents("o_totalprice"))
        .groupBy("o_orderpriority")
        .agg({"cents": "sum", "o_orderkey": "count", "o_custkey": "max"})
    )
    return totals.select(
        "o_orderpriority",
        (F.col("sum(cents)") / 100).alias("revenue"),
        F.col("count(o_orderkey)").alias("invoices"),
        F.col("max(o_custkey)").alias("last_customer"),
    )


@query(
    """
    SELECT CAST(ts AS DATE) AS day, user_id, arg_min(event_type, ts) AS first_type,
           arg_max(event_type, ts) AS last_type, arg_max(value, ts) AS last_value
    FROM events GROUP BY ALL
    """
)
def agg_first_last_by_time(t):
    return t.events.groupBy(F.col("ts").cast("date").alias("day"), "user_id").agg(
        F.min_by("event_type", "ts").alias("first_type"),
        F.max_by("event_type", "ts").alias("last_type"),
        F.max_by("value", "ts").alias("last_value"),
    )


@query(
    """
    SELECT l_returnflag, year(l_shipdate) AS ship_year,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem GROUP BY ALL
    """
)
def agg_group_by_all(t):
    return t.view("lineitem").sql(
        """
        SELECT l_returnflag, CAST(year(l_shipdate) AS BIGINT) AS ship_year,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
        FROM lineitem GROUP BY ALL
        """
    )


@query(
    """
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS lifetime_value
    FROM orders GROUP BY o_custkey HAVING lifetime_value > 2500000
    """
)
def agg_having(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg(total("o_totalprice").alias("lifetime_value"))
        .where("lifetime_value > 2500000")
    )


@query(
    """
    SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS monthly_revenue
    FROM orders GROUP BY ALL
    """
)
def agg_monthly(t):
    month = F.date_trunc("month", "o_orderdate").cast("date").alias("month")
    return t.orders.groupBy("o_orderpriority", month).agg(
        total("o_totalprice").alias("monthly_revenue")
    )


@query(
    """
    SELECT o_orderpriority,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(DISTINCT o_custkey)
               AS revenue_per_customer
    FROM orders GROUP BY ALL
    """
)
def agg_ratio(t):
    return t.orders.groupBy("o_orderpriority").agg(
        (total("o_totalprice") / F.count_distinct("o_custkey")).alias("revenue_per_customer")
    )


@query(
    """
    SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'error') AS had_error,
           bool_or(value > 100) AS had_big_value
    FROM events GROUP BY ALL
    """
)
def agg_bool_any(t):
    return t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.bool_or(F.col("event_type") == "error").alias("had_error"),
        (F.max(F.when(F.col("value") > 100, 1).otherwise(0)) > 0).alias("had_big_value"),
    )


_DAILY_SQL = """
    SELECT CAST(o_orderdate AS DATE) AS day,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders GROUP BY 1
"""


def daily_revenue(orders):
    return orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        total("o_totalprice").alias("revenue")
    )


@query(
    f"""
    SELECT min(day) AS first_day, max(day) AS last_day, arg_max(revenue, day) AS last_revenue
    FROM ({_DAILY_SQL})
    """
)
def agg_global_bounds(t):
    return daily_revenue(t.orders).agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.max_by("revenue", "day").alias("last_revenue"),
    )


@query(
    f"""
    SELECT CAST(date_trunc('month', day) AS DATE) AS month, max(revenue) AS best_day,
           min(revenue) AS worst_day, count(*) AS active_days
    FROM ({_DAILY_SQL}) GROUP BY 1
    """
)
def agg_nested(t):
    month = F.date_trunc("month", "day").cast("date").alias("month")
    return (
        daily_revenue(t.orders)
        .groupBy(month)
        .agg(
            F.max("revenue").alias("best_day"),
            F.min("revenue").alias("worst_day"),
            F.count("*").alias("active_days"),
        )
    )


@query(
    """
    SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order,
           count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
    FROM orders
    """
)
def kpi_scalars(t):
    return t.orders.agg(
        total("o_totalprice").alias("total_revenue"),
        (total("o_totalprice") / F.count("*")).alias("avg_order"),
        F.count("*").alias("n_orders"),
        F.count_distinct("o_custkey").alias("n_customers"),
    )


@query(
    """
    SELECT o_custkey, year(o_orderdate) AS order_year, count(*) AS total_orders
    FROM orders WHERE o_totalprice > 0 GROUP BY ALL ORDER BY total_orders DESC, order_year DESC
    """
)
def agg_top_by_year(t):
    return (
        t.orders.where("o_totalprice > 0")
        .groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("order_year"))
        .agg(F.count("*").alias("total_orders"))
        .orderBy(F.desc("total_orders"), F.desc("order_year"))
    )


@query(
    """
    SELECT CAST(date_trunc('month', ts) AS DATE) AS month, event_type,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
    FROM events GROUP BY ALL
    """
)
def agg_revenue_by_type(t):
    month = F.date_trunc("month", "ts").cast("date").alias("month")
    return t.events.groupBy(month, "event_type").agg(total("value").alias("total_value"))


@query(
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT user_id, ts, event_id, event_type, value,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1
    """
)
def window_dedup_latest(t):
    rows = t.events.select("user_id", "ts", "event_id", "event_type", "value")
    return latest_per_key(rows, ["user_id"], ["ts", "event_id"])


@query(
    """
    SELECT event_type, count(*) AS n_events,
           CAST(count(*) * 100 AS DOUBLE) / sum(count(*)) OVER () AS percent_share
    FROM events GROUP BY event_type
    """
)
def window_percent_share(t):
    """The whole-partition total is a scalar subquery, so no window gathers all groups."""
    events = t.events
    everything = events.agg(F.count("*").alias("n")).scalar()
    return (
        events.groupBy("event_type")
        .agg(F.count("*").alias("n_events"))
        .withColumn("percent_share", F.col("n_events") * F.lit(100.0) / everything)
    )


@query(
    """
    SELECT o_orderpriority, o_orderstatus, o_totalprice, o_orderkey FROM orders
    ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey
    """
)
def sort_multi(t):
    return t.orders.select(
        "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderkey"
    ).orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def limit_ordered(t):
    return t.customer.select("c_custkey", "c_name").orderBy("c_custkey").limit(10)


@query(
    """
    SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey
    ORDER BY n_orders DESC, o_custkey LIMIT 100
    """
)
def topk_customers(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg(F.count("*").alias("n_orders"))
        .orderBy(F.desc("n_orders"), "o_custkey")
        .limit(100)
    )


@query(
    """
    SELECT event_id, ts, user_id, event_type, value FROM events
    ORDER BY ts DESC, event_id DESC LIMIT 20
    """
)
def latest_n_events(t):
    return (
        t.events.select("event_id", "ts", "user_id", "event_type", "value")
        .orderBy(F.desc("ts"), F.desc("event_id"))
        .limit(20)
    )


@query(
    """
    WITH marked AS (
        SELECT user_id, ts, event_id, value,
               CASE WHEN ts - lag(ts) OVER w <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS opens
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (
        SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit FROM marked)
    SELECT user_id, CAST(visit AS BIGINT) AS visit, count(*) AS n_events, min(ts) AS began, max(ts) AS ended,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM numbered GROUP BY ALL
    """
)
def grouped_visits(t):
    """Events of each user cut into visits by pauses of more than twelve hours, in chunks of ordered
    rows: the open visit is the state that a chunk hands to the next."""
    pause = np.timedelta64(12 * 3600, "s").astype("timedelta64[us]")

    def chunk_visits(key, state, chunk):
        ts = chunk.column("ts").to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.flatnonzero(np.diff(ts) > pause) + 1))
        n_events = np.diff(starts, append=len(ts))
        began, ended = ts[starts], ts[starts + n_events - 1]
        unknown = int(np.isnat(ts).sum())  # they come first, and no pause follows them
        began[0] = ts[min(unknown, n_events[0] - 1)]
        sums = np.add.reduceat(chunk.column("cents").to_numpy(), starts)
        found = list(zip(n_events.tolist(), began.tolist(), ended.tolist(), sums.tolist()))
        visit = 1
        if state is not None:
            (_, visit, *open_), last = state
            if ts[0] - last > pause:
                found.insert(0, open_)
            else:
                found[0] = (open_[0] + found[0][0], open_[1], found[0][2], open_[3] + found[0][3])
        found = [(key[0], i, *part) for i, part in enumerate(found, visit)]
        return (found[-1], ended[-1]), found[:-1]

    known = F.coalesce(cents("value"), F.lit(0)).alias("cents")
    rows = t.events.select("user_id", "ts", "event_id", known)
    schema = "user_id long, visit long, n_events long, began timestamp_ntz, ended timestamp_ntz, cents long"
    return map_groups(
        rows, ["user_id"], ["ts", "event_id"], chunk_visits, schema,
        finish=lambda key, state: [state[0]], chunk_rows=20, frames=False,
    )


@query(
    """
    SELECT l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS n_orders,
           count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers,
           count(DISTINCT CAST(l_shipdate AS DATE)) AS n_days
    FROM lineitem GROUP BY ALL
    """
)
def agg_distinct_by_group(t):
    """Few groups, each with a large part of all rows."""
    return distinct_counts(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        {
            "n_orders": "l_orderkey",
            "n_parts": "l_partkey",
            "n_suppliers": "l_suppkey",
            "n_days": "CAST(l_shipdate AS DATE)",
        },
    )
