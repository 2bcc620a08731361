"""Joins: equi, outer, broadcast, sort-merge, salted, interval, lateral, anti."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.dedup import first_per_key
from millrace.operators.joins import interval_join, salted_join
from millrace.operators.sizing import broadcast_if_small, hot_slots
from millrace.plans.catalog import query
from millrace.plans.queries.common import NET_PRICE_SQL, net_total, total


@query(
    """
    SELECT o_orderkey, c_custkey, c_name, c_mktsegment, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def join_inner(t):
    buyers = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return t.orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_custkey", "c_name", "c_mktsegment", "o_totalprice"
    )


@query(
    """
    WITH firsts AS (
        SELECT l_orderkey, l_linenumber, min(l_partkey) AS first_part
        FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_partkey, first_part
    FROM lineitem JOIN firsts USING (l_orderkey, l_linenumber)
    """
)
def join_multi_key(t):
    firsts = first_per_key(
        t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("first_part")),
        ["l_orderkey", "l_linenumber"],
        ["first_part"],
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(firsts, ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    """
)
def join_left(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "o_orderstatus", "l_linenumber", "l_quantity"
    )


@query(
    """
    WITH clicks AS (
        SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM events WHERE event_type = 'click' GROUP BY ALL),
    buys AS (
        SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM events WHERE event_type = 'purchase' GROUP BY ALL),
    errors AS (
        SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n
        FROM events WHERE event_type = 'error' GROUP BY ALL)
    SELECT coalesce(c.day, b.day) AS day, coalesce(c.user_id, b.user_id) AS user_id,
           coalesce(c.n, 0) AS clicks, coalesce(b.n, 0) AS purchases,
           coalesce(e.n, 0) AS errors, coalesce(c.amount, 0) AS click_value,
           coalesce(b.amount, 0) AS purchase_value
    FROM clicks c FULL OUTER JOIN buys b ON c.day = b.day AND c.user_id = b.user_id
    LEFT JOIN errors e ON coalesce(c.day, b.day) = e.day
                      AND coalesce(c.user_id, b.user_id) = e.user_id
    """
)
def join_full_outer_flow(t):
    daily = t.events.groupBy(F.col("ts").cast("date").alias("day"), "user_id", "event_type").agg(
        F.count("*").alias("n"), total("value").alias("amount")
    )

    def of(kind, count, amount):
        rows = daily.where(F.col("event_type") == kind)
        return rows.select("day", "user_id", F.col("n").alias(count), F.col("amount").alias(amount))

    clicks = of("click", "clicks", "click_value")
    buys = of("purchase", "purchases", "purchase_value")
    errors = of("error", "errors", "error_value").drop("error_value")
    # Joining on named columns coalesces the keys of both sides for the next join.
    return (
        clicks.join(buys, ["day", "user_id"], "full_outer")
        .join(errors, ["day", "user_id"], "left")
        .na.fill(0, ["clicks", "purchases", "errors", "click_value", "purchase_value"])
    )


@query(
    f"""
    SELECT n_name, CAST(sum({NET_PRICE_SQL}) AS DOUBLE) AS revenue, count(*) AS n_lines
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name
    """
)
def join_broadcast(t):
    """Each small side is checked by itself; a joined frame's size estimate would be a product."""
    suppliers = broadcast_if_small(t.supplier.select("s_suppkey", "s_nationkey"))
    nations = broadcast_if_small(t.nation.select("n_nationkey", "n_name"))
    return (
        t.lineitem.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(net_total().alias("revenue"), F.count("*").alias("n_lines"))
    )


@query(
    f"""
    SELECT o_orderpriority, l_returnflag, count(*) AS n_lines,
           CAST(sum({NET_PRICE_SQL}) AS DOUBLE) AS revenue
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL
    """
)
def join_sort_merge(t):
    return (
        t.orders.hint("merge")
        .join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderpriority", "l_returnflag")
        .agg(F.count("*").alias("n_lines"), net_total().alias("revenue"))
    )


@query(
    """
    SELECT e.event_id AS error_id, p.event_id AS purchase_id, p.value
    FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error') e
    JOIN (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase') p
      ON p.user_id = e.user_id AND p.ts > e.ts AND p.ts < e.ts + INTERVAL 2 HOUR
    """
)
def join_range_interval(t):
    outages = t.events.where("event_type = 'error'").select(
        "user_id",
        F.col("event_id").alias("error_id"),
        F.col("ts").alias("from_ts"),
        (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("to_ts"),
    )
    purchases = t.events.where("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("at"), "value"
    )
    pairs = interval_join(outages, purchases, "from_ts", "to_ts", "at", on=["user_id"])
    return pairs.select("error_id", "purchase_id", "value")


@query(
    """
    WITH keyed AS (
        SELECT CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_partkey END AS p_partkey, l_quantity
        FROM lineitem)
    SELECT p_brand, count(*) AS n_lines,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM keyed JOIN part USING (p_partkey) GROUP BY p_brand
    """
)
def join_salted(t):
    """A third of the lines share one part; the hot key is found by a sketch, then salted."""
    part_key = F.when(F.col("l_returnflag") == "A", F.lit(0)).otherwise(F.col("l_partkey"))
    keyed = t.lineitem.select(part_key.cast("long").alias("p_partkey"), "l_quantity")
    hot = hot_slots(keyed, ["p_partkey"])
    parts = t.part.select("p_partkey", "p_brand")
    return (
        salted_join(keyed, parts, ["p_partkey"], hot=hot)
        .groupBy("p_brand")
        .agg(F.count("*").alias("n_lines"), total("l_quantity").alias("quantity"))
    )


@query(
    """
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part
    """
)
def lateral_explode(t):
    return t.view("part").sql(
        "SELECT p_partkey, word FROM part, LATERAL explode(split(p_name, ' ')) AS words(word)"
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """
)
def join_anti_unmatched(t):
    return t.orders.join(
        t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"
    ).select("o_orderkey", "o_custkey", "o_totalprice")
