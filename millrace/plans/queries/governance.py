"""Row filters, masks, tag policies, audit lookups and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.governance import (
    Mask,
    RowRule,
    apply_masks,
    apply_row_filter,
    apply_tag_policies,
    export_share,
    read_share,
)
from millrace.plans.catalog import query
from millrace.plans.queries.common import total


def placed_customers(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", F.col("r_name").alias("region")
    )


_RULES = [
    RowRule("dunning", "c_acctbal < 0"),
    RowRule("machinery-desk", "c_mktsegment = 'MACHINERY'"),
    RowRule("auditors"),
]


@query(
    """
    SELECT c_custkey, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    WHERE c_acctbal < 0 OR c_mktsegment = 'MACHINERY'
    """
)
def row_filter_region(t):
    visible = apply_row_filter(placed_customers(t), _RULES, {"dunning", "machinery-desk"})
    return visible.select("c_custkey", "region")


@query(
    """
    SELECT c_custkey, left(c_name, 9) || '..' AS c_name, c_acctbal,
           CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer
    """
)
def column_mask(t):
    masks = {
        "c_name": Mask("name-readers", "concat(left({value}, 9), '..')"),
        "c_acctbal": Mask("ledger", "0.0"),
        "c_mktsegment": Mask("sales", "NULL"),
    }
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return apply_masks(rows, masks, {"ledger"})


@query(
    """
    SELECT s_suppkey, left(s_name, 3) || '/' || length(s_name) AS hidden FROM supplier
    WHERE s_acctbal BETWEEN -100 AND 5000
    """
)
def sql_scalar_functions(t):
    """A row filter and a mask as SQL functions, callable from any SQL text of the session."""
    spark = t.view("supplier")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION within(amount DOUBLE, low DOUBLE, high DOUBLE) "
        "RETURNS BOOLEAN RETURN amount BETWEEN low AND high"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION outline(value STRING) "
        "RETURNS STRING RETURN concat(left(value, 3), '/', length(value))"
    )
    return spark.sql(
        "SELECT s_suppkey, outline(s_name) AS hidden FROM supplier WHERE within(s_acctbal, -100, 5000)"
    )


@query(
    """
    SELECT 'customer' AS source, c_custkey AS id, left(c_name, 2) || '#' AS name,
           CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, left(s_name, 2) || '#', NULL FROM supplier
    """
)
def tag_policy_mask(t):
    """One policy per tag protects the tagged columns of both tables."""
    policies = {
        "pii": Mask("name-readers", "concat(left({value}, 2), '#')"),
        "money": Mask("finance", "NULL"),
    }
    customers = apply_tag_policies(
        t.customer, {"c_name": {"pii"}, "c_acctbal": {"money"}}, policies, {"analysts"}
    )
    suppliers = apply_tag_policies(
        t.supplier, {"s_name": {"pii"}, "s_acctbal": {"money"}}, policies, {"analysts"}
    )
    return customers.select(
        F.lit("customer").alias("source"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    ).unionByName(
        suppliers.select(
            F.lit("supplier").alias("source"),
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            F.col("s_acctbal").alias("balance"),
        )
    )


@query(
    """
    SELECT 'user' || user_id AS caller, count(DISTINCT event_type) AS kinds, max(ts) AS last_seen
    FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY AND event_type <> 'view'
    GROUP BY user_id ORDER BY kinds DESC, last_seen DESC, caller LIMIT 25
    """
)
def audit_recent_access(t):
    """Events as an audit log; who made the most kinds of change in its last three days."""
    audit = t.events.select(
        F.col("ts").alias("at"),
        F.struct(F.concat(F.lit("user"), "user_id").alias("name")).alias("caller"),
        F.struct("event_type", "event_id").alias("call"),
    )
    newest = audit.agg(F.max("at").alias("m")).scalar()
    return (
        audit.where(F.col("call.event_type") != "view")
        .where(F.col("at") >= newest - F.expr("INTERVAL 3 DAYS"))
        .groupBy(F.col("caller.name").alias("caller"))
        .agg(F.count_distinct("call.event_type").alias("kinds"), F.max("at").alias("last_seen"))
        .orderBy(F.desc("kinds"), F.desc("last_seen"), "caller")
        .limit(25)
    )


def _shared(t, path):
    daily = t.orders.groupBy(
        F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority"
    ).agg(total("o_totalprice").alias("revenue"))
    return export_share(
        daily, path, "daily_revenue", ["o_orderpriority"], "day >= DATE '2000-01-01'"
    )


@query(
    """
    SELECT 'daily_revenue' AS table_name, o_orderpriority,
           count(DISTINCT CAST(o_orderdate AS DATE)) AS rows
    FROM orders WHERE o_orderdate >= DATE '2000-01-01' GROUP BY o_orderpriority
    """
)
def share_export(t):
    return _shared(t, t.scratch("share"))


@query(
    """
    SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders WHERE o_orderdate >= DATE '2001-01-01' GROUP BY ALL
    """
)
def shared_read(t):
    """The consumer's query over the exported slice."""
    path = t.scratch("share")
    _shared(t, path)
    return read_share(t.spark, path, "daily_revenue").where("day >= DATE '2001-01-01'")
