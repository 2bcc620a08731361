"""Projections, filters, subqueries, set operations and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from millrace.operators.dedup import first_per_key
from millrace.plans.catalog import query
from millrace.plans.queries.common import NET_PRICE_SQL, net_units, total
from millrace.sinks.tables import conform


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate AS ship_time,
           CAST(l_shipdate AS DATE) AS ship_date, CAST({NET_PRICE_SQL} AS DOUBLE) AS net_amount
    FROM lineitem WHERE {NET_PRICE_SQL} > 1000
    """
)
def column_manipulation(t):
    return (
        t.lineitem.withColumn("net_amount", net_units() / 10_000)
        .withColumnRenamed("l_shipdate", "ship_time")
        .withColumn("ship_date", F.col("ship_time").cast("date"))
        .where("net_amount > 1000")
        .drop("l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey")
        .drop("l_returnflag", "l_linestatus")
    )


@query(
    """
    SELECT event_id, user_id % 10 AS user_group, CAST(ts AS DATE) AS day, value * 2 AS doubled,
           upper(event_type) AS kind
    FROM events
    """
)
def select_expr(t):
    return t.events.selectExpr(
        "event_id",
        "user_id % 10 AS user_group",
        "CAST(ts AS DATE) AS day",
        "value * 2 AS doubled",
        "upper(event_type) AS kind",
    )


@query(
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           TRY_CAST(event_type AS DOUBLE) AS not_a_number,
           CAST(CAST(value AS DECIMAL(19,4)) AS VARCHAR) AS exact_value
    FROM events
    """
)
def cast_clean(t):
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.col("event_type").try_cast("double").alias("not_a_number"),
        F.col("value").cast("decimal(19,4)").cast("string").alias("exact_value"),
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'high'
                            WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'low' END AS tier
    FROM orders
    """
)
def tiering(t):
    tier = (
        F.when(F.col("o_totalprice") >= 300000, "high")
        .when(F.col("o_totalprice") >= 100000, "medium")
        .otherwise("low")
    )
    return t.orders.select("o_orderkey", tier.alias("tier"))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem
    WHERE l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 10 AND 30 AND l_discount != 0.05
      AND l_shipdate IS NOT NULL AND (l_tax < 0.02 OR l_linestatus = 'F')
    """
)
def filter_predicates(t):
    return t.lineitem.where(
        F.col("l_returnflag").isin("A", "R")
        & F.col("l_quantity").between(10, 30)
        & (F.col("l_discount") != 0.05)
        & F.col("l_shipdate").isNotNull()
        & ((F.col("l_tax") < 0.02) | (F.col("l_linestatus") == "F"))
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")


@query(
    "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) > 1998 "
    "AND o_orderstatus <> 'F'"
)
def filter_expr_string(t):
    return t.orders.where("year(o_orderdate) > 1998 AND o_orderstatus <> 'F'").select(
        "o_orderkey", "o_totalprice"
    )


@query("SELECT DISTINCT p_brand, p_type FROM part")
def select_distinct(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("SELECT * EXCLUDE (props, ts) FROM events")
def select_except(t):
    return t.view("events").sql("SELECT * EXCEPT (props, ts) FROM events")


@query(
    """
    SELECT event_id, user_id AS user_key, event_type AS kind, CAST(ts AS DATE) AS day
    FROM events WHERE event_type <> 'view'
    """
)
def nested_fields(t):
    packed = t.events.select(
        "event_id",
        F.struct(
            F.struct(F.col("user_id").alias("id")).alias("user"),
            F.col("event_type").alias("kind"),
            F.col("ts").cast("date").alias("day"),
        ).alias("event"),
    )
    return packed.where(F.col("event.kind") != "view").select(
        "event_id",
        F.col("event.user.id").alias("user_key"),
        F.col("event.kind").alias("kind"),
        F.col("event.day").alias("day"),
    )


@query(
    """
    SELECT event_id, ts, event_type FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events WHERE event_type = 'signup')
    """
)
def scalar_subquery_filter(t):
    events = t.events
    day = F.col("ts").cast("date")
    newest = events.where("event_type = 'signup'").agg(F.max(day)).scalar()
    return events.where(day == newest).select("event_id", "ts", "event_type")


@query(
    "SELECT c_mktsegment, count(*) AS n_customers FROM customer WHERE c_acctbal > 0 "
    "GROUP BY c_mktsegment"
)
def temp_view_sql(t):
    t.customer.where("c_acctbal > 0").createOrReplaceTempView("solvent_customers")
    return t.spark.sql(
        "SELECT c_mktsegment, count(*) AS n_customers FROM solvent_customers GROUP BY c_mktsegment"
    )


@query(
    """
    SELECT CAST(o_orderdate AS DATE) AS day,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL
    """
)
def filtered_view_agg(t):
    t.orders.where("o_orderpriority = '1-URGENT'").createOrReplaceTempView("urgent_orders")
    return (
        t.spark.table("urgent_orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("day"))
        .agg(total("o_totalprice").alias("total"))
    )


@query(
    """
    WITH per_order AS (
        SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
        FROM lineitem GROUP BY l_orderkey),
    sized AS (
        SELECT *, CASE WHEN quantity >= 150 THEN 'large' ELSE 'small' END AS size FROM per_order)
    SELECT size, count(*) AS n_orders, max(quantity) AS max_quantity FROM sized GROUP BY size
    """
)
def cte_chain(t):
    return t.view("lineitem").sql(
        """
        WITH per_order AS (
            SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
            FROM lineitem GROUP BY l_orderkey),
        sized AS (
            SELECT *, CASE WHEN quantity >= 150 THEN 'large' ELSE 'small' END AS size
            FROM per_order)
        SELECT size, count(*) AS n_orders, max(quantity) AS max_quantity FROM sized GROUP BY size
        """
    )


@query(
    """
    SELECT count(*) AS n_rows,
           count(*) FILTER (WHERE quality IS NULL OR toxic IS NULL) AS rows_with_null,
           count(*) FILTER (WHERE quality IS NULL) AS null_quality,
           count(*) FILTER (WHERE toxic IS NULL) AS null_toxic,
           count(*) FILTER (WHERE text IS NULL) AS null_text
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def null_audit(t):
    required = ["quality", "toxic", "text"]
    labelled = t.documents.select("doc_id", "text").join(t.labels, "doc_id", "left")
    return labelled.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("quality").isNull() | F.col("toxic").isNull()).alias("rows_with_null"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required],
    )


@query(
    """
    SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           CAST(o_orderdate AS DATE) AS order_date,
           CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DOUBLE) AS amount
    FROM orders
    """
)
def declared_schema_projection(t):
    declared = T.StructType(
        [
            T.StructField("order_id", T.LongType(), metadata={"comment": "Order identifier."}),
            T.StructField("customer_id", T.StringType(), metadata={"comment": "Buyer."}),
            T.StructField("order_date", T.DateType(), metadata={"comment": "Day of the order."}),
            T.StructField("amount", T.DecimalType(19, 4), metadata={"comment": "Total."}),
        ]
    )
    renamed = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
    )
    return conform(renamed, declared).withColumn("amount", F.col("amount").cast("double"))


@query(
    """
    SELECT custkey, count(*) AS n_rows FROM (
        SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT c_custkey FROM customer) GROUP BY custkey
    """
)
def union_all(t):
    buyers = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey"))
    everyone = t.customer.select(F.col("c_custkey").alias("custkey"))
    return buyers.unionAll(everyone).groupBy("custkey").agg(F.count("*").alias("n_rows"))


@query(
    """
    SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'
    UNION SELECT c_custkey FROM customer WHERE c_acctbal > 9000
    """
)
def union_distinct(t):
    buyers = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey"))
    rich = t.customer.where("c_acctbal > 9000").select(F.col("c_custkey").alias("custkey"))
    return buyers.union(rich).distinct()


@query("SELECT DISTINCT * FROM lineitem")
def dedup_rows(t):
    """Every line twice, then whole-row deduplication."""
    return t.lineitem.unionAll(t.lineitem).dropDuplicates()


@query(
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                   ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
        FROM lineitem) WHERE rn = 1
    """
)
def dedup_keys(t):
    """Which of several rows stays is fixed by a full ordering, so reruns agree."""
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    rows = t.lineitem.select("l_orderkey", "l_linenumber", *order)
    return first_per_key(rows, ["l_orderkey", "l_linenumber"], order)
