"""End-to-end flows: layered billing, audited ingestion, change data, usage marts, dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions.forecast import forecast_trend
from millrace.functions.text import clean_code, is_email
from millrace.operators import eventlog
from millrace.operators.cdc import START
from millrace.operators.joins import interval_sums
from millrace.operators.merge import merge
from millrace.operators.quality import DROP, Rule, expect_all
from millrace.plans.catalog import query
from millrace.plans.datasets import DatasetGraph, read_events
from millrace.plans.queries.aggregates import _DAILY_SQL, daily_revenue
from millrace.plans.queries.common import cents, change_feed, total
from millrace.plans.queries.quality import quality_log
from millrace.plans.queries.scalars import _EMAIL_SQL, _VALID_SQL, customers_with_email
from millrace.sources.evolution import RESCUED
from millrace.sources.files import read_csv
from millrace.sources.ingest import LOAD_TIME, SOURCE_FILE, ingest_json, read_ingested

# ---- layered billing ------------------------------------------------------------------------

_SILVER_SQL = """
    SELECT o_orderkey AS invoice_id, o_custkey AS customer_id,
           CAST(o_orderdate AS DATE) AS invoice_date, o_totalprice AS amount,
           o_orderpriority AS department
    FROM orders
    WHERE o_totalprice > 3000 AND o_totalprice <= 480000
      AND NOT (o_orderstatus = 'P' AND o_totalprice < 50000)
"""


def raw_invoices(orders: DataFrame) -> DataFrame:
    """Orders as untyped text: padded lower-case codes, unreadable and negative amounts."""
    amount = (
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 50000), "n/a")
        .when(F.col("o_totalprice") > 480000, F.concat(F.lit("-"), F.col("o_totalprice")))
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    customer = F.when(F.col("o_totalprice") > 3000, F.col("o_custkey").cast("string"))
    return orders.select(
        F.col("o_orderkey").cast("string").alias("invoice_id"),
        customer.alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("invoice_date"),
        amount.alias("amount"),
        F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" ")).alias("department"),
    )


def clean_invoices(raw: DataFrame) -> DataFrame:
    """Typed and standardised; whatever does not convert is NULL and left to the rules."""
    return raw.select(
        F.col("invoice_id").try_cast("long").alias("invoice_id"),
        F.col("customer_id").try_cast("long").alias("customer_id"),
        F.try_to_date("invoice_date", "yyyy-MM-dd").alias("invoice_date"),
        F.col("amount").try_cast("double").alias("amount"),
        clean_code(F.col("department")).alias("department"),
    )


SILVER_RULES = expect_all(
    {
        "has_keys": "invoice_id IS NOT NULL AND customer_id IS NOT NULL",
        "positive_amount": "amount > 0",
    },
    DROP,
)


def billing_graph() -> DatasetGraph:
    graph = DatasetGraph()

    @graph.stored("daily_revenue", inputs=["silver"])
    def daily(silver):
        return silver.groupBy("invoice_date", "department").agg(
            total("amount").alias("total_revenue"),
            F.count_if(F.col("amount") > 100000).alias("big_invoices"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )

    @graph.stored("monthly_revenue", inputs=["silver"])
    def monthly(silver):
        month = F.date_trunc("month", "invoice_date").cast("date").alias("month")
        return silver.groupBy("department", month).agg(total("amount").alias("monthly_revenue"))

    @graph.stored("silver", inputs=["loaded", "staged"])
    def silver(loaded, staged):
        return merge(loaded, staged, ["invoice_id"])

    @graph.stored("loaded", inputs=["first_delivery"], rules=SILVER_RULES)
    def loaded(first_delivery):
        return clean_invoices(first_delivery)

    @graph.stored("staged", inputs=["second_delivery"], rules=SILVER_RULES)
    def staged(second_delivery):
        return clean_invoices(second_delivery)

    return graph


def run_billing(t, folder):
    year = F.year("o_orderdate")
    deliveries = {
        "first_delivery": raw_invoices(t.orders.where(year < 2000)),
        "second_delivery": raw_invoices(t.orders.where(year >= 1999)),
    }
    return billing_graph().run(t.spark, deliveries, folder)


@query(
    f"""
    SELECT invoice_date, department,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
           count(*) FILTER (WHERE amount > 100000) AS big_invoices,
           count(DISTINCT customer_id) AS unique_customers
    FROM ({_SILVER_SQL}) GROUP BY ALL
    """
)
def flow_billing(t):
    """Two overlapping text deliveries, cleaned by rules, upserted, aggregated per day."""
    return run_billing(t, t.scratch("billing"))["daily_revenue"]


@query(
    f"""
    SELECT department, CAST(date_trunc('month', invoice_date) AS DATE) AS month,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS monthly_revenue
    FROM ({_SILVER_SQL}) GROUP BY ALL
    """
)
def flow_billing_monthly(t):
    return run_billing(t, t.scratch("billing"))["monthly_revenue"]


@query(
    """
    WITH raw AS (
        SELECT o_totalprice > 3000 AS keyed,
               NOT (o_orderstatus = 'P' AND o_totalprice < 50000) AND o_totalprice <= 480000 AS paid,
               year(o_orderdate) AS y FROM orders),
    both_loads AS (
        SELECT 'loaded' AS dataset, * FROM raw WHERE y < 2000
        UNION ALL SELECT 'staged', * FROM raw WHERE y >= 1999)
    SELECT dataset, 'has_keys' AS name, count(*) FILTER (WHERE keyed) AS passed_records,
           count(*) FILTER (WHERE NOT keyed) AS failed_records FROM both_loads GROUP BY dataset
    UNION ALL SELECT dataset, 'positive_amount', count(*) FILTER (WHERE paid),
           count(*) FILTER (WHERE NOT paid) FROM both_loads GROUP BY dataset
    """
)
def flow_billing_quality(t):
    """Rule counts read back from the event log that the run itself wrote."""
    folder = t.scratch("billing")
    run_billing(t, folder)
    return eventlog.expectation_rows(read_events(t.spark, folder)).drop("timestamp", "update_id")


_BUILT_SQL = f"""
    SELECT 'loaded' AS output_dataset, 'first_delivery' AS inputs, count(*) AS n_rows
    FROM ({_SILVER_SQL}) WHERE year(invoice_date) < 2000
    UNION ALL SELECT 'staged', 'second_delivery', count(*) FROM ({_SILVER_SQL})
    WHERE year(invoice_date) >= 1999
    UNION ALL SELECT 'silver', 'loaded,staged', count(*) FROM ({_SILVER_SQL})
    UNION ALL SELECT 'daily_revenue', 'silver', count(*) FROM (
        SELECT DISTINCT invoice_date, department FROM ({_SILVER_SQL}))
    UNION ALL SELECT 'monthly_revenue', 'silver', count(*) FROM (
        SELECT DISTINCT date_trunc('month', invoice_date), department FROM ({_SILVER_SQL}))
"""


def billing_log(t):
    """The event log of a billing run, and the rows that it says each dataset got."""
    folder = t.scratch("billing")
    run_billing(t, folder)
    log = read_events(t.spark, folder)
    built = eventlog.flow_progress(log).select("table_name", F.col("output_records").alias("n_rows"))
    return log, built


@query(f"SELECT *, 'complete' AS flow_type FROM ({_BUILT_SQL})")
def eventlog_definitions(t):
    log, built = billing_log(t)
    stated = eventlog.definitions(log).select(
        "output_dataset", F.concat_ws(",", "input_datasets").alias("inputs"), "flow_type"
    )
    return stated.join(built, F.col("output_dataset") == F.col("table_name")).drop("table_name")


@query(
    f"""
    SELECT unnest(string_split(inputs, ',')) AS source_table, output_dataset AS target_table, n_rows
    FROM ({_BUILT_SQL})
    """
)
def lineage_table(t):
    """Edges between datasets with the rows of the target."""
    log, built = billing_log(t)
    edges = eventlog.table_lineage(log)
    return edges.join(built, F.col("target_table") == F.col("table_name")).drop("table_name")


@query(
    f"""
    SELECT 'silver' AS source_table, source_column, target_table, target_column, n_rows
    FROM (VALUES ('invoice_date', 'daily_revenue', 'invoice_date'),
                 ('department', 'daily_revenue', 'department'),
                 ('amount', 'daily_revenue', 'total_revenue'),
                 ('amount', 'daily_revenue', 'big_invoices'),
                 ('customer_id', 'daily_revenue', 'unique_customers'),
                 ('department', 'monthly_revenue', 'department'),
                 ('invoice_date', 'monthly_revenue', 'month'),
                 ('amount', 'monthly_revenue', 'monthly_revenue'))
         AS edge(source_column, target_table, target_column)
    JOIN ({_BUILT_SQL}) ON output_dataset = target_table
    """
)
def lineage_column(t):
    """Columns of the revenue tables and where each comes from, as their plans say, with the rows of the table."""
    log, built = billing_log(t)
    edges = eventlog.column_lineage(log).where("source_table = 'silver'")
    return edges.join(built, F.col("target_table") == F.col("table_name")).drop("table_name")


# ---- audited ingestion ----------------------------------------------------------------------


@query(
    """
    SELECT 'drop1' AS folder, count(*) AS n_rows, 0 AS with_coupon, min(o_orderkey) AS first_key
    FROM orders WHERE year(o_orderdate) < 1999
    UNION ALL
    SELECT 'drop2', count(*), count(*), min(o_orderkey) FROM orders WHERE year(o_orderdate) >= 1999
    """
)
def flow_ingest_audit(t):
    """Two drops, the second with a new field; rows audited per source folder."""
    src, target, checkpoint = t.scratch("landing"), t.scratch("bronze"), t.scratch("checkpoint")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    early = F.year("o_orderdate") < 1999
    t.orders.where(early).select(*columns).write.json(f"{src}/drop1")
    ingest_json(t.spark, f"{src}/*", target, checkpoint)
    coupon = F.floor(F.col("o_totalprice") / 100)
    t.orders.where(~early).select(*columns).withColumn("coupon", coupon).write.json(f"{src}/drop2")
    ingest_json(t.spark, f"{src}/*", target, checkpoint)
    folder = F.regexp_extract(SOURCE_FILE, "/(drop[0-9]+)/", 1)
    return (
        read_ingested(t.spark, target, checkpoint)
        .groupBy(folder.alias("folder"))
        .agg(
            F.count("*").alias("n_rows"),
            F.count("coupon").alias("with_coupon"),
            F.min("o_orderkey").alias("first_key"),
        )
    )


# ---- change data ----------------------------------------------------------------------------

_CLEAN_FEED_SQL = """
    SELECT user_id, event_type, value, ts FROM events WHERE value >= 1 AND value <= 200
"""


@query(
    f"""
    WITH feed AS ({_CLEAN_FEED_SQL}),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM feed)
    SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS version_count,
           count(DISTINCT CASE WHEN event_type <> 'error' THEN event_type END) AS type_count,
           bool_or(rn = 1 AND event_type <> 'error') AS is_live
    FROM ranked GROUP BY user_id
    HAVING count(*) FILTER (WHERE event_type <> 'error') > 0
    """
)
def flow_changes(t):
    """Feed files with missing keys and operations: ingest, clean, current state and history."""
    src, bronze, checkpoint = t.scratch("feed"), t.scratch("bronze"), t.scratch("checkpoint")
    feed = change_feed(t.events)
    dirty = feed.select(
        F.when(F.col("value") >= 1, F.col("user_id")).alias("user_id"),
        F.when(F.col("value") <= 200, F.substring("operation", 1, 1)).alias("code"),
        "event_type",
        "value",
        F.col("ts").cast("string").alias("operation_date"),
    )
    dirty.repartition(6).write.json(src)
    ingest_json(t.spark, src, bronze, checkpoint, max_files=3)

    graph = DatasetGraph()
    rules = [
        Rule("read_in_full", f"{RESCUED} IS NULL", DROP),
        Rule("names_a_user", "coalesce(user_id, -1) >= 0", DROP),
        Rule("one_letter_code", "length(code) = 1 AND contains('ADU', code)", DROP),
    ]

    @graph.streamed("clean", inputs=["bronze"], rules=rules)
    def clean(bronze):
        parsed = F.to_timestamp_ntz("operation_date")
        return bronze.withColumn("operation_date", parsed).drop("batch_id")

    applied = {
        "keys": ["user_id"],
        "sequence_by": "operation_date",
        "delete_when": "code = 'D'",
        "except_cols": ["code", "operation_date", RESCUED, SOURCE_FILE, LOAD_TIME],
    }
    graph.changes("current", "clean", scd=1, **applied)
    graph.changes("history", "clean", scd=2, **applied)

    @graph.view("counts", inputs=["history", "current"])
    def counts(history, current):
        versions = history.groupBy("user_id").agg(
            F.count(START).alias("version_count"), F.count_distinct("event_type").alias("type_count")
        )
        live = current.select("user_id", F.lit(True).alias("is_live"))
        return versions.join(live, "user_id", "left").na.fill(False, ["is_live"])

    schema = read_ingested(t.spark, bronze, checkpoint).schema.add("batch_id", "long")
    stream = t.spark.readStream.schema(schema).parquet(bronze)
    return graph.run(t.spark, {"bronze": stream}, t.scratch("changes"))["counts"]


# ---- usage marts ----------------------------------------------------------------------------

_USES_SQL = """
    SELECT event_id, user_id, ts, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(18,2)) AS amount,
           CAST(json_extract(props, '$.k') AS INT) % 5 AS door,
           CAST(json_extract(props, '$.k') AS INT) // 20 AS hall
    FROM events WHERE event_type <> 'error'
"""


def uses(t):
    """Events other than errors as uses of an asset (the user) between a door and a hall."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.where("event_type <> 'error'").select(
        "event_id",
        "user_id",
        "ts",
        F.col("ts").cast("date").alias("day"),
        cents("value").alias("cents"),
        (k % 5).alias("door"),
        F.floor(k / 20).cast("int").alias("hall"),
    )


_ASSET_USES_SQL = f"""
    SELECT day, user_id, count(*) AS uses, count(*) FILTER (WHERE hour(ts) < 12) AS before_noon,
           CAST(max(amount) AS DOUBLE) AS dearest, arg_min(hall, ts) AS first_hall, arg_max(hall, ts) AS last_hall
    FROM ({_USES_SQL}) GROUP BY ALL
"""
_ASSET_FAULTS_SQL = """
    SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS faults, max(ts) AS last_fault,
           arg_max(event_id, ts) AS last_fault_id
    FROM events WHERE event_type = 'error' GROUP BY ALL
"""


def asset_faults(t):
    """The fault log by asset and day."""
    faults = t.events.where("event_type = 'error'")
    return faults.groupBy(F.col("ts").cast("date").alias("day"), "user_id").agg(
        F.count("*").alias("faults"),
        F.max("ts").alias("last_fault"),
        F.max_by("event_id", "ts").alias("last_fault_id"),
    )


@query(
    f"""
    SELECT coalesce(u.day, f.day) AS day, coalesce(u.user_id, f.user_id) AS user_id,
           coalesce(uses, 0) AS uses, coalesce(before_noon, 0) AS before_noon, dearest, first_hall,
           last_hall, coalesce(faults, 0) AS faults, last_fault, last_fault_id,
           faults / nullif(uses, 0) AS faults_per_use
    FROM ({_ASSET_USES_SQL}) u FULL JOIN ({_ASSET_FAULTS_SQL}) f ON u.day = f.day AND u.user_id = f.user_id
    """
)
def mart_asset_day(t):
    """Per asset and day: its uses, where it was first and last, and its faults.

    Both logs are brought to a row per asset and day before they are joined, so the outer join keeps
    days with faults only, and no use is paired with a fault.
    """
    used = uses(t).groupBy("day", "user_id").agg(
        F.count("*").alias("uses"),
        F.count_if(F.hour("ts") < 12).alias("before_noon"),
        (F.max("cents") / 100).alias("dearest"),
        F.min_by("hall", "ts").alias("first_hall"),
        F.max_by("hall", "ts").alias("last_hall"),
    )
    joined = used.join(asset_faults(t), ["day", "user_id"], "full")
    return joined.na.fill(0, ["uses", "before_noon", "faults"]).withColumn(
        "faults_per_use", F.try_divide(F.when(F.col("faults") > 0, F.col("faults")), F.col("uses"))
    )


@query(
    f"""
    WITH seen AS (
        SELECT day, door AS place, user_id, amount, door = hall AS stayed FROM ({_USES_SQL})
        UNION ALL
        SELECT day, hall, user_id, amount, false FROM ({_USES_SQL}) WHERE door <> hall),
    visits AS (
        SELECT day, place, count(*) AS visits, count(DISTINCT user_id) AS visitors,
               count(*) FILTER (WHERE stayed) AS stays, CAST(max(amount) AS DOUBLE) AS dearest
        FROM seen GROUP BY ALL),
    closing AS (
        SELECT day, last_hall AS place, count(*) AS left_at_close
        FROM ({_ASSET_USES_SQL}) GROUP BY ALL)
    SELECT day, place, visits, visitors, stays, dearest, coalesce(left_at_close, 0) AS left_at_close,
           coalesce(left_at_close, 0) / visitors AS closing_share
    FROM visits LEFT JOIN closing USING (day, place)
    """
)
def mart_place_day(t):
    """Visits of each place, and how many of its visitors' last use of the day ended there.

    A use visits its door and its hall, once if they are the same.
    """
    visited = uses(t).select(
        "day",
        "user_id",
        "cents",
        (F.col("door") == F.col("hall")).alias("stayed"),
        F.explode(F.array_distinct(F.array("door", "hall"))).alias("place"),
    )
    visits = visited.groupBy("day", "place").agg(
        F.count("*").alias("visits"),
        F.count_distinct("user_id").alias("visitors"),
        F.count_if("stayed").alias("stays"),
        (F.max("cents") / 100).alias("dearest"),
    )
    last = uses(t).groupBy("day", "user_id").agg(F.max_by("hall", "ts").alias("place"))
    closing = last.groupBy("day", "place").agg(F.count("*").alias("left_at_close"))
    joined = visits.join(closing, ["day", "place"], "left").na.fill(0, ["left_at_close"])
    return joined.withColumn("closing_share", F.col("left_at_close") / F.col("visitors"))


@query(
    f"""
    SELECT e.event_id AS outage_id, e.ts AS began, count(u.event_id) AS uses_inside,
           CAST(coalesce(sum(u.amount), 0) AS DOUBLE) AS amount_inside,
           count(DISTINCT u.user_id) AS assets_inside,
           count(u.event_id) / nullif(count(DISTINCT u.user_id), 0) AS uses_per_asset
    FROM (SELECT event_id, ts FROM events WHERE event_type = 'error') e
    LEFT JOIN ({_USES_SQL}) u ON u.ts > e.ts AND u.ts < e.ts + INTERVAL 2 HOUR
    GROUP BY ALL
    """
)
def mart_outage(t):
    """Uses and distinct assets inside each two-hour outage, by running sums: no outage is paired with
    a use.

    A use is an asset's first in the outages that began since the asset's use before, and less than
    two hours ago. So a use opens and closes a span of time, and the spans open when an outage begins
    are its distinct assets: openings so far less closings so far.
    """
    outages = t.events.where("event_type = 'error'").select(
        F.col("event_id").alias("outage_id"),
        F.col("ts").alias("began"),
        (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("to_ts"),
        F.lit("0001-01-01").cast("timestamp_ntz").alias("ever"),
        (F.col("ts") + F.expr("INTERVAL 0.000001 SECONDS")).alias("after"),
    )
    used = uses(t).select("user_id", "cents", F.col("ts").alias("at"))
    inside = interval_sums(outages, used, "began", "to_ts", "at", "cents")
    before = F.lag("at").over(Window.partitionBy("user_id").orderBy("at"))
    opens = F.greatest(before, F.col("at") - F.expr("INTERVAL 2 HOURS") + F.expr("INTERVAL 0.000001 SECONDS"))
    spans = used.select(opens.alias("opens"), "at").where("opens < at")
    turns = spans.select(F.col("opens").alias("at"), F.lit(1).alias("turn")).union(
        spans.select("at", F.lit(-1).alias("turn"))
    )
    assets = interval_sums(outages, turns, "ever", "after", "at", "turn")
    return (
        inside.select(
            "outage_id",
            "began",
            F.col("n_points").alias("uses_inside"),
            (F.col("total") / 100).alias("amount_inside"),
        )
        .join(assets.select("outage_id", F.col("total").alias("assets_inside")), "outage_id")
        .withColumn("uses_per_asset", F.try_divide("uses_inside", "assets_inside"))
    )


# ---- typed file to yearly counts, users and bookings -----------------------------------------


@query(
    """
    SELECT c_name AS buyer, year(o_orderdate) AS order_year, count(*) AS total_orders
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) > 0
    GROUP BY ALL
    """
)
def flow_top_by_year(t):
    """A tab-separated file under a declared schema, warn rules, counts per buyer and year."""
    path = t.scratch("orders-tsv")
    buyers = t.customer.select("c_custkey", "c_name")
    t.orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_name", "o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice"
    ).write.csv(path, sep="\t")
    raw = read_csv(
        t.spark, path, "name STRING, order_id LONG, year INT, price DOUBLE", sep="\t", header=False
    )
    graph = DatasetGraph()
    rules = expect_all({"has_buyer": "buyer IS NOT NULL", "has_price": "price > 0"})

    @graph.stored("prepared", inputs=["raw"], rules=rules)
    def prepared(raw):
        return raw.withColumnRenamed("name", "buyer").select("buyer", "year", "price")

    @graph.view("top_by_year", inputs=["prepared"])
    def top(prepared):
        return (
            prepared.where(F.col("year") > 0)
            .groupBy("buyer", F.col("year").cast("long").alias("order_year"))
            .agg(F.count("*").alias("total_orders"))
            .orderBy(F.desc("total_orders"), F.desc("order_year"))
        )

    return graph.run(t.spark, {"raw": raw}, t.scratch("top"))["top_by_year"]


@query(
    f"""
    SELECT c_name AS name, count(o_orderkey) AS booking_count
    FROM ({_EMAIL_SQL}) u JOIN customer USING (c_custkey) JOIN orders ON c_custkey = o_custkey
    WHERE email IS NOT NULL GROUP BY c_name ORDER BY booking_count DESC, name LIMIT 100
    """
)
def flow_users_bookings(t):
    """Users without an address are dropped by rule; the hundred with most bookings stay."""
    graph = DatasetGraph()

    @graph.stored("cleaned", inputs=["users"], rules=[Rule("has_email", "email IS NOT NULL", DROP)])
    def cleaned(users):
        return users

    @graph.view("top_users", inputs=["cleaned", "names", "bookings"])
    def top_users(cleaned, names, bookings):
        per_user = bookings.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.count("o_orderkey").alias("n")
        )
        return (
            cleaned.join(names, "c_custkey")
            .join(per_user, "c_custkey")
            .groupBy(F.col("c_name").alias("name"))
            .agg(F.sum("n").alias("booking_count"))
            .orderBy(F.desc("booking_count"), "name")
            .limit(100)
        )

    sources = {
        "users": customers_with_email(t),
        "names": t.customer.select("c_custkey", "c_name"),
        "bookings": t.orders.select("o_orderkey", "o_custkey"),
    }
    return graph.run(t.spark, sources, t.scratch("bookings"))["top_users"]


@query(
    f"""
    SELECT user_type, count(*) AS n_users, count(*) FILTER (WHERE {_VALID_SQL}) AS n_valid
    FROM ({_EMAIL_SQL}) WHERE email IS NOT NULL GROUP BY user_type
    """
)
def flow_users_by_type(t):
    return (
        customers_with_email(t)
        .where("email IS NOT NULL")
        .groupBy("user_type")
        .agg(F.count("*").alias("n_users"), F.count_if(is_email(F.col("email"))).alias("n_valid"))
    )


# ---- dashboard ------------------------------------------------------------------------------


@query(
    f"""
    WITH daily AS ({_DAILY_SQL}),
    fit AS (SELECT regr_slope(revenue, date_diff('day', (SELECT min(day) FROM daily), day)) AS b,
                   regr_intercept(revenue, date_diff('day', (SELECT min(day) FROM daily), day)) AS a,
                   date_diff('day', min(day), max(day)) AS span FROM daily)
    SELECT 'total_revenue' AS kpi,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders
    UNION ALL SELECT 'best_day', max(revenue) FROM daily
    UNION ALL SELECT 'active_days', CAST(count(*) AS DOUBLE) FROM daily
    UNION ALL SELECT 'kept_events', CAST(count(*) AS DOUBLE) FROM events WHERE value > 5
    UNION ALL SELECT 'dropped_events', CAST(count(*) AS DOUBLE) FROM events WHERE NOT value > 5
    UNION ALL SELECT 'next_day_forecast', round(a + b * (span + 1), 2) FROM fit
    """
)
def dashboard_kpis(t):
    """The figures of the revenue and data-quality dashboards as one labelled list."""
    daily = daily_revenue(t.orders)
    quality = eventlog.flow_progress(quality_log(t)).agg(
        F.sum("output_records").cast("double").alias("kept_events"),
        F.sum("dropped_records").cast("double").alias("dropped_events"),
    )
    revenue = daily.agg(
        total("revenue").alias("total_revenue"),
        F.max("revenue").alias("best_day"),
        F.count("*").cast("double").alias("active_days"),
    )
    ahead = forecast_trend(daily, "day", "revenue").agg(
        F.round(F.min_by("revenue_forecast", "day"), 2).alias("next_day_forecast")
    )
    out = None
    for row in (revenue, quality, ahead):
        part = row.unpivot([], row.columns, "kpi", "value")
        out = part if out is None else out.unionByName(part)
    return out
