"""Scalar functions, JSON and variants, classification, forecast, user-defined functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.forecast import forecast_trend, forecast_weekly, stitch_forecast
from millrace.functions.json import infer_json_schema
from millrace.functions.text import classify_keywords, clean_code, is_email, is_email_udf
from millrace.functions.times import epoch_seconds, epoch_to_date, minutes_between
from millrace.plans.catalog import query
from millrace.plans.queries.aggregates import _DAILY_SQL, daily_revenue
from millrace.plans.queries.common import NET_PRICE_SQL, net_units, total


@query(
    """
    SELECT c_custkey, upper(trim('  ' || lower(c_mktsegment) || ' ')) AS segment FROM customer
    """
)
def fn_string_clean(t):
    padded = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    return t.customer.select("c_custkey", clean_code(padded).alias("segment"))


@query(
    """
    SELECT c_custkey, string_split(c_name, '#')[1] AS kind, string_split(c_name, '#')[2] AS number
    FROM customer
    """
)
def fn_split_name(t):
    parts = F.split("c_name", "#")
    return t.customer.select(
        "c_custkey",
        F.element_at(parts, 1).alias("kind"),
        F.element_at(parts, 2).alias("number"),
    )


@query(
    """
    SELECT o_orderkey, split_part('lake.sales.' || o_orderstatus, '.', -1) AS last_part,
           split_part(o_orderpriority, '-', 1) AS rank
    FROM orders
    """
)
def fn_split_part(t):
    name = F.concat(F.lit("lake.sales."), F.col("o_orderstatus"))
    return t.orders.select(
        "o_orderkey",
        F.split_part(name, F.lit("."), F.lit(-1)).alias("last_part"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("rank"),
    )


@query(
    """
    SELECT c_custkey, concat('XXX-', right(c_name, 4)) AS tail,
           c_mktsegment || '/' || CAST(c_nationkey AS VARCHAR) AS path
    FROM customer
    """
)
def fn_concat_right(t):
    return t.view("customer").sql(
        """
        SELECT c_custkey, concat('XXX-', right(c_name, 4)) AS tail,
               c_mktsegment || '/' || CAST(c_nationkey AS STRING) AS path
        FROM customer
        """
    )


@query("SELECT doc_id, length(text) AS chars, length(text) > 1000 AS long_text FROM documents")
def fn_length(t):
    return t.documents.select(
        "doc_id",
        F.length("text").cast("long").alias("chars"),
        (F.length("text") > 1000).alias("long_text"),
    )


_EMAIL_SQL = """
    SELECT c_custkey, c_mktsegment AS user_type,
           CASE WHEN c_acctbal < 0 THEN NULL
                WHEN c_acctbal < 1000 THEN c_name || ' at example.com'
                WHEN c_acctbal < 2000 THEN replace(c_name, '#', '.') || '@example'
                ELSE lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example.com'
           END AS email
    FROM customer
"""


def customers_with_email(t):
    """Customers with an address made from their name, missing or malformed at low balances."""
    dotted = F.regexp_replace("c_name", "#", ".")
    email = (
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .when(F.col("c_acctbal") < 1000, F.concat("c_name", F.lit(" at example.com")))
        .when(F.col("c_acctbal") < 2000, F.concat(dotted, F.lit("@example")))
        .otherwise(
            F.concat(F.lower(dotted), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example.com"))
        )
    )
    return t.customer.select(
        "c_custkey", F.col("c_mktsegment").alias("user_type"), email.alias("email")
    )


# The pattern is the fixed value stated in millrace.functions.text.
_VALID_SQL = (
    r"coalesce(regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'), false)"
)


@query(f"SELECT c_custkey, email, {_VALID_SQL} AS valid FROM ({_EMAIL_SQL})")
def fn_email_valid(t):
    return customers_with_email(t).select(
        "c_custkey", "email", is_email(F.col("email")).alias("valid")
    )


@query(
    f"""
    SELECT user_type, {_VALID_SQL} AS reachable, min(c_custkey) AS first_key,
           max(length(email)) AS longest
    FROM ({_EMAIL_SQL}) GROUP BY ALL
    """
)
def udf_email_by_type(t):
    return (
        customers_with_email(t)
        .groupBy("user_type", is_email_udf("email").alias("reachable"))
        .agg(F.min("c_custkey").alias("first_key"), F.max(F.length("email")).alias("longest"))
    )


@query(
    """
    WITH written AS (
        SELECT o_orderkey, strftime(o_orderdate, '%m-%d-%Y %H:%M:%S') AS text_ts,
               CASE WHEN o_orderstatus = 'P' THEN 'unknown'
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS text_day
        FROM orders)
    SELECT o_orderkey, text_ts, strptime(text_ts, '%m-%d-%Y %H:%M:%S') AS ts,
           CAST(try_strptime(text_day, '%Y-%m-%d') AS DATE) AS day
    FROM written
    """
)
def fn_parse_dates(t):
    written = t.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "MM-dd-yyyy HH:mm:ss").alias("text_ts"),
        F.when(F.col("o_orderstatus") == "P", "unknown")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("text_day"),
    )
    return written.select(
        "o_orderkey",
        "text_ts",
        F.expr("to_timestamp_ntz(text_ts, 'MM-dd-yyyy HH:mm:ss')").alias("ts"),
        F.try_to_date("text_day", "yyyy-MM-dd").alias("day"),
    )


_SPANS_SQL = """
    SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events GROUP BY ALL
"""


def user_day_spans(t):
    return t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query(f"SELECT user_id, day, date_sub('minute', first_ts, last_ts) AS minutes FROM ({_SPANS_SQL})")
def fn_minutes_between(t):
    return user_day_spans(t).select(
        "user_id", "day", minutes_between(F.col("first_ts"), F.col("last_ts")).alias("minutes")
    )


@query(
    """
    SELECT o_custkey, date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)))
           AS days
    FROM orders GROUP BY o_custkey
    """
)
def fn_days_between(t):
    return t.orders.groupBy("o_custkey").agg(
        F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).cast("long").alias("days")
    )


@query(
    """
    SELECT event_id, CAST(ts AS DATE) AS from_seconds, CAST(ts AS DATE) AS from_millis FROM events
    """
)
def fn_epoch_to_date(t):
    seconds = epoch_seconds(F.col("ts"))
    return t.events.select(
        "event_id",
        epoch_to_date(seconds, "seconds").alias("from_seconds"),
        epoch_to_date(seconds * 1000, "millis").alias("from_millis"),
    )


@query(
    """
    SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY
    """
)
def fn_recent_interval(t):
    events = t.events.select("event_id", "ts")
    newest = events.agg(F.max("ts").alias("m")).scalar()
    return events.where(F.col("ts") > newest - F.expr("INTERVAL 7 DAYS"))


@query(
    """
    SELECT event_id, strftime(ts, '%Y/%m/%d') AS folder, strftime(ts, '%b %Y') AS label
    FROM events
    """
)
def fn_date_format(t):
    return t.events.select(
        "event_id",
        F.date_format("ts", "yyyy/MM/dd").alias("folder"),
        F.date_format("ts", "MMM yyyy").alias("label"),
    )


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, CAST({NET_PRICE_SQL} AS DOUBLE) AS net,
           CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded,
           l_extendedprice / l_quantity AS unit_price, l_orderkey % 7 AS bucket,
           l_quantity * 2 + 1 AS doubled
    FROM lineitem
    """
)
def fn_math(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (net_units() / 10_000).alias("net"),
        F.round(F.col("l_extendedprice").cast("decimal(18,2)"), 1).cast("double").alias("rounded"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_orderkey") % 7).alias("bucket"),
        (F.col("l_quantity") * 2 + 1).alias("doubled"),
    )


@query(
    """
    SELECT d.doc_id, coalesce(quality, -1) AS quality, toxic IS NOT NULL AS is_labelled,
           CASE WHEN toxic = 1 THEN 'toxic' WHEN toxic = 0 THEN 'clean' END AS verdict,
           CAST(NULL AS VARCHAR) AS reviewer
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """
)
def fn_null_handling(t):
    return (
        t.documents.select("doc_id")
        .join(t.labels, "doc_id", "left")
        .select(
            "doc_id",
            F.coalesce("quality", F.lit(-1)).alias("quality"),
            F.col("toxic").isNotNull().alias("is_labelled"),
            F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean").alias("verdict"),
            F.lit(None).cast("string").alias("reviewer"),
        )
    )


@query(
    """
    SELECT word, count(*) AS n_parts FROM (
        SELECT unnest(list_concat(string_split(p_name, ' '), [p_type])) AS word FROM part)
    GROUP BY word
    """
)
def fn_explode_array(t):
    words = F.concat(F.split("p_name", " "), F.array("p_type"))
    return (
        t.part.select(F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n_parts"))
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority AS item_sku,
           o_totalprice AS item_price, 'list' AS kind
    FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, 'fee', o_totalprice / 100, 'fee'
    FROM orders
    """
)
def json_flatten_orders(t):
    """One nested document per order, parsed by schema, its item array exploded and flattened."""
    documents = t.orders.select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").alias("id"),
                F.struct(
                    F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("status")
                ).alias("customer"),
                F.array(
                    F.struct(
                        F.col("o_orderpriority").alias("sku"),
                        F.col("o_totalprice").alias("price"),
                        F.lit("list").alias("kind"),
                    ),
                    F.struct(
                        F.lit("fee").alias("sku"),
                        (F.col("o_totalprice") / 100).alias("price"),
                        F.lit("fee").alias("kind"),
                    ),
                ).alias("items"),
            )
        ).alias("body")
    )
    schema = (
        "id LONG, customer STRUCT<key: LONG, status: STRING>, "
        "items ARRAY<STRUCT<sku: STRING, price: DOUBLE, kind: STRING>>"
    )
    return (
        documents.select(F.from_json("body", schema).alias("d"))
        .select("d.id", "d.customer", F.explode("d.items").alias("item"))
        .select(
            F.col("id").alias("o_orderkey"),
            F.col("customer.key").alias("o_custkey"),
            F.col("customer.status").alias("o_orderstatus"),
            F.col("item.sku").alias("item_sku"),
            F.col("item.price").alias("item_price"),
            F.col("item.kind").alias("kind"),
        )
    )


@query(
    """
    SELECT DISTINCT field, CASE WHEN json_type(props, '$.' || field) IN ('UBIGINT', 'BIGINT')
                                THEN 'bigint' ELSE 'string' END AS type
    FROM (SELECT props, unnest(json_keys(props)) AS field FROM events)
    """
)
def json_schema_infer(t):
    """Field names and types merged over every document."""
    schema = infer_json_schema(t.events, "props")
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return t.spark.createDataFrame(rows, "field STRING, type STRING")


@query(
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           CAST(json_extract(props, '$.k') AS VARCHAR) AS k_text, false AS has_missing
    FROM events
    """
)
def variant_paths(t):
    return t.view("events").sql(
        """
        SELECT event_id, v:k::BIGINT AS k, v:k::STRING AS k_text,
               v:missing.deeper::STRING IS NOT NULL AS has_missing
        FROM (SELECT event_id, parse_json(props) AS v FROM events)
        """
    )


@query(
    """
    SELECT event_id, 'k' AS key, CAST(json_extract(props, '$.k') AS VARCHAR) AS value FROM events
    UNION ALL SELECT event_id, 'kind', event_type FROM events
    """
)
def variant_explode_rows(t):
    return t.view("events").sql(
        """
        SELECT event_id, entry.key AS key, entry.value::STRING AS value
        FROM (SELECT event_id,
                     parse_json(to_json(struct(from_json(props, 'k BIGINT').k AS k,
                                               event_type AS kind))) AS v FROM events),
             LATERAL variant_explode(v) AS entry
        """
    )


@query(
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open'
           WHEN 'P' THEN 'pending' END AS status_label
    FROM orders
    """
)
def fn_map_lookup(t):
    names = {"F": "finished", "O": "open", "P": "pending"}
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return t.orders.select(
        "o_orderkey", F.try_element_at(lookup, F.col("o_orderstatus")).alias("status_label")
    )


@query(
    """
    SELECT p_partkey, '{"brand":"' || p_brand || '","size":' || p_size || '}' AS packed
    FROM part
    """
)
def fn_struct_build(t):
    packed = F.named_struct(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size"))
    return t.part.select("p_partkey", F.to_json(packed).alias("packed"))


_PART_LABELS = {
    "fastener": ["bolt", "screw", "nut"],
    "round": ["ring", "gear", "wheel"],
    "flat": ["plate", "widget"],
}


@query(
    """
    SELECT p_partkey, CASE WHEN regexp_matches(p_name, 'bolt|screw|nut') THEN 'fastener'
           WHEN regexp_matches(p_name, 'ring|gear|wheel') THEN 'round'
           WHEN regexp_matches(p_name, 'plate|widget') THEN 'flat' ELSE 'other' END AS label
    FROM part
    """
)
def classify_parts(t):
    return t.part.select(
        "p_partkey", classify_keywords(F.col("p_name"), _PART_LABELS, "other").alias("label")
    )


_TEXT_LABELS = {
    "licence": [r"(?i)copyright", r"(?i)licen[cs]e", r"(?i)all rights reserved"],
    "contact": [r"[A-Za-z0-9._-]@[A-Za-z0-9-]+\.[a-z]{2}", r"[0-9]{3}-[0-9]{4}"],
}


@query(
    r"""
    WITH scored AS (
        SELECT doc_id,
               CAST(regexp_matches(text, '(?i)copyright') AS INT)
               + CAST(regexp_matches(text, '(?i)licen[cs]e') AS INT)
               + CAST(regexp_matches(text, '(?i)all rights reserved') AS INT) AS licence,
               CAST(regexp_matches(text, '[A-Za-z0-9._-]@[A-Za-z0-9-]+\.[a-z]{2}') AS INT)
               + CAST(regexp_matches(text, '[0-9]{3}-[0-9]{4}') AS INT) AS contact
        FROM documents)
    SELECT doc_id, CASE WHEN licence = 0 AND contact = 0 THEN 'other'
                        WHEN licence >= contact THEN 'licence' ELSE 'contact' END AS label
    FROM scored
    """,
    name="classify_keywords",
)
def classify_texts(t):
    label = classify_keywords(F.col("text"), _TEXT_LABELS, "other")
    return t.documents.select("doc_id", label.alias("label"))


_FORECAST_SQL = f"""
    WITH daily AS ({_DAILY_SQL}),
    indexed AS (
        SELECT CAST(date_diff('day', (SELECT min(day) FROM daily), day) AS DOUBLE) AS x,
               revenue AS y, day FROM daily),
    fit AS (
        SELECT count(*) AS n, min(day) AS d0, max(day) AS d1, avg(x) AS mx,
               regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx,
               sqrt((regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / (count(*) - 2)) AS s
        FROM indexed),
    ahead AS (
        SELECT *, date_diff('day', d0, d1) AS span,
               unnest(generate_series(1, CAST(floor(date_diff('day', d0, d1) * 0.5) AS BIGINT)))
                   AS step
        FROM fit),
    band AS (
        SELECT d1 + CAST(step AS INTEGER) AS day, a + b * (span + step) AS fit,
               1.96 * s * sqrt(1 + 1.0 / n + pow(span + step - mx, 2) / sxx) AS half
        FROM ahead)
"""


@query(
    _FORECAST_SQL
    + """
    SELECT CAST(day AS DATE) AS day, round(fit, 2) AS revenue_forecast,
           round(fit + half, 2) AS revenue_upper, round(fit - half, 2) AS revenue_lower
    FROM band
    """,
    name="forecast_trend",
)
def forecast_daily(t):
    ahead = forecast_trend(daily_revenue(t.orders), "day", "revenue")
    figures = ["revenue_forecast", "revenue_upper", "revenue_lower"]
    return ahead.select("day", *[F.round(c, 2).alias(c) for c in figures])


@query(
    _FORECAST_SQL
    + """
    SELECT CAST(day AS DATE) AS day, round(fit, 2) AS revenue_forecast,
           round(fit + half, 2) AS revenue_upper, round(fit - half, 2) AS revenue_lower,
           CAST(NULL AS DOUBLE) AS revenue
    FROM band
    UNION ALL
    SELECT day, NULL, NULL, NULL, revenue FROM daily WHERE day < (SELECT max(day) FROM daily)
    UNION ALL
    SELECT day, revenue, revenue, revenue, revenue FROM daily
    WHERE day = (SELECT max(day) FROM daily)
    """
)
def forecast_stitched(t):
    chart = stitch_forecast(daily_revenue(t.orders), "day", "revenue")
    figures = ["revenue_forecast", "revenue_upper", "revenue_lower", "revenue"]
    return chart.select("day", *[F.round(c, 2).alias(c) for c in figures])


@query(
    """
    WITH daily AS (
        SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
        FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL),
    points AS (
        SELECT *, CAST(date_diff('day', DATE '1970-01-01', day) AS DOUBLE) AS x, isodow(day) AS wd
        FROM daily WHERE y IS NOT NULL),
    levels AS (
        SELECT o_orderpriority, wd, count(*) AS n, avg(x) AS mx, avg(y) AS my, min(day) AS d0,
               max(day) AS d1, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy
        FROM points GROUP BY ALL),
    fit AS (
        SELECT o_orderpriority, sum(sxx) AS sxx, min(d0) AS d0, max(d1) AS d1, sum(sxy) / sum(sxx) AS b,
               sqrt((sum(syy) - sum(sxy) * sum(sxy) / sum(sxx)) / (sum(n) - count(*) - 1)) AS s
        FROM levels GROUP BY ALL),
    ahead AS (
        SELECT *, d1 + CAST(unnest(generate_series(
                   1, CAST(floor(date_diff('day', d0, d1) * 0.1) AS BIGINT))) AS INTEGER) AS day
        FROM fit),
    band AS (
        SELECT a.o_orderpriority, a.day, b, s, a.sxx, n, my,
               date_diff('day', DATE '1970-01-01', a.day) - mx AS off
        FROM ahead a LEFT JOIN levels l
             ON l.o_orderpriority = a.o_orderpriority AND l.wd = isodow(a.day))
    SELECT o_orderpriority, CAST(day AS DATE) AS day, round(my + b * off, 2) AS revenue_forecast,
           round(my + b * off + 1.96 * s * sqrt(1 + 1.0 / n + off * off / sxx), 2) AS revenue_upper,
           round(my + b * off - 1.96 * s * sqrt(1 + 1.0 / n + off * off / sxx), 2) AS revenue_lower
    FROM band
    """,
    name="forecast_weekly",
)
def forecast_by_priority(t):
    daily = t.orders.groupBy("o_orderpriority", F.col("o_orderdate").cast("date").alias("day")).agg(
        total("o_totalprice").alias("revenue")
    )
    ahead = forecast_weekly(daily, "day", "revenue", keys=["o_orderpriority"], span_share=0.1)
    figures = ["revenue_forecast", "revenue_upper", "revenue_lower"]
    return ahead.select("o_orderpriority", "day", *[F.round(c, 2).alias(c) for c in figures])
