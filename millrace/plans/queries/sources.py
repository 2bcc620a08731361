"""Scans and batch loads: tables written out in a format and read back through it."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.sizing import with_position
from millrace.plans.catalog import query
from millrace.plans.queries.common import total
from millrace.sinks.tables import create_table
from millrace.sources.files import file_columns, read_csv, read_files
from millrace.sources.loads import copy_into, read_loaded
from millrace.sources.paged import page_records

_PRIORITY_SQL = """
    SELECT o_orderpriority, count(*) AS n_orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           max(o_orderkey) AS last_key
    FROM orders GROUP BY o_orderpriority
"""


def by_priority(orders):
    return orders.groupBy("o_orderpriority").agg(
        F.count("*").alias("n_orders"),
        total("o_totalprice").alias("revenue"),
        F.max("o_orderkey").alias("last_key"),
    )


@query(_PRIORITY_SQL)
def scan_json_roundtrip(t):
    path = t.scratch("orders-json")
    t.orders.write.json(path)
    return by_priority(read_files(t.spark, path, "json"))


@query(
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    """
)
def scan_csv_roundtrip(t):
    path = t.scratch("customer-tsv")
    t.customer.write.options(header=True, sep="\t").csv(path)
    schema = (
        "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    )
    return read_csv(t.spark, path, schema, sep="\t")


@query(
    """
    SELECT doc_id, lang, length(text) AS chars,
           length(text) - length(replace(text, chr(10), '')) AS newlines, md5(text) AS digest
    FROM documents
    """
)
def scan_csv_multiline(t):
    """Whole texts with embedded newlines and quotes survive the round trip unchanged."""
    path = t.scratch("documents-csv")
    quoted = {"header": True, "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False}
    # A multi-line file is read by one task, so the writer bounds the rows per file.
    t.documents.select("doc_id", "lang", "text").write.options(
        **quoted, ignoreTrailingWhiteSpace=False, maxRecordsPerFile=20_000
    ).csv(path)
    back = read_csv(
        t.spark, path, "doc_id LONG, lang STRING, text STRING", multiline=True, lineSep="\n"
    )
    return back.select(
        "doc_id",
        "lang",
        F.length("text").cast("long").alias("chars"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))))
        .cast("long")
        .alias("newlines"),
        F.md5("text").alias("digest"),
    )


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_orc_roundtrip(t):
    path = t.scratch("supplier-orc")
    t.supplier.write.orc(path)
    return read_files(t.spark, path, "orc")


@query(
    """
    SELECT lang, CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT)
                 AS n_lines,
           CAST(sum(length(replace(text, chr(10), ''))) AS BIGINT) AS n_chars
    FROM documents GROUP BY lang
    """
)
def scan_text_lines(t):
    path = t.scratch("documents-text")
    t.documents.select("lang", "text").write.partitionBy("lang").option("lineSep", "\n").text(path)
    lines = read_files(t.spark, path, "text", lineSep="\n")
    return lines.groupBy("lang").agg(
        F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


@query(
    """
    SELECT lang, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY lang
    """
)
def scan_binary_files(t):
    """Byte sizes per folder from the binary-file source; contents stay unread."""
    path = t.scratch("documents-binary")
    t.documents.select("lang", "text").write.partitionBy("lang").text(path)
    files = read_files(t.spark, path, "binaryFile")
    return files.groupBy("lang").agg(F.sum("length").alias("n_bytes"))


@query(
    """
    SELECT o_orderpriority, count(*) AS n_orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY o_orderpriority
    """
)
def read_files_glob(t):
    path = t.scratch("orders-by-priority")
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    orders.write.partitionBy("o_orderpriority").parquet(path)
    found = read_files(t.spark, f"{path}/o_orderpriority=[12]-*", "parquet", basePath=path)
    return found.groupBy("o_orderpriority").agg(
        F.count("*").alias("n_orders"), total("o_totalprice").alias("revenue")
    )


@query(
    """
    SELECT o_orderpriority, max(CAST(o_custkey AS VARCHAR)) AS last_customer,
           CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue,
           max(o_orderkey) AS last_key
    FROM orders GROUP BY o_orderpriority
    """
)
def schema_hints(t):
    """Hints override two inferred types: the key reads as text, the amount as a decimal."""
    path = t.scratch("orders-csv")
    t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").write.csv(
        path, header=True
    )
    orders = read_files(
        t.spark, path, "csv", hints="o_custkey STRING, o_totalprice DECIMAL(12,2)", header=True
    )
    return orders.groupBy("o_orderpriority").agg(
        F.max("o_custkey").alias("last_customer"),
        F.sum("o_totalprice").cast("double").alias("revenue"),
        F.max("o_orderkey").cast("long").alias("last_key"),
    )


@query(
    """
    SELECT event_type AS folder, count(*) AS n_rows, true AS has_file, min(ts) AS first_ts
    FROM events GROUP BY event_type ORDER BY folder
    """
)
def file_audit(t):
    """Rows per source folder, from the file metadata columns."""
    path = t.scratch("events-by-type")
    t.events.write.partitionBy("event_type").parquet(path)
    rows = read_files(t.spark, path, "parquet").select("ts", *file_columns())
    folder = F.regexp_extract("_source_file", "event_type=([^/]+)/", 1)
    return (
        rows.groupBy(folder.alias("folder"))
        .agg(
            F.count("*").alias("n_rows"),
            F.bool_and((F.col("_file_size") > 0) & F.col("_file_name").isNotNull()).alias(
                "has_file"
            ),
            F.min("ts").alias("first_ts"),
        )
        .orderBy("folder")
    )


@query(
    """
    SELECT CAST(l_shipdate AS DATE) AS ship_date, count(*) AS n_lines,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem GROUP BY ALL
    """
)
def copy_into_idempotent(t):
    """Three loads of a growing folder: each file arrives once."""
    src, target, ledger = t.scratch("drops"), t.scratch("loaded"), t.scratch("ledger")
    lines = t.lineitem.select("l_orderkey", "l_quantity", F.col("l_shipdate").alias("ship_time"))
    schema = "l_orderkey LONG, l_quantity DOUBLE, ship_time TIMESTAMP_NTZ"
    load = lambda: copy_into(t.spark, target, src, "json", ledger=ledger, schema=schema)
    early = F.col("l_quantity") <= 20
    lines.where(early).write.json(f"{src}/first")
    load()
    lines.where(~early).write.json(f"{src}/second")
    load()
    load()
    return (
        read_loaded(t.spark, target, ledger)
        .groupBy(F.col("ship_time").cast("date").alias("ship_date"))
        .agg(F.count("*").alias("n_lines"), total("l_quantity").alias("quantity"))
    )


@query("SELECT conv_id, turn, role, length(text) AS chars, md5(text) AS digest FROM conversations")
def paged_source(t):
    """Turns packed into page documents of up to 50 records, written, read and unpacked.

    The page comes from the row's position, so no page grows with the data.
    """
    path = t.scratch("pages-json")
    record = F.struct("conv_id", "turn", "role", "text")
    pages = (
        with_position(t.conversations, "position")
        .groupBy(F.floor(F.col("position") / 50).alias("page"))
        .agg(F.collect_list(record).alias("records"))
        .select(F.to_json(F.struct("page", "records")).alias("value"))
    )
    pages.write.text(path)
    bodies = read_files(t.spark, path, "text")
    rows = page_records(bodies, "value", "conv_id LONG, turn LONG, role STRING, text STRING")
    return rows.select(
        "conv_id", "turn", "role", F.length("text").cast("long").alias("chars"),
        F.md5("text").alias("digest"),
    )


@query("SELECT p_type, count(*) AS n_parts, max(p_retailprice) AS top_price FROM part GROUP BY p_type")
def table_scan(t):
    name = t.table_name("part")
    create_table(t.part, name, t.scratch("part-table"))
    return (
        t.spark.table(name)
        .groupBy("p_type")
        .agg(F.count("*").alias("n_parts"), F.max("p_retailprice").alias("top_price"))
    )


@query(
    """
    SELECT o_orderkey, label FROM orders
    JOIN (VALUES ('1-URGENT', 'now'), ('2-HIGH', 'today'), ('3-MEDIUM', 'this week'))
         AS v(priority, label) ON o_orderpriority = priority
    """
)
def inline_values(t):
    labels = t.spark.createDataFrame(
        [("1-URGENT", "now"), ("2-HIGH", "today"), ("3-MEDIUM", "this week")],
        "priority STRING, label STRING",
    )
    return t.orders.join(
        F.broadcast(labels), F.col("o_orderpriority") == F.col("priority")
    ).select("o_orderkey", "label")


@query(
    """
    WITH ids AS (SELECT unnest(range(0, (SELECT max(o_orderkey) + 1 FROM orders))) AS id)
    SELECT id % 50 AS key, count(*) AS n_ids, count(o_orderkey) AS n_orders,
           CAST(sum(id) AS BIGINT) AS id_sum,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM ids LEFT JOIN orders ON id = o_orderkey GROUP BY 1
    """
)
def range_modulo_agg(t):
    """A generated id range as long as the order keys, grouped by a derived key."""
    last = t.orders.agg(F.max("o_orderkey")).first()[0]
    ids = t.spark.range(0, last + 1).withColumn("key", F.col("id") % 50)
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return (
        ids.join(orders, F.col("id") == F.col("o_orderkey"), "left")
        .groupBy("key")
        .agg(
            F.count("*").alias("n_ids"),
            F.count("o_orderkey").alias("n_orders"),
            F.sum("id").alias("id_sum"),
            total("o_totalprice").alias("revenue"),
        )
    )
