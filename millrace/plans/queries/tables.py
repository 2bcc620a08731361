"""Table writes, MERGE/UPDATE/DELETE and reads of earlier versions."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from millrace.operators import merge as dml
from millrace.operators import versions
from millrace.plans.catalog import query
from millrace.plans.queries.common import total
from millrace.sinks.tables import (
    append_merged,
    create_table,
    export_partitions,
    insert_by_name as insert_matching,
    read_merged,
    split_by_schema,
    write_enforced,
)


@query(
    """
    SELECT o_orderstatus, count(*) AS n_orders FROM orders
    WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus
    """
)
def write_append_overwrite(t):
    path = t.scratch("orders-table")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    orders.where("o_orderstatus = 'P'").write.mode("overwrite").parquet(path)
    orders.where("o_orderstatus = 'F'").write.mode("overwrite").parquet(path)
    orders.where("o_orderstatus = 'O'").write.mode("append").parquet(path)
    return (
        t.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n_orders"))
    )


@query(
    """
    SELECT c_mktsegment, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer GROUP BY c_mktsegment
    """
)
def ctas_replace(t):
    """Create from one query, then replace by another; only the second content remains."""
    name, path = t.table_name("balances"), t.scratch("balances")
    create_table(t.customer.select("c_custkey"), name, path)
    sums = t.customer.groupBy("c_mktsegment").agg(total("c_acctbal").alias("balance"))
    create_table(sums, name, path, mode="replace")
    return t.spark.table(name)


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def create_if_not_exists(t):
    """The second creation finds the table and leaves it alone."""
    name, path = t.table_name("customers"), t.scratch("customers")
    columns = ["c_custkey", "c_name"]
    create_table(t.customer.where("c_acctbal > 0").select(*columns), name, path)
    create_table(t.customer.select(*columns), name, path, mode="skip")
    return t.spark.table(name)


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice IS NOT NULL
    AND o_orderstatus = 'F'
    """
)
def insert_select(t):
    name = t.table_name("finished")
    rows = t.orders.select("o_orderkey", "o_totalprice")
    create_table(rows.where("false"), name, t.scratch("finished"))
    t.view("orders").sql(
        f"""
        INSERT INTO {name} SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_totalprice IS NOT NULL AND o_orderstatus = 'F'
        """
    )
    return t.spark.table(name)


@query(
    """
    SELECT r_regionkey, r_name FROM region
    UNION ALL SELECT max(r_regionkey) + 1, 'OPEN SEA' FROM region
    UNION ALL SELECT max(r_regionkey) + 2, NULL FROM region
    """
)
def insert_values(t):
    """Literal rows added to a table by INSERT ... VALUES."""
    name, last = t.table_name("regions"), t.region.agg(F.max("r_regionkey")).first()[0]
    create_table(t.region.select("r_regionkey", "r_name"), name, t.scratch("regions"))
    t.spark.sql(f"INSERT INTO {name} VALUES ({last + 1}, 'OPEN SEA'), ({last + 2}, NULL)")
    return t.spark.table(name)


@query("SELECT n_regionkey, count(*) AS nations FROM nation GROUP BY n_regionkey")
def drop_if_exists(t):
    """A table dropped whether it exists or not, and created anew with other columns."""
    name = t.table_name("nations")
    t.spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(t.nation, name, t.scratch("nations"))
    t.spark.sql(f"DROP TABLE IF EXISTS {name}")
    counts = t.nation.groupBy("n_regionkey").agg(F.count("*").alias("nations"))
    create_table(counts, name, t.scratch("nations"))
    return t.spark.table(name)


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'"
)
def insert_by_name(t):
    """The source has its columns in another order; names decide."""
    name = t.table_name("urgent")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    create_table(t.orders.select(*columns).where("false"), name, t.scratch("urgent"))
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    insert_matching(t.spark, name, urgent.select(*reversed(columns)))
    return t.spark.table(name)


@query(
    """
    SELECT CAST(ts AS DATE) AS day, count(*) AS rows, true AS has_files FROM events GROUP BY ALL
    """
)
def partitioned_export_manifest(t):
    daily = t.events.withColumn("day", F.col("ts").cast("date"))
    manifest = export_partitions(daily, t.scratch("events-by-day"), "day")
    return manifest.select("day", "rows", (F.col("files") > 0).alias("has_files"))


@query("SELECT user_id, count(*) AS n_events, max(event_id) AS last_id FROM events GROUP BY user_id")
def json_export(t):
    path = t.scratch("events-json")
    rows = t.events.select("event_id", "user_id", "event_type")
    rows.where("event_type <> 'error'").repartition(4).write.json(path)
    rows.where("event_type = 'error'").repartition(2).write.mode("append").json(path)
    return (
        t.spark.read.schema("event_id LONG, user_id LONG, event_type STRING")
        .json(path)
        .groupBy("user_id")
        .agg(F.count("*").alias("n_events"), F.max("event_id").alias("last_id"))
    )


@query(
    """
    SELECT event_type, count(*) AS n_rows,
           count(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN props END) AS with_props
    FROM events GROUP BY event_type
    """
)
def merge_schema_append(t):
    """The second append brings a column; rows of the first read NULL there."""
    path = t.scratch("events-merged")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    append_merged(t.events.where(~late).select("event_id", "event_type"), path)
    append_merged(t.events.where(late).select("event_id", "event_type", "props"), path)
    return (
        read_merged(t.spark, path)
        .groupBy("event_type")
        .agg(F.count("*").alias("n_rows"), F.count("props").alias("with_props"))
    )


@query(
    """
    SELECT 'accepted' AS outcome, count(*) AS n_rows FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'rejected', count(*) FROM orders WHERE o_orderstatus = 'P'
    """
)
def schema_enforced_split(t):
    """Text rows against a declared schema: convertible ones are written, others set apart."""
    declared = T.StructType.fromDDL("o_orderkey LONG, o_totalprice DOUBLE")
    amount = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), amount.alias("o_totalprice")
    )
    good, bad = split_by_schema(raw, declared)
    path = t.scratch("enforced")
    write_enforced(good, path, declared)
    accepted = t.spark.read.parquet(path).agg(F.count("*").alias("n_rows"))
    rejected = bad.agg(F.count("*").alias("n_rows"))
    return (
        accepted.withColumn("outcome", F.lit("accepted"))
        .unionByName(rejected.withColumn("outcome", F.lit("rejected")))
        .select("outcome", "n_rows")
    )


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def copy_to_external_path(t):
    """A catalog table copied to a path of the caller's choosing and registered there."""
    managed, external = t.table_name("suppliers"), t.table_name("suppliers_external")
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    create_table(rows, managed, t.scratch("suppliers"))
    create_table(t.spark.table(managed), external, t.scratch("suppliers-external"))
    return t.spark.table(external)


# ---- MERGE, UPDATE, DELETE ------------------------------------------------------------------

_TARGET_SQL = """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
    WHERE year(o_orderdate) < 2000
"""
_SOURCE_SQL = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END
               AS o_totalprice, o_orderstatus
    FROM orders WHERE year(o_orderdate) >= 1998
"""


def merge_sides(t):
    """A target of early orders, a source of late ones with raised prices on open orders."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    raised = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(
        F.col("o_totalprice")
    )
    target = t.orders.where("year(o_orderdate) < 2000").select(*columns)
    source = (
        t.orders.where("year(o_orderdate) >= 1998")
        .select(*columns)
        .withColumn("o_totalprice", raised)
    )
    return target, source


_GUARDED = {"when": "s.o_totalprice != t.o_totalprice", "update": {"o_totalprice": "s.o_totalprice"}}


@query(
    f"""
    SELECT * FROM ({_SOURCE_SQL})
    UNION ALL SELECT * FROM ({_TARGET_SQL})
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_SOURCE_SQL}))
    """
)
def merge_upsert(t):
    target, source = merge_sides(t)
    return dml.merge(target, source, ["o_orderkey"])


@query(
    f"""
    SELECT s.o_orderkey, coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
           CASE WHEN t.o_orderkey IS NULL OR s.o_totalprice != t.o_totalprice
                THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
           coalesce(t.o_orderstatus, s.o_orderstatus) AS o_orderstatus
    FROM ({_SOURCE_SQL}) s LEFT JOIN ({_TARGET_SQL}) t ON s.o_orderkey = t.o_orderkey
    """
)
def merge_conditional_sync(t):
    target, source = merge_sides(t)
    return dml.merge(
        target, source, ["o_orderkey"], not_matched_by_source_delete=True, **_GUARDED
    )


@query(
    f"""
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey,
           CASE WHEN t.o_orderkey IS NULL THEN s.o_totalprice / 2
                WHEN s.o_orderkey IS NULL THEN t.o_totalprice
                ELSE s.o_totalprice END AS o_totalprice,
           CASE WHEN t.o_orderkey IS NULL THEN 'N' || s.o_orderstatus
                ELSE t.o_orderstatus END AS o_orderstatus
    FROM ({_SOURCE_SQL}) s FULL OUTER JOIN ({_TARGET_SQL}) t ON s.o_orderkey = t.o_orderkey
    """
)
def merge_insert_list(t):
    """New orders get computed values for some columns, the others stay empty."""
    target, source = merge_sides(t)
    return dml.merge(
        target,
        source.select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus"),
        ["o_orderkey"],
        update={"o_totalprice": "s.price"},
        insert={
            "o_orderkey": "s.o_orderkey",
            "o_totalprice": "s.price / 2",
            "o_orderstatus": "concat('N', s.o_orderstatus)",
        },
    )


@query(
    f"""
    SELECT CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'delete'
                WHEN s.o_totalprice != t.o_totalprice THEN 'update' ELSE 'keep' END AS action,
           count(*) AS n_rows
    FROM ({_SOURCE_SQL}) s FULL OUTER JOIN ({_TARGET_SQL}) t ON s.o_orderkey = t.o_orderkey
    GROUP BY 1
    """
)
def merge_action_counts(t):
    target, source = merge_sides(t)
    tagged = dml.merge_actions(
        target, source, ["o_orderkey"], not_matched_by_source_delete=True, **_GUARDED
    )
    return tagged.groupBy(F.col(dml.ACTION).alias("action")).agg(F.count("*").alias("n_rows"))


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 0.0 ELSE o_totalprice END
           AS o_totalprice,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM orders
    """
)
def update_where(t):
    changed = dml.update_where(
        t.orders, "o_orderpriority = '5-LOW'", {"o_totalprice": "0.0", "o_orderstatus": "'X'"}
    )
    return changed.select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    """
    SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)
    WHERE quality IS NULL OR NOT quality < 1
    """
)
def delete_where(t):
    """Documents without a label have a NULL predicate and stay."""
    labelled = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return dml.delete_where(labelled, "quality < 1").select("doc_id", "quality")


# ---- earlier versions -----------------------------------------------------------------------

_KEYS = ["o_orderkey"]
_COMMITS = ["2024-01-01 00:00:00", "2024-01-05 00:00:00", "2024-01-09 00:00:00",
            "2024-01-12 00:00:00"]


def change_log(t):
    """Orders as four commits: load, price change, deletion, late load."""
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
    year = F.year("o_orderdate")
    early = t.orders.where(year < 2000).select(*columns)
    late = t.orders.where(year >= 2000).select(*columns)
    raised = early.where("o_orderstatus = 'P'").withColumn(
        "o_totalprice", F.col("o_totalprice") + 100
    )
    gone = early.where("o_orderpriority = '5-LOW'")
    commits = [(early, "insert"), (raised, "update"), (gone, "delete"), (late, "insert")]
    log = None
    for version, (frame, op) in enumerate(commits):
        commit = versions.as_commit(frame, version, _COMMITS[version], op)
        log = commit if log is None else log.unionByName(commit)
    return log


_VERSION_1_SQL = """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 100 ELSE o_totalprice END
               AS o_totalprice, o_orderstatus, o_orderpriority
    FROM orders WHERE year(o_orderdate) < 2000
"""
_VERSION_3_SQL = f"""
    SELECT * FROM ({_VERSION_1_SQL}) WHERE o_orderpriority <> '5-LOW'
    UNION ALL
    SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders
    WHERE year(o_orderdate) >= 2000
"""


@query(
    """
    SELECT 0 AS commit_version, TIMESTAMP '2024-01-01' AS commit_ts, 'insert' AS op,
           count(*) AS rows FROM orders WHERE year(o_orderdate) < 2000
    UNION ALL SELECT 1, TIMESTAMP '2024-01-05', 'update', count(*) FROM orders
    WHERE year(o_orderdate) < 2000 AND o_orderstatus = 'P'
    UNION ALL SELECT 2, TIMESTAMP '2024-01-09', 'delete', count(*) FROM orders
    WHERE year(o_orderdate) < 2000 AND o_orderpriority = '5-LOW'
    UNION ALL SELECT 3, TIMESTAMP '2024-01-12', 'insert', count(*) FROM orders
    WHERE year(o_orderdate) >= 2000
    """
)
def table_history(t):
    return versions.history(change_log(t))


@query(_VERSION_1_SQL)
def asof_version(t):
    return versions.as_of(change_log(t), _KEYS, version=1)


@query(f"SELECT * FROM ({_VERSION_1_SQL}) WHERE o_orderpriority <> '5-LOW'")
def asof_timestamp(t):
    return versions.as_of(change_log(t), _KEYS, timestamp="2024-01-10 12:00:00")


@query(
    f"""
    SELECT 'restored' AS state, count(*) AS n_rows,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM ({_VERSION_1_SQL})
    UNION ALL
    SELECT 'before', count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
    FROM ({_VERSION_3_SQL})
    """
)
def restore_version(t):
    """Restoring adds a commit; the version before it can still be read."""
    log = versions.restore(change_log(t), _KEYS, 1, 4, "2024-01-13 00:00:00")

    def summary(state, version):
        rows = versions.as_of(log, _KEYS, version=version)
        return rows.agg(
            F.count("*").alias("n_rows"), total("o_totalprice").alias("amount")
        ).withColumn("state", F.lit(state))

    return summary("restored", 4).unionByName(summary("before", 3)).select(
        "state", "n_rows", "amount"
    )


@query("SELECT * FROM part")
def clone_deep(t):
    path = t.scratch("part-clone")
    t.part.write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    """
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN p_retailprice / 2 ELSE p_retailprice END
           AS clone_price, p_retailprice AS source_price
    FROM part
    """
)
def clone_shallow_isolated(t):
    """A clone that shares the source's files and keeps only its own changes beside them."""
    own = t.scratch("part-own")
    halved = t.part.where("p_type = 'PROMO'").withColumn(
        "p_retailprice", F.col("p_retailprice") / 2
    )
    halved.write.parquet(own)
    clone = dml.merge(t.part, t.spark.read.parquet(own), ["p_partkey"])
    prices = clone.select("p_partkey", F.col("p_retailprice").alias("clone_price"))
    source = t.part.select("p_partkey", F.col("p_retailprice").alias("source_price"))
    return prices.join(source, "p_partkey")


@query(
    f"""
    SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM ({_VERSION_3_SQL})
    """
)
def retention_prune(t):
    """After pruning to seven days the current version reads the same."""
    pruned = versions.prune(change_log(t), _KEYS, 168)
    return versions.as_of(pruned, _KEYS, version=3)
