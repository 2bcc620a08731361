import pytest
from pyspark.sql import functions as F, types as T

from millrace.operators.diagnostics import file_profile
from millrace.operators.sizing import hot_slots
from millrace.operators.governance import (
    Mask,
    RowRule,
    apply_masks,
    apply_row_filter,
    apply_tag_policies,
    export_share,
    read_share,
)
from millrace.sinks.layout import (
    append_clustered,
    clustering,
    compact,
    set_clustering,
    files_for,
    target_files,
    with_cluster_key,
    write_clustered,
)
from millrace.sinks.tables import (
    SchemaMismatch,
    conform,
    create_table,
    export_partitions,
    schema_problems,
    split_by_schema,
    write_enforced,
)


def test_create_modes(spark, folder, rows):
    one, two = spark.range(1), spark.range(2)
    create_table(one, "modes_t", f"{folder}/t")
    with pytest.raises(Exception, match="already exists"):
        create_table(two, "modes_t", f"{folder}/t2")
    create_table(two, "modes_t", f"{folder}/t", mode="skip")
    assert spark.table("modes_t").count() == 1
    create_table(two, "modes_t", f"{folder}/t", mode="replace")
    assert spark.table("modes_t").count() == 2
    spark.sql("DROP TABLE IF EXISTS modes_t")
    spark.sql("DROP TABLE IF EXISTS modes_t")


def test_enforced_write(spark, folder):
    declared = T.StructType.fromDDL("id LONG, v STRING")
    good = spark.createDataFrame([("a", 1)], "v STRING, id LONG")
    write_enforced(good, f"{folder}/t", declared)
    for ddl, row in [("id LONG", (1,)), ("id INT, v STRING", (1, "a")),
                     ("id LONG, v STRING, w INT", (1, "a", 2))]:
        with pytest.raises(SchemaMismatch):
            write_enforced(spark.createDataFrame([row], ddl), f"{folder}/t", declared)
    assert spark.read.parquet(f"{folder}/t").count() == 1
    assert schema_problems(good.schema, declared) == []


def test_split_by_schema(spark, rows):
    df = spark.createDataFrame([("1", "2024-01-02"), ("x", None), (None, "later")], "a STRING, d STRING")
    good, bad = split_by_schema(df, T.StructType.fromDDL("a INT, d DATE"))
    assert [r["a"] for r in good.collect()] == [1]
    assert rows(bad) == [("x", None), (None, "later")]


def test_conform_carries_comments(spark):
    declared = T.StructType([T.StructField("id", T.IntegerType(), metadata={"comment": "key"})])
    out = conform(spark.range(3), declared)
    assert out.schema["id"].metadata == {"comment": "key"} and out.dtypes == [("id", "int")]


def test_export_manifest_counts_files_and_rows(spark, folder, rows):
    df = spark.range(90).selectExpr("id", "CASE WHEN id < 60 THEN 'hot' ELSE 'cold' END AS k")
    manifest = export_partitions(df, f"{folder}/x", "k")
    assert rows(manifest, "k", "files", "rows") == [("cold", 1, 30), ("hot", 1, 60)]
    slots = hot_slots(df, ["k"], rows_per_task=40)
    spread = export_partitions(df, f"{folder}/y", "k", hot=slots)
    assert rows(spread, "k", "rows") == [("cold", 30), ("hot", 60)]
    assert max(r["files"] for r in spread.collect()) <= 2


def test_compaction_keeps_rows(spark, folder):
    spark.range(1000).repartition(20).write.parquet(f"{folder}/small")
    assert compact(spark, f"{folder}/small", f"{folder}/big") == 1
    big = spark.read.parquet(f"{folder}/big")
    assert big.count() == 1000 and big.select(F.input_file_name()).distinct().count() == 1
    assert target_files(10 * 2**30) == 40


def test_clustering_separates_both_columns(spark, folder, rows):
    df = spark.range(4096).selectExpr("id % 64 AS a", "id DIV 64 AS b", "id")
    write_clustered(df, f"{folder}/c", ["a", "b"], 16)
    back = spark.read.parquet(f"{folder}/c")
    assert rows(back) == rows(df)
    spans = file_profile(back, ["a", "b"]).select(
        F.avg(F.col("max_a") - F.col("min_a")), F.avg(F.col("max_b") - F.col("min_b"))
    ).first()
    assert spans[0] < 40 and spans[1] < 40


def test_clustering_columns_are_kept_with_the_table(spark, folder):
    path = f"{folder}/c"
    with pytest.raises(ValueError):
        append_clustered(spark.range(10), path, 2)
    set_clustering(spark, path, ["id"])
    append_clustered(spark.range(100), path, 2)
    set_clustering(spark, path, ["id", "id"])
    assert clustering(spark, path) == ["id", "id"]
    set_clustering(spark, path, ["id"])
    append_clustered(spark.range(100, 200), path, 2)
    assert spark.read.parquet(path).count() == 200


def test_hot_value_fills_several_files(spark, folder):
    df = spark.range(8000).selectExpr("1L AS a", "2L AS b", "id")
    write_clustered(df, f"{folder}/c", ["a", "b"], 4)
    sizes = [r["rows"] for r in file_profile(spark.read.parquet(f"{folder}/c"), ["a"]).collect()]
    assert len(sizes) == 4 and max(sizes) < 4000


def test_cluster_key_takes_text_dates_and_nulls(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', DATE'2024-01-01', TIMESTAMP_NTZ'2024-01-01 00:00:00'), "
        "('zz', DATE'2025-01-01', NULL), (NULL, NULL, NULL) AS v(s, d, t)"
    )
    keys = [r["key"] for r in with_cluster_key(df, ["s", "d", "t"], "key").collect()]
    assert keys[0] < keys[1] and keys[2] == 0


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([("APAC", "111-22-3333"), ("EMEA", None), (None, "9")], "r STRING, ssn STRING")


RULES = [RowRule("apac", "r = 'APAC'"), RowRule("emea", "r = 'EMEA'"), RowRule("engineers")]


def test_row_filter(people, rows):
    assert rows(apply_row_filter(people, RULES, {"apac"}), "r") == [("APAC",)]
    assert apply_row_filter(people, RULES, {"apac", "emea"}).count() == 2
    assert apply_row_filter(people, RULES, {"engineers"}).count() == 3
    assert apply_row_filter(people, RULES, set()).count() == 0


def test_masks(people, rows):
    mask = {"ssn": Mask("pii", "concat('XXX-XX-', right({value}, 4))")}
    assert rows(apply_masks(people, mask, {"pii"})) == rows(people)
    assert rows(apply_masks(people, mask, set()), "ssn") == [("XXX-XX-3333",), ("XXX-XX-9",), (None,)]


def test_tag_policy_covers_tagged_columns_only(people, rows):
    policies = {"pii": Mask("pii", "'hidden'")}
    tagged = apply_tag_policies(people, {"ssn": {"pii"}, "gone": {"pii"}}, policies, set())
    assert rows(tagged, "ssn") == [("hidden",)] * 3
    assert rows(tagged, "r") == rows(people, "r")


def test_share_holds_the_slice_only(spark, folder, rows):
    df = spark.range(10).selectExpr("id", "id % 2 AS k")
    manifest = export_share(df, folder, "t", ["k"], "id >= 4")
    assert rows(manifest, "k", "rows") == [(0, 3), (1, 3)]
    assert read_share(spark, folder, "t").count() == 6


def test_text_with_a_common_prefix_clusters(spark, data):
    df = spark.read.parquet(f"{data}/customer.parquet").select("c_name")
    keyed = with_cluster_key(df, ["c_name"], "at", files=16)
    assert keyed.select("at").distinct().count() == 32
    ordered = [r["at"] for r in keyed.orderBy("c_name").collect()]
    assert ordered == sorted(ordered)


def test_one_odd_row_leaves_the_ranks(spark, data):
    names = spark.read.parquet(f"{data}/customer.parquet").select("c_name")
    odd = names.union(spark.sql("SELECT * FROM VALUES ('Zed'), (NULL), ('') AS t(c_name)"))
    keyed = with_cluster_key(odd, ["c_name"], "at", files=16)
    assert keyed.select("at").distinct().count() == 32
    ordered = [r["at"] for r in keyed.orderBy("c_name").collect()]
    assert ordered == sorted(ordered) and ordered[0] == 0


def test_ranks_follow_any_type_and_are_not_capped(spark):
    df = spark.range(9000).selectExpr(
        "id", "CAST(id AS DECIMAL(20,3)) AS d", "CAST(lpad(id, 5, '0') AS BINARY) AS b", "id % 2 = 0 AS even",
        "IF(id = 5, CAST('NaN' AS DOUBLE), CAST(id AS DOUBLE)) AS f",
    )
    for column in ("d", "b", "f"):
        keyed = with_cluster_key(df, [column], "at", files=4096)
        assert keyed.select("at").distinct().count() > 7000  # twelve bits would end at 4,096
    assert with_cluster_key(df, ["even"], "at", files=8).select("at").distinct().count() == 2
    assert with_cluster_key(df.where("id < 0"), ["d", "b"], "at").count() == 0


def test_file_counts_follow_rows_not_estimates(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    customers = spark.read.parquet(f"{data}/customer.parquet")
    assert files_for(orders.join(customers, orders.o_custkey == customers.c_custkey)) == 1
    assert files_for(orders.where("false")) == 1


def test_a_single_column_is_laid_out_by_its_values(spark, folder):
    spark.range(1000).selectExpr("CAST(id % 50 AS STRING) AS k").write.parquet(f"{folder}/in")
    write_clustered(spark.read.parquet(f"{folder}/in"), f"{folder}/out", ["k"], 5)
    profile = file_profile(spark.read.parquet(f"{folder}/out"), ["k"]).orderBy("min_k").collect()
    assert len(profile) == 5 and all(a["max_k"] <= b["min_k"] for a, b in zip(profile, profile[1:]))
