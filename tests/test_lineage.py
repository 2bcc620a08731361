from pyspark.sql import Window, functions as F

from millrace.operators.lineage import column_sources


def test_renamed_computed_and_joined_columns(spark):
    left = spark.sql("SELECT 1L id, 2 a, 3 b")
    right = spark.sql("SELECT 1L key, 5 c, array(1, 2) xs")
    inputs = {"left": left, "right": right}
    made = (
        left.withColumnRenamed("a", "renamed")
        .join(right, F.col("id") == F.col("key"), "left")
        .withColumn("total", F.col("renamed") + F.col("c"))
        .withColumn("one", F.lit(1))
        .select("id", "renamed", "total", "one", F.explode("xs").alias("x"), F.upper("b").alias("b"))
    )
    assert column_sources(made, inputs) == {
        "id": ["left.id", "right.key"], "renamed": ["left.a"], "total": ["left.a", "right.c"],
        "one": [], "x": ["right.xs"], "b": ["left.b"],
    }


def test_aggregates_windows_unions_and_functions(spark):
    one, two = spark.sql("SELECT 1L id, 2 a"), spark.sql("SELECT 1L n, 2 m")
    inputs = {"one": one, "two": two}
    grouped = one.groupBy((F.col("id") % 2).alias("k")).agg(F.sum("a").alias("s"), F.count("*").alias("n"))
    assert column_sources(grouped, inputs) == {"k": ["one.id"], "s": ["one.a"], "n": []}
    ranked = one.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("a")))
    assert column_sources(ranked, inputs)["r"] == ["one.a", "one.id"]
    assert column_sources(one.union(two).filter("a > 0"), inputs) == {"id": ["one.id", "two.n"], "a": ["one.a", "two.m"]}
    mapped = one.mapInPandas(lambda parts: parts, "z long, y int")
    assert column_sources(mapped, inputs) == {"z": ["one.a", "one.id"], "y": ["one.a", "one.id"]}


def test_a_relation_joined_with_itself(spark, folder):
    spark.sql("SELECT 1L id, 2 a").write.parquet(folder + "/t")
    t = spark.read.parquet(folder + "/t")
    again = t.select(F.col("id").alias("other"), (F.col("a") * 2).alias("twice"))
    found = column_sources(t.join(again, F.col("id") == F.col("other")), {"t": t})
    assert found["twice"] == ["t.a"] and found["a"] == ["t.a"] and found["other"] == ["t.id"]
