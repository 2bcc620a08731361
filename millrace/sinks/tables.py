"""Table writes: creation modes, schema-checked and schema-merging appends, exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.operators.sizing import hot_slots, with_spread


class SchemaMismatch(ValueError):
    """A frame does not have the columns and types its target declares."""


def create_table(df: DataFrame, name: str, path: str, mode: str = "fail", **options) -> None:
    """Create a catalog table over ``path`` from a query; mode is fail, skip or replace."""
    save = {"fail": "errorifexists", "skip": "ignore", "replace": "overwrite"}[mode]
    df.write.mode(save).options(path=path, **options).saveAsTable(name)


def schema_problems(actual: T.StructType, declared: T.StructType) -> list[str]:
    """Differences by column name; the order of columns and nullability do not matter."""
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in declared.fields}
    problems = [f"missing column {c}" for c in want if c not in have]
    problems += [f"unexpected column {c}" for c in have if c not in want]
    problems += [
        f"column {c} is {have[c].simpleString()}, not {want[c].simpleString()}"
        for c in want
        if c in have and have[c] != want[c]
    ]
    return problems


def write_enforced(
    df: DataFrame, path: str, declared: T.StructType, mode: str = "append"
) -> None:
    """Append only a frame that has exactly the declared schema."""
    problems = schema_problems(df.schema, declared)
    if problems:
        raise SchemaMismatch("; ".join(problems))
    df.select(*declared.names).write.mode(mode).parquet(path)


def fits(declared: T.StructType) -> Column:
    """TRUE where every text column converts to its declared type."""
    verdict = F.lit(True)
    for field in declared.fields:
        value = F.col(field.name)
        verdict = verdict & (value.isNull() | value.try_cast(field.dataType).isNotNull())
    return verdict


def split_by_schema(df: DataFrame, declared: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Text rows that convert to the declared schema, converted, and the rows that do not."""
    good = df.where(fits(declared)).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in declared.fields]
    )
    return good, df.where(~fits(declared))


def conform(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Project to declared names, types and column comments."""
    return df.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in declared.fields
        ]
    )


def append_merged(df: DataFrame, path: str) -> None:
    """Append rows whose columns may go beyond those already there."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read a table grown by ``append_merged``: older rows read NULL in newer columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def export_partitions(
    df: DataFrame,
    path: str,
    key: str,
    fmt: str = "json",
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Write one folder per key value and return the manifest (key, files, rows).

    An ordinary key becomes one file; a hot one is spread over as many as its size asks for. The
    manifest is counted from the files written.
    """
    hot = hot_slots(df, [key]) if hot is None else hot
    if hot:
        spread = with_spread(df, [key], hot, "__slot").repartition(key, "__slot").drop("__slot")
    else:
        spread = df.repartition(key)
    spread.write.mode("overwrite").partitionBy(key).format(fmt).save(path)
    columns = T.StructType([f for f in df.schema.fields])
    written = df.sparkSession.read.format(fmt).schema(columns).load(path)
    return written.groupBy(key).agg(
        F.count_distinct(F.col("_metadata.file_name")).alias("files"),
        F.count("*").alias("rows"),
    )


def insert_by_name(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """INSERT INTO ... BY NAME: columns are matched by name, not position."""
    order: Sequence[str] = spark.table(table).columns
    rows.select(*order).write.insertInto(table)
