"""JDBC reads: partitioned, incremental by high-water mark, and filtered at the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    *,
    driver: str | None = None,
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 8,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; a partition column splits the read into parallel range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if driver is not None:
        options["driver"] = driver
    if column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def newer_than(table: str, column: str, mark: object) -> str:
    """A subquery for the rows beyond the mark, evaluated by the database."""
    literal = mark if isinstance(mark, (int, float)) else f"'{mark}'"
    return f"(SELECT * FROM {table} WHERE {column} > {literal}) newer"


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A JDBC table or subquery; filters on the frame are pushed to the database by Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def pull_newer(
    spark: SparkSession, url: str, table: str, column: str, mark: object | None, **options
) -> DataFrame:
    """Rows beyond the high-water mark, or all of them on the first pull."""
    source = table if mark is None else newer_than(table, column, mark)
    return read_jdbc(spark, url, source, **options)
