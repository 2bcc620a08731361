"""The query catalogue: named functions over the test tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace import scratch


class Tables:
    """The input tables as attributes (``t.orders``), read lazily, plus scratch folders."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, *names: str) -> SparkSession:
        """Register the named tables as views for SQL text."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)
        return self.spark

    def scratch(self, name: str) -> str:
        return scratch.scratch_dir(self.spark, name)

    def table_name(self, name: str) -> str:
        """A catalog table name that no other run uses."""
        return scratch.scratch_dir(self.spark, name).rsplit("/", 1)[1].replace("-", "_")


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a function under its own name, or ``name`` where an operator has that name.

    ``sql`` states the same result for the oracle.
    """

    def register(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or run.__name__
        if key in CATALOG:
            raise ValueError(f"query {key} is registered twice")
        CATALOG[key] = Query(run, sql)
        return run

    return register


def bind(item: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: item.run(Tables(spark, folder))
