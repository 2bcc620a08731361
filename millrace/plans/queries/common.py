"""Exact money arithmetic and derived frames shared by the query modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def cents(column: str) -> Column:
    """An amount with two decimals as a whole number, much cheaper than a cast to decimal."""
    return F.rint(F.col(column) * 100).cast("long")


def exact_sum(units: Column, per_unit: int) -> Column:
    """Sum of whole units, scaled back. Whole numbers make the result independent of the order
    of addition; the wide decimal cannot overflow, however many rows are added."""
    return F.sum(units.cast("decimal(18,0)")).cast("double") / per_unit


def total(column: str) -> Column:
    return exact_sum(cents(column), 100)


def net_units() -> Column:
    """Line amount after discount in ten-thousandths."""
    return cents("l_extendedprice") * (100 - cents("l_discount"))


def net_total() -> Column:
    return exact_sum(net_units(), 10_000)


NET_PRICE_SQL = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


def change_feed(events: DataFrame) -> DataFrame:
    """Events as a change feed of users: errors delete, sign-ups append, the rest update."""
    operation = (
        F.when(F.col("event_type") == "error", "DELETE")
        .when(F.col("event_type") == "signup", "APPEND")
        .otherwise("UPDATE")
    )
    return events.select("user_id", "event_type", "value", operation.alias("operation"), "ts")
