"""Bases that hold all batches up to one, so that reads don't grow with the number of batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import scratch
from millrace.sources.files import list_files
from millrace.streaming.flows import batch_folder, read_batches


def folded_upto(spark: SparkSession, base: str) -> int:
    """Last batch contained in the newest complete base, -1 without one."""
    done = [
        int(name.removeprefix("upto="))
        for name in scratch.child_names(spark, base)
        if scratch.exists(spark, f"{base}/{name}/_SUCCESS")
    ]
    return max(done, default=-1)


def _numbers(spark: SparkSession, batches: str) -> list[int]:
    names = scratch.child_names(spark, batches)
    return [int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")]


def read_parts(spark: SparkSession, batches: str, base: str) -> tuple[DataFrame | None, DataFrame | None]:
    """The newest base and the rows of the batches after it, None for what there is not.

    The files of older batches are not even listed.
    """
    upto = folded_upto(spark, base)
    if upto < 0:
        return None, read_batches(spark, batches).drop("batch_id")
    folded = spark.read.parquet(f"{base}/upto={upto}")
    later = [batch_folder(batches, n) for n in _numbers(spark, batches) if n > upto]
    if not later:
        return folded, None
    return folded, spark.read.option("basePath", batches).parquet(*later).drop("batch_id")


def read_folded(spark: SparkSession, batches: str, base: str) -> DataFrame:
    """The newest base and the batches after it as one frame."""
    folded, fresh = read_parts(spark, batches, base)
    if folded is None or fresh is None:
        return fresh if folded is None else folded
    return folded.unionByName(fresh, allowMissingColumns=True)


def write_base(
    spark: SparkSession, batches: str, base: str, merge: Callable[[DataFrame], DataFrame]
) -> int:
    """Write a new base of all batches so far, merged; returns the last batch it contains.

    The old base and the batches stay where they are, so readers and a failed fold are safe.
    Run it between stream runs.
    """
    upto = max(_numbers(spark, batches))
    if upto > folded_upto(spark, base):
        merge(read_folded(spark, batches, base)).write.mode("overwrite").parquet(f"{base}/upto={upto}")
    return upto


def is_due(spark: SparkSession, batches: str, base: str, ratio: float) -> bool:
    """Whether more than one batch came after the base, together above ``ratio`` times its bytes.

    Bases then grow by a factor each, so all folds together write a small multiple of the data.
    """
    upto = folded_upto(spark, base)
    number = F.regexp_extract("path", "/batch_id=([0-9]+)/", 1).cast("long")
    files = list_files(spark, batches, pathGlobFilter="*.parquet").select(number.alias("n"), "length")
    fresh = files.where(F.col("n") > upto).agg(F.sum("length"), F.count_distinct("n")).first()
    if fresh[1] < 2:
        return False
    if upto < 0:
        return True
    held = list_files(spark, f"{base}/upto={upto}", pathGlobFilter="*.parquet")
    return fresh[0] > ratio * (held.agg(F.sum("length")).first()[0] or 0)
