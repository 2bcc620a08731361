"""Session construction for local runs and tuning settings for an existing session."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024


def local_session(cpus: int | str = "*", app: str = "millrace") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings the session."""
    partitions = cpus if isinstance(cpus, int) else 8
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame on the executors while several actions read it, and release it afterwards.

    Lost blocks are recomputed from the lineage, so losing an executor costs time, not rows.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 * MIB, floor: int = 8) -> int:
    """Partition count that keeps one shuffle partition near ``target_bytes``."""
    return max(floor, -(-input_bytes // target_bytes))


def tune(
    spark: SparkSession,
    *,
    input_bytes: int | None = None,
    broadcast_threshold: int | None = None,
) -> dict[str, str]:
    """Apply runtime SQL settings for a job and return what was set.

    Adaptive execution stays on: it coalesces the shuffle partitions that turn out small and
    splits the skewed ones of a sort-merge join, so the partition count is only an upper guide.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes))
    if broadcast_threshold is not None:
        settings["spark.sql.autoBroadcastJoinThreshold"] = str(broadcast_threshold)
    for key, value in settings.items():
        spark.conf.set(key, value)
    return settings
