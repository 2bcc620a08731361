"""Skew, file and run-history diagnostics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# When a run counts as regressed or as a cold start.
REGRESSION_FACTOR = 3
COLD_START_MINUTES = 5


def key_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"))


def skew_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest and median key size and their ratio.

    The sizes are counted by value first, so the weighted median sees one entry per distinct
    size: far fewer than keys, since n different sizes need about n*n/2 rows.
    """
    sizes = key_sizes(df, keys).groupBy("rows").agg(F.count("*").alias("n_keys"))
    stats = sizes.agg(
        F.sum("n_keys").alias("n_keys"),
        F.sum(F.col("rows") * F.col("n_keys")).alias("n_rows"),
        F.max("rows").alias("max_rows"),
        F.percentile("rows", F.lit(0.5), F.col("n_keys")).alias("median_rows"),
    )
    return stats.withColumn(
        "max_to_median", F.try_divide(F.col("max_rows").cast("double"), F.col("median_rows"))
    )


def file_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and min/max of each column per data file: what a range predicate can skip."""
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("rows"), *bounds
    )


def skippable_files(profile: DataFrame, column: str, low, high) -> DataFrame:
    """How many files a range predicate on ``column`` must read and may skip."""
    needed = (F.col(f"max_{column}") >= low) & (F.col(f"min_{column}") <= high)
    return profile.agg(
        F.count_if(needed).alias("files_read"), F.count_if(~needed).alias("files_skipped")
    )


def run_trends(
    runs: DataFrame, job: str, duration: str, queue_minutes: str, failed: str
) -> DataFrame:
    """Runs flagged against their job's median duration, plus the job's failure rate.

    ``runs`` is a run history, one row per run, so a job's group is its number of runs.
    """
    per_job = runs.groupBy(job).agg(
        F.median(duration).alias("median_duration"),
        F.avg(F.col(failed).cast("double")).alias("failure_rate"),
    )
    return runs.join(per_job, job).select(
        *runs.columns,
        "median_duration",
        "failure_rate",
        (F.col(duration) >= REGRESSION_FACTOR * F.col("median_duration")).alias("regressed"),
        (F.col(queue_minutes) > COLD_START_MINUTES).alias("cold_start"),
    )
