"""Version reads over an append-only change log.

A log row is a table row plus ``commit_version``, ``commit_ts`` and ``op``
(insert, update or delete). A key appears at most once per commit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

META = ("commit_version", "commit_ts", "op")


def as_commit(rows: DataFrame, version: int, ts: str, op: str) -> DataFrame:
    """Tag rows as one commit of the log."""
    return rows.select(
        F.lit(version).alias("commit_version"),
        F.lit(ts).cast("timestamp_ntz").alias("commit_ts"),
        F.lit(op).alias("op"),
        *rows.columns,
    )


def history(log: DataFrame) -> DataFrame:
    """One row per commit and operation."""
    return log.groupBy("commit_version", "commit_ts", "op").agg(F.count("*").alias("rows"))


def _last_change(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in log.columns if c not in keys]
    return (
        log.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "commit_version").alias("__row"))
        .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
        .select(*log.columns)
    )


def _within(version: int | None, timestamp: str | None) -> Column:
    if (version is None) == (timestamp is None):
        raise ValueError("give either a version or a timestamp")
    if version is not None:
        return F.col("commit_version") <= version
    return F.col("commit_ts") <= F.lit(timestamp).cast("timestamp_ntz")


def as_of(
    log: DataFrame,
    keys: Sequence[str],
    *,
    version: int | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """The table as it stood at a version or a time."""
    live = _last_change(log.where(_within(version, timestamp)), keys).where("op <> 'delete'")
    return live.drop(*META)


def restore(
    log: DataFrame, keys: Sequence[str], version: int, new_version: int, ts: str
) -> DataFrame:
    """The log plus one commit that brings the table back to ``version``.

    Only rows that differ are written. One grouped pass gives both states of a key: its last
    change of all, and its last one up to ``version``.
    """
    keys = list(keys)
    values = [c for c in log.columns if c not in {*META, *keys}]
    row, at = F.struct("op", F.struct(*values).alias("row")), F.col("commit_version")
    old = at <= version
    live = lambda c: F.when(F.col(f"{c}.op") != "delete", F.col(f"{c}.row"))
    changed = (
        log.groupBy(*keys)
        .agg(
            F.max_by(row, at).alias("__last"),
            F.max_by(F.when(old, row), F.when(old, at)).alias("__was"),
        )
        .select(*keys, live("__last").alias("__now"), live("__was").alias("__then"))
        .where(~F.col("__then").eqNullSafe(F.col("__now")))
        .withColumn(
            "op",
            F.when(F.col("__then").isNull(), "delete")
            .when(F.col("__now").isNull(), "insert")
            .otherwise("update"),
        )
        .withColumn("__row", F.coalesce("__then", "__now"))
    )
    commit = changed.select(
        F.lit(new_version).alias("commit_version"),
        F.lit(ts).cast("timestamp_ntz").alias("commit_ts"),
        "op",
        *keys,
        *[F.col(f"__row.{c}").alias(c) for c in values],
    )
    return log.unionByName(commit)


def prune(log: DataFrame, keys: Sequence[str], hours: int) -> DataFrame:
    """Drop log rows no read inside the retention window needs.

    Kept are all changes newer than the cut, and per key the last one at or before it unless
    that is a delete. Reads at the cut or later give the same rows as before.
    """
    cut = log.agg((F.max("commit_ts") - F.expr(f"INTERVAL {int(hours)} HOURS")).alias("c")).scalar()
    recent = log.where(F.col("commit_ts") > cut)
    base = _last_change(log.where(F.col("commit_ts") <= cut), keys).where("op <> 'delete'")
    return base.unionByName(recent)
