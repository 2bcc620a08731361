"""Idempotent batch loads: files named in the ledger are never loaded again."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace import scratch
from millrace.sources.files import list_files, read_files

#: Files of one load, whose names the driver holds.
MAX_FILES = 50_000
_LEDGER = "path STRING, modificationTime TIMESTAMP, length LONG, load_id INT"


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the complete loads; a load counts once its ledger entry is fully written."""
    done = [
        f"{folder}/{name}"
        for name in scratch.child_names(spark, folder)
        if scratch.exists(spark, f"{folder}/{name}/_SUCCESS")
    ]
    if not done:
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).option("basePath", folder).parquet(*done)


def copy_into(
    spark: SparkSession,
    target: str,
    src: str,
    fmt: str,
    *,
    ledger: str,
    schema: T.StructType | str | None = None,
    merge_schema: bool = False,
    max_files: int = MAX_FILES,
    **options,
) -> int:
    """Load the files of ``src`` not loaded before; returns how many were new.

    The folder is listed and compared with the ledger once. All new files are loaded in one ordered
    pass over that list, at most ``max_files`` in one load: the driver holds the names of one load at
    a time, however many files there are.

    The load number follows from the ledger, which is written last: a load that fails halfway is
    simply overwritten by the next attempt. A new column needs ``merge_schema``.
    """
    scratch.scratch_root(spark)
    known = _ledger(spark, ledger)
    fresh = list_files(spark, src).join(known.select("path"), "path", "left_anti")
    listed = fresh.orderBy("path").checkpoint().toLocalIterator(prefetchPartitions=True)
    loaded = 0
    while files := list(itertools.islice(listed, max_files)):
        _load(spark, files, _ledger(spark, ledger), target, fmt, ledger, schema, merge_schema, options)
        loaded += len(files)
    return loaded


def _load(spark, files, known, target, fmt, ledger, schema, merge_schema, options) -> None:
    paths = [row["path"] for row in files]
    last = known.agg(F.max("load_id")).first()[0]
    load_id = 0 if last is None else last + 1
    rows = read_files(spark, paths, fmt, schema=schema, **options)
    if load_id > 0 and not merge_schema:
        present = read_loaded(spark, target, ledger).columns
        added = [c for c in rows.columns if c not in present]
        if added:
            raise ValueError(f"new columns {added}: pass merge_schema=True to accept them")
    rows.write.mode("overwrite").parquet(f"{target}/load_id={load_id}")
    entry = spark.createDataFrame([(*row, load_id) for row in files], _LEDGER)
    entry.drop("load_id").write.mode("overwrite").parquet(f"{ledger}/load_id={load_id}")


def read_loaded(spark: SparkSession, target: str, ledger: str) -> DataFrame:
    """Rows of the complete loads only."""
    done = [
        f"{target}/{name}"
        for name in scratch.child_names(spark, ledger)
        if scratch.exists(spark, f"{ledger}/{name}/_SUCCESS")
    ]
    reader = spark.read.option("basePath", target).option("mergeSchema", True)
    return reader.parquet(*done).drop("load_id")
