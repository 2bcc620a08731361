"""Shared pieces of the corpus operators: settled tables, key groups in sorted tasks, blocks."""

from __future__ import annotations

import hashlib
import io
import os
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.scratch import scratch_dir, write_bytes


PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[tuple[str, str]] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application.

    Spark hands the archive out, as with ``--py-files``, so tasks can import the operators also where
    the executors have no copy of the repository. It lies in the shared checkpoint folder.
    """
    sources = sorted(
        os.path.join(folder, name)
        for folder, _, names in os.walk(PACKAGE)
        for name in names
        if name.endswith(".py")
    )
    digest = hashlib.sha256()
    for path in sources:
        with open(path, "rb") as source:
            digest.update(source.read())
    key = (spark.sparkContext.applicationId, digest.hexdigest())
    if key in _shipped:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sources:
            out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    archive = f"{scratch_dir(spark, 'package')}/millrace_{key[1][:12]}.zip"
    write_bytes(spark, archive, packed.getvalue())
    spark.sparkContext.addPyFile(archive)
    _shipped.add(key)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of the frame is called so, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def per_group(df: DataFrame, keys: list, fn: Callable, schema) -> DataFrame:
    """Apply a pandas function to each group; for groups of bounded size only."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInPandas(fn, schema)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs at most the tasks since the last settled table.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup a task's rows, sorted by a LONG key, so that no key is cut between two tables."""
    held, open_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        others = np.flatnonzero(keys != keys[-1])
        cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and keys[0] != open_key:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
        open_key = keys[-1]
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal keys, and the end of the last one."""
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def in_blocks(members: DataFrame, key: str, ident: str, blocks: Column) -> DataFrame:
    """Spread the members of each key over tasks so that every two of them meet in some task.

    ``blocks`` is the number of blocks of a key, from its aggregated ``n`` rows and ``weight``
    (``members`` carries a ``weight`` column). A key that fits one block gives one task; a larger
    one is cut by a hash of the member and each pair of blocks becomes a task of its own, so no
    task holds more than two blocks, however large the key is. Keys of one member are left out.
    """
    sizes = (
        members.groupBy(key)
        .agg(F.count("*").alias("n"), F.sum("weight").alias("weight_all"))
        .where("n > 1")
        .select(key, blocks.cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64(F.col(ident)), F.col("blocks"))
    return (
        members.join(sizes, key)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn(
            "task", F.xxhash64(F.col(key), F.least("own", "other"), F.greatest("own", "other"))
        )
        .drop("own", "other", "blocks")
    )


def by_task(df: DataFrame, order: str, fn: Callable, schema: str) -> DataFrame:
    """Run ``fn`` over Arrow batches in which the rows of one ``task`` are adjacent and ordered."""
    return map_arrow(
        df.repartition(F.col("task")).sortWithinPartitions("task", order), fn, schema
    )
