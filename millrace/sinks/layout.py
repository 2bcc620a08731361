"""File layout: compaction, multi-column clustering, bucketing."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace import scratch
from millrace.operators.sizing import row_bytes, with_position
from millrace.sources.files import list_files

#: Bytes of plain rows that make a file; Parquet packs them to about a quarter.
ROW_BYTES = 1024 * 1024 * 1024
SAMPLE_PER_RANGE = 100


def target_files(total_bytes: int, file_bytes: int = 256 * 1024 * 1024) -> int:
    return max(1, -(-total_bytes // file_bytes))


def files_for(df: DataFrame) -> int:
    """Files that the rows fill, by their measured size: Catalyst's estimates multiply at joins."""
    return target_files(row_bytes(df), ROW_BYTES)


def compact(spark: SparkSession, src: str, dst: str, file_bytes: int = 256 * 1024 * 1024) -> int:
    """Rewrite many small files to few of about ``file_bytes``; returns the file count aimed at.

    Splits are packed into tasks by size without a shuffle: the scan itself reads as many small
    files per task as fill one output file. Fails unless the row counts agree.
    """
    total = list_files(spark, src, pathGlobFilter="*.parquet").agg(F.sum("length")).first()[0] or 0
    files = target_files(total, file_bytes)
    source = spark.read.parquet(src)
    source.coalesce(files).write.mode("overwrite").parquet(dst)
    before, after = source.count(), spark.read.parquet(dst).count()
    if before != after:
        raise RuntimeError(f"compaction of {src} wrote {after} of {before} rows")
    return files


def rank_bits(files: int, columns: int) -> int:
    """Bits per column that tell apart twice as many ranges as there are files."""
    return math.ceil(math.log2(max(files, 2)) / columns) + 1


def _cut_points(df: DataFrame, columns: Sequence[str], ranges: int) -> DataFrame:
    """One row with an array per column: values at equal ranks of a sample of the rows.

    The values themselves are sorted, so any type that Spark can sort will do, and an odd value moves
    a cut by one place at most. ``SAMPLE_PER_RANGE`` rows a range are expected; a table with fewer
    rows is taken whole. The sample steers the layout only.
    """
    wanted, rows = SAMPLE_PER_RANGE * ranges, df.count()
    some = df.select(*columns) if rows <= wanted else df.select(*columns).sample(wanted / rows, seed=11)
    held = some.agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in columns])

    def picked(column: str) -> Column:
        place = lambda i: F.floor(i * F.size(column) / ranges).cast("int")
        cuts = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get(column, place(i)))
        return F.array_distinct(F.array_compact(cuts))

    return held.select(*[picked(c).alias(c) for c in columns])


def _rank(column: str, cuts: str, ranges: int) -> Column:
    """Number of cut points not above the value, by binary search; 0 for NULL."""
    steps = F.array(*[F.lit(2**bit) for bit in reversed(range(max(1, ranges.bit_length())))])
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) <= F.col(column), at + step).otherwise(at),
    )
    return F.coalesce(found, F.lit(0)).cast("long")


def with_cluster_key(
    df: DataFrame, columns: Sequence[str], key: str, files: int = 1024
) -> DataFrame:
    """Add a number that keeps rows close that are close in every column: interleaved rank bits.

    A column's ranks come from cut points of its own values; there are twice as many ranges as
    ``files`` files need, whatever their number.
    """
    width = rank_bits(files, len(columns))
    cuts = _cut_points(df, columns, 2**width)
    held = df.withColumn("__cuts", cuts.select(F.struct(*columns)).scalar())
    ranks = {c: f"__rank_{i}" for i, c in enumerate(columns)}
    ranked = held.withColumns({ranks[c]: _rank(c, f"__cuts.{c}", 2**width) for c in columns})
    bits = F.lit(0).cast("long")
    for bit in range(width):
        for position, column in enumerate(columns):
            one = F.shiftright(F.col(ranks[column]), bit).bitwiseAND(F.lit(1))
            bits = bits.bitwiseOR(F.shiftleft(one, bit * len(columns) + position))
    return ranked.withColumn(key, bits).drop("__cuts", *ranks.values())


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, mode: str = "overwrite"
) -> None:
    """Write ``df`` so that each file covers a small range of every clustering column.

    Without ``files`` the number follows the measured size of the rows. A single column is laid out
    by its values themselves.

    Range partitioning on the key alone would leave equal keys in one task, so the row position
    breaks ties and a single hot value still fills many files.
    """
    numbered = with_position(df, "__tie")
    files = files or files_for(numbered)
    if len(columns) > 1:
        numbered = with_cluster_key(numbered, columns, "__cluster", files)
        order = ["__cluster"]
    else:
        order = list(columns)
    laid_out = numbered.repartitionByRange(files, *order, "__tie").sortWithinPartitions(*order)
    laid_out.drop("__cluster", "__tie").write.mode(mode).parquet(path)


def set_clustering(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """Choose the clustering columns of later appends; files already there stay as they are."""
    scratch.write_text(spark, f"{path}/_clustering.json", json.dumps(list(columns)))


def clustering(spark: SparkSession, path: str) -> list[str]:
    return json.loads(scratch.read_text(spark, f"{path}/_clustering.json") or "[]")


def append_clustered(df: DataFrame, path: str, files: int | None = None) -> None:
    """Append rows clustered by the columns chosen for the table."""
    columns = clustering(df.sparkSession, path)
    if not columns:
        raise ValueError(f"no clustering columns chosen for {path}")
    write_clustered(df, path, columns, files, mode="append")


def buckets_for(df: DataFrame) -> int:
    """Buckets of about a file each, and no fewer than tasks run side by side."""
    return max(df.sparkSession.sparkContext.defaultParallelism, files_for(df))


def write_bucketed(
    df: DataFrame, name: str, path: str, key: str, buckets: int, sort_by: str | None = None
) -> None:
    """A catalog table bucketed and sorted on its join key, joined later without a shuffle."""
    writer = df.write.mode("overwrite").option("path", path).bucketBy(buckets, key)
    writer.sortBy(sort_by or key).saveAsTable(name)
