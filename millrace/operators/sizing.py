"""Plan-size checks and hot-key handling shared by the joins and the change-data operators."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.scratch import scratch_root

BROADCAST_LIMIT = 10 * 1024 * 1024
ROWS_PER_TASK = 2_000_000
HOT_KEYS = 4_096
SKETCH_ITEMS = 65_536
#: The largest sketch that Spark's approx_top_k allows.
MOST_ITEMS = 1_000_000
MAX_CUTS = 65_536
RANGE = "__range"


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's upper estimate of the frame's size; reads plan statistics, runs no job."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def row_bytes(df: DataFrame) -> int:
    """Measured size of all rows: fixed widths, and the lengths of text and nested values.

    Bytes on disk say little, since files of repeated values compress a thousandfold.
    """
    width, parts = 8, []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.octet_length(column))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.octet_length(F.to_json(F.struct(column))))
        width += 16
    total = F.lit(0).cast("long")
    for part in parts:
        total = total + F.coalesce(part, F.lit(0))
    return df.select((F.lit(width) + total).alias("bytes")).agg(F.sum("bytes")).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only below the limit; otherwise the plain frame, joined by shuffle.

    Only a frame that is small on disk is measured, by one pass over it.
    """
    small = plan_bytes(df) <= limit and row_bytes(df) <= limit
    return F.broadcast(df) if small else df


# Plan nodes that give a task the same rows in the same order when it is run again.
_ROW_WISE = {"Project", "Filter", "LogicalRelation", "LogicalRDD", "LocalRelation", "Range", "Generate", "Union"}


def keeps_order(df: DataFrame) -> bool:
    """Whether the frame comes row by row from files, checkpoints or literal rows."""
    open_ = [df._jdf.queryExecution().optimizedPlan()]
    while open_:
        node = open_.pop()
        if node.getClass().getSimpleName() not in _ROW_WISE:
            return False
        open_ += [node.children().apply(i) for i in range(node.children().size())]
    return True


def with_position(df: DataFrame, name: str) -> DataFrame:
    """Add a unique row number that a rerun of a lost task repeats.

    Rows that come straight from files keep their order when a task is run again. Rows that were
    joined, grouped or dealt anew may not, so such a frame is checkpointed first (in the session's
    checkpoint folder).
    """
    if not keeps_order(df):
        scratch_root(df.sparkSession)
        df = df.checkpoint()
    return df.withColumn(name, F.monotonically_increasing_id())


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_task: int
) -> dict[int, int]:
    """Hash and approximate row count of the keys that hold more rows than one task should.

    The sketch is off by less than four rows in ``items`` of all, and of ``n`` rows at most
    ``n / rows_per_task`` keys can be hot. Where the first pass shows that the sketch was too small
    for the table, a second one takes the size that its rows ask for, up to Spark's limit.
    """
    hashed = df.select(key_hash(keys).alias("h"))
    most, items = HOT_KEYS, SKETCH_ITEMS
    while True:
        found = hashed.agg(
            F.count("*").alias("n"), F.expr(f"approx_top_k(h, {most}, {items})").alias("top")
        ).first()
        counts = {item["item"]: item["count"] for item in found["top"] or []}
        counts = {h: count for h, count in counts.items() if count > rows_per_task}
        possible = found["n"] // rows_per_task
        if items >= MOST_ITEMS or (4 * possible <= items and len(counts) < most):
            return counts
        items = min(max(4 * possible, items + 1), MOST_ITEMS)
        most = min(max(possible + 1, most), items)


def hot_slots(
    df: DataFrame,
    keys: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> dict[int, int]:
    """Hash of each key too big for one task, with the number of tasks it should be spread over.

    There are at most MAX_CUTS slots more than hot keys, however large the table.

    One pass over the key columns feeds a frequent-items sketch, so neither the shuffle nor the
    driver grows with the number of keys; a second, larger sketch is taken only for tables of more
    than about ``rows_per_task * SKETCH_ITEMS / 4`` rows or HOT_KEYS hot keys. At most MOST_ITEMS keys
    come back, 16 bytes each. Bytes on disk are no guide here, as copies compress away. The answer only steers
    how rows are spread: a key missed or named in excess changes the layout, never the result.
    """
    counts = _hot_keys(df, keys, rows_per_task)
    rows_per_slot = max(rows_per_task, sum(counts.values()) // MAX_CUTS)
    return {h: math.ceil(n / rows_per_slot) for h, n in counts.items()}


def with_slots(df: DataFrame, keys: Sequence[str], slots: Mapping[int, int]) -> DataFrame:
    """Add ``__slots``: over how many tasks the row's key is spread, 1 for ordinary keys."""
    known = df.sparkSession.createDataFrame(list(slots.items()), "__slot_hash LONG, __slots INT")
    return (
        df.withColumn("__hash", key_hash(keys))
        .join(F.broadcast(known), F.col("__hash") == F.col("__slot_hash"), "left")
        .withColumn("__slots", F.coalesce("__slots", F.lit(1)))
        .drop("__hash", "__slot_hash")
    )


def with_spread(
    df: DataFrame, keys: Sequence[str], slots: Mapping[int, int], name: str
) -> DataFrame:
    """Add a slot number from the row's position: hot keys cycle through their slots, others 0."""
    return (
        with_slots(with_position(df, "__position"), keys, slots)
        .withColumn(name, F.pmod(F.col("__position"), F.col("__slots")).cast("int"))
        .drop("__position", "__slots")
    )


@dataclass(frozen=True)
class KeyRanges:
    """Hot keys by hash with sorted cut points of an order column.

    ``piled`` tells that a single order value holds a large part of some key, as copies do.
    """

    cuts: Mapping[int, list] = field(default_factory=dict)
    piled: bool = False

    def __bool__(self) -> bool:
        return bool(self.cuts)


def hot_ranges(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> KeyRanges:
    """Cut every hot key into ranges of ``order`` of about ``rows_per_task`` rows.

    There are at most MAX_CUTS cut points, however large the table; each key's are picked before
    they come to the driver. Where they fall decides only how evenly a key is spread, so
    approximate ones do.
    """
    counts = _hot_keys(df, keys, rows_per_task)
    if not counts:
        return KeyRanges()
    rows_per_range = max(rows_per_task, sum(counts.values()) // MAX_CUTS)
    wanted = {h: math.ceil(n / rows_per_range) for h, n in counts.items()}
    most = max(wanted.values())
    if most == 1:
        return KeyRanges()
    known = df.sparkSession.createDataFrame(
        [item for item in wanted.items() if item[1] > 1], "h LONG, wanted INT"
    )
    fractions = ", ".join(str(i / most) for i in range(1, most))
    accuracy = max(10_000, 4 * most)
    picked = f"transform(sequence(1, wanted - 1), i -> element_at(cuts, int(i * {most}L div wanted)))"
    rows = (
        df.select(key_hash(keys).alias("h"), F.col(order).alias("o"))
        .join(F.broadcast(known), "h")
        .groupBy("h", "wanted")
        .agg(F.expr(f"percentile_approx(o, array({fractions}), {accuracy})").alias("cuts"))
        .select("h", F.array_sort(F.array_compact(F.array_distinct(F.expr(picked)))).alias("cuts"), "wanted")
        .collect()
    )
    cuts = {h: [] for h in wanted} | {row["h"]: row["cuts"] for row in rows}
    piled = any(len(row["cuts"]) < row["wanted"] - 1 for row in rows)
    return KeyRanges(cuts, piled)


def with_range(df: DataFrame, keys: Sequence[str], order: str, ranges: KeyRanges) -> DataFrame:
    """Add the number of the range a row of a hot key falls into, -1 for every other row.

    The cut points come by broadcast; a binary search over them finds the range.
    """
    cut_schema = T.StructType(
        [
            T.StructField("__cut_hash", T.LongType()),
            T.StructField("__cuts", T.ArrayType(df.schema[order].dataType)),
        ]
    )
    cuts = df.sparkSession.createDataFrame(list(ranges.cuts.items()), cut_schema)
    longest = max(len(c) for c in ranges.cuts.values())
    steps = F.array(*[F.lit(2**bit) for bit in reversed(range(max(1, longest.bit_length())))])
    below = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            F.get("__cuts", at + step - 1) < F.col(order), at + step
        ).otherwise(at),
    )
    return (
        df.withColumn("__hash", key_hash(keys))
        .join(F.broadcast(cuts), F.col("__hash") == F.col("__cut_hash"), "left")
        .withColumn(RANGE, F.when(F.col("__cuts").isNull(), F.lit(-1)).otherwise(below))
        .drop("__hash", "__cut_hash", "__cuts")
    )


def with_next(df: DataFrame, by: Sequence[str], order: str, out: str) -> DataFrame:
    """Add ``out``: the next larger ``order`` within ``by``, NULL on the last row."""
    return df.withColumn(out, F.lead(order).over(Window.partitionBy(*by).orderBy(order)))


def close_seams(
    df: DataFrame, ranged: DataFrame, keys: Sequence[str], order: str, out: str
) -> DataFrame:
    """Fill ``out`` on the last row of each range with the first ``order`` of the next one.

    ``ranged`` holds all rows with their range number. Only the first value of every range of a
    hot key is needed, a bounded number, so it is joined by broadcast.
    """
    across = Window.partitionBy("__seam_key").orderBy("__seam_range")
    heads = (
        ranged.where(F.col(RANGE) >= 0)
        .groupBy(F.struct(*keys).alias("__seam_key"), F.col(RANGE).alias("__seam_range"))
        .agg(F.min(order).alias("__head"))
        .withColumn("__next_head", F.lead("__head").over(across))
        .drop("__head")
    )
    seam = F.struct(*keys).eqNullSafe(F.col("__seam_key")) & (
        F.col(RANGE) == F.col("__seam_range")
    )
    return (
        df.join(F.broadcast(heads), seam, "left")
        .withColumn(out, F.coalesce(out, "__next_head"))
        .drop("__seam_key", "__seam_range", "__next_head")
    )
