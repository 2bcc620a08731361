"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import settle

#: A node is a hub beyond so many edges, or beyond the share that leaves at most MOST_HUBS hubs.
HUB_ROWS = 1_000
MOST_HUBS = 10_000


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")
    ).first()
    return row["n"], row["h"]


def _with_least(edges: DataFrame, name: str, hub_rows: int) -> tuple[DataFrame, DataFrame]:
    """Each edge beside the smallest ``m`` of its ``u`` and all of u's ends; and ``m`` of every ``u``.

    Edges of a node with more than ``hub_rows`` of them stay where they are and meet their hub by a
    broadcast, so one hub never fills a task; the rest meet by one shuffle on ``u``. The table of
    smallest ends is settled, so that no later plan repeats how it came about.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    least = settle(least.select("u", F.least("u", "m").alias("m"), "n"), f"{name}-least")
    most = least.agg(F.max("n")).first()[0]
    if most is None or most <= hub_rows:
        return edges.join(least.select("u", "m"), "u"), least
    hubs = F.broadcast(least.where(F.col("n") > hub_rows).select("u", "m"))
    rest = least.where(F.col("n") <= hub_rows).select("u", "m")
    near = edges.join(hubs, "u").unionByName(edges.join(hubs, "u", "left_anti").join(rest, "u"))
    return near, least


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Link every node to the smallest node of its component: columns ``node`` and ``root``.

    ``edges`` has LONG columns ``u`` and ``v``; loops are ignored and nodes without an edge are
    not returned. Works by alternating large-star and small-star steps: in turn, each node hands
    its larger neighbours, then its smaller ones, to its smallest neighbour, until only stars are
    left. Each step is a grouped minimum, combined before the shuffle, and a join; no node's
    neighbours are ever gathered, and the links stay distributed from the first step to the last.
    Each step reads settled tables only, so its plan, which the driver holds and keeps record of,
    is a join of two tables, however the links came about.

    Hubs are broadcast to their edges. A step joins at most ``2 * n`` rows for ``n`` edges, and a hub
    has more than ``max(HUB_ROWS, 2 * n / MOST_HUBS)`` of them, so there are fewer than ``MOST_HUBS``.
    """
    edges = settle(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        name,
    )
    state = _fingerprint(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hub_rows = max(HUB_ROWS, 2 * state[0] // MOST_HUBS)
        met, _ = _with_least(both, name, hub_rows)
        large = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large, f"{name}-large")
        met, smallest = _with_least(large, name, hub_rows)
        small = (
            met.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(smallest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = settle(small, name)
        before, state = state, _fingerprint(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
