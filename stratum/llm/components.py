"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import stored


def _neighbours(edges: DataFrame) -> DataFrame:
    """(u, lo, hi): the least and the largest v of each u.  Stored, so that the join with a hot u
    reads two shuffles and adaptive execution can split it."""
    return stored(edges.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi")), "cc-least")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (u, v) but the roots.

    The component is the least node that edges reach; roots have no row, so a
    caller takes ``coalesce(component, node)``.  Self-loops, repeated and
    two-way edges are fine; edges with a null end are none.  A round hooks all
    larger neighbours of a node to its least one (large star), then all smaller
    ones (small star); rounds grow with the logarithm of the longest path.
    They end when every node has either no smaller neighbour or that one alone.
    """
    ends = edges.select("u", "v").dropna().filter("u <> v")
    current = stored(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _neighbours(both)
        if least.filter("lo < u AND lo < hi").isEmpty():
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        large = (
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("lo", "u").alias("v"))
            .distinct()
        )
        large = stored(large, "cc-large")
        least = _neighbours(large)
        moved = large.join(least, "u").filter("v <> lo").select(F.col("v").alias("u"), F.col("lo").alias("v"))
        current = stored(moved.union(least.select("u", F.col("lo").alias("v"))).distinct(), "cc-edges")


def merged_components(known: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``connected_components`` of the edges that ``known`` came from and of ``edges`` together.

    Only the edges between known components are gone through in rounds.
    ``edges`` is a stored table; without rows it costs no round.
    """
    if known is None:
        return connected_components(edges)
    if edges.isEmpty():
        return known
    for end in ("u", "v"):
        of_end = known.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component"))
        edges = edges.join(of_end, end, "left").withColumn(end, F.coalesce(f"{end}_component", end))
    more = connected_components(edges)
    above = more.select(F.col("node").alias("component"), F.col("component").alias("above"))
    moved = known.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
    return stored(moved.union(more), "cc-merged")
