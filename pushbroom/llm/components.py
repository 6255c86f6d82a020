"""Connected components of an edge table by alternating large and small stars.

Every round is two joins and two aggregates over the edges; no component is
ever gathered in one task or on the driver. Rounds grow with the logarithm of
the longest chain, and each round's edges are written before the next reads them. The hub of a star may hold most edges: sums by
node are combined before they are dealt, and joins by node send the sums to all tasks where they are few, else stand alone between two shuffles, where Spark splits
a large key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Workspace, broadcast_within

#: Edges up to which sums by node are broadcast (about 30 bytes each).
MANY_EDGES = 200_000


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) to (node, component), component being the least node reachable.

    Nodes without an edge to another node are absent from the result. Loops, repeated
    edges and either direction are allowed; edges with a null end are ignored.
    """
    e = ws.table(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    seen = _print(e)
    # every round has at most as many nodes as twice its edges
    by_node = lambda sums, edges: broadcast_within(sums, 2 * edges, MANY_EDGES) if 2 * edges <= MANY_EDGES else ws.table(sums, "sums")
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = by_node(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), seen[0])
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large if 2 * seen[0] <= MANY_EDGES else ws.table(large, "large")  # it is read three times
        least = by_node(large.groupBy("u").agg(F.min("v").alias("m")), seen[0])
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = ws.table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _print(new)
        e, done = new, now == seen
        if done:
            break
        seen = now
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
