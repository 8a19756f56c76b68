"""Connected components of an undirected edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.session import checkpoint

#: Edges a task takes at most, where a round's edges would fill fewer tasks than there are shuffle partitions.
EDGES_A_TASK = 50_000


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Large-star hooks every larger neighbour of a node onto the smallest neighbour, small-star does
    the same for the smaller ones, until the edge set no longer changes (rounds grow with the
    logarithm of the component sizes).  Each half is a minimum per node, with map-side partials,
    joined back, so a hot node is split by the adaptive skew join.  No round has more edges than the one
    before, so the count of edges sizes its tasks: rounds of few edges write few files.  Nothing but a
    count and a checksum reaches the driver.  Null ends are ignored.
    """
    edges = checkpoint(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    )
    before = _state(edges)
    while before[0]:
        tasks = before[0] // EDGES_A_TASK + 1
        edges = edges.coalesce(tasks)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").coalesce(tasks).distinct().coalesce(tasks)
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_least, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(joined.select("u", F.col("m").alias("v")))
            .filter("u > v")
            .coalesce(tasks)
            .distinct()
        )
        edges = checkpoint(small.coalesce(tasks))
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
