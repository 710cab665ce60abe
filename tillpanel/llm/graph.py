"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join back; nothing is collected. Each round is written to the
shared folder, so a lost executor costs one round at most. The number of rounds grows with the
logarithm of the longest path, and is two or three for star-shaped groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import discard, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node move to the smallest node around it."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("least"))
    return (
        around.join(least, "a").filter("b > a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).filter("a <> b")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); a component is named by its smallest node."""
    current = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        before, current = current, stored(_small_star(_large_star(current)).distinct(), "edges")
        discard(before)
        state = current.agg(
            F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("mark")
        ).first()
        if (state.n, state.mark) == seen:
            break
        seen = (state.n, state.mark)
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.union(centres)
