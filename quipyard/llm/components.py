"""Connected components of links by alternating stars, each round a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipyard.session import store


def _least_neighbours(edges: DataFrame) -> DataFrame:
    """Least of a node and its neighbours, over (a, b) rows."""
    return edges.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("least"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) that is not itself the least of its component.

    Neighbours are summed up by partial aggregation and joined back, so a node with very many links
    is dealt out like any skewed join. The number of rounds grows with the logarithm of the longest
    chain. Loops and repeated links are harmless; without links the result is empty.
    """
    edges = store(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.union(edges.select("b", "a"))
        large = both.join(_least_neighbours(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = down.join(_least_neighbours(down), "a")
        moved = small.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            small.select("a", F.col("least").alias("b"))
        )
        after = store(moved.filter("a <> b").distinct(), "links")
        # equal sets of links: a star to the least node of each component
        state = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
        if edges.agg(*state).first() == after.agg(*state).first():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = after
