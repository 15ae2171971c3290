"""Connected components of a link table, by alternating large-star and small-star rounds.

The two star steps are from Kiveris et al., "Connected Components in MapReduce and
Beyond" (2014). A hub's neighbours are only ever reduced to their minimum, never
collected, and both steps are an aggregate with map-side combine plus an equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.session import checkpointed


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Re-link neighbours of every node to the least node around it."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if larger:
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return (
            both.join(least, "a")
            .filter((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
    # small star: each node's smaller neighbours, and the node itself, go to their least
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return (
        joined.filter(F.col("b") != F.col("m"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def component_labels(links: DataFrame) -> DataFrame:
    """``a, b`` pairs in, ``node, component`` out for every linked node.

    The component is the least node in it. Rounds run until every node hangs on a
    root, which simple links do from the start; every round is checkpointed, so a
    lost executor costs one round.
    """
    apart = links.filter(F.col("a") != F.col("b"))
    current = checkpointed(
        apart.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not _hang_on_roots(current):
        current = checkpointed(_star(_star(current, larger=True), larger=False))
    return (
        current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .union(current.select(F.col("b").alias("node"), F.col("b").alias("component")))
        .distinct()
    )


def _hang_on_roots(links: DataFrame) -> bool:
    """True when each ``a`` has one ``b`` and no ``b`` is itself an ``a``."""
    sides = links.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"))
    )
    per_node = sides.groupBy("node").agg(F.sum("up").alias("ups"), F.count("*").alias("n"))
    return per_node.filter("ups > 1 OR (ups = 1 AND n > 1)").isEmpty()
