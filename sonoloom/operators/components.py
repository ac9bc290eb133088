"""Connected components of an edge table by alternating large-star / small-star rounds.

Every round is a minimum per node and one equi-join, so the work is shuffled by node and the
number of rounds grows with the logarithm of the component size (Kiveris et al., 2014).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoloom.session import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    linked = both.filter(F.col("b") > F.col("a")).join(lowest, "a")
    return linked.select(F.col("low").alias("a"), "b").filter(F.col("a") != F.col("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = down.groupBy("a").agg(F.min("b").alias("low"))
    linked = down.join(lowest, "a").select(F.col("low").alias("a"), "b")
    own = lowest.select(F.col("low").alias("a"), F.col("a").alias("b"))
    return linked.union(own).filter(F.col("a") != F.col("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and two order-free hashes: equal marks mean equal edge sets."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; a component is named by its least node."""
    current = checkpointed(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    mark = _mark(current)
    while True:
        current = checkpointed(_small_star(_large_star(current)))
        after = _mark(current)
        if after == mark:
            break
        mark = after
    roots = current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
