"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shared import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are hung to its least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("w").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are hung to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("w"))
    moved = edges.join(least, "u").filter("v <> w").select(F.col("v").alias("u"), F.col("w").alias("v"))
    return moved.unionByName(least.select("u", F.col("w").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` of every node that has an edge; root: its component's least node.

    ``edges``: any pairs of numbers; loops, repeats and both directions are
    fine, no edges give no rows.  Each round is written to the shared folder;
    the number of rounds grows with the logarithm of the longest chain.  A
    star's centre may have any number of leaves: minima are combined before
    the shuffle, and the joins have one row per node on one side, so Spark
    can split the other.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e = saved(e, "edges")
    before = _state(e)
    while before[0]:
        e = saved(_small_star(_large_star(e)), "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
