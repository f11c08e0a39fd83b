"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Step


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is its smallest node.

    Each round links the neighbours of every node to the smallest among them; the rounds grow
    with the logarithm of the longest path. A node with very many neighbours is pre-aggregated
    to its smallest one, and its edges are split at run time by the skew join. Edges go to the
    scratch folder after each round. Loops and repeated edges may occur; there may be none.
    """
    step = Step(_ordered(edges), "edges")
    state = _signature(step.df)
    while True:
        after = Step(_small_star(_large_star(step.df)), "edges")
        step.drop()
        step, before, state = after, state, _signature(after.df)
        if state == before:
            break
    found = step.df
    roots = found.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return found.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller one."""
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    return edges.where(F.col("a") != F.col("b")).select(larger, smaller).distinct()


def _signature(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mark), F.bit_xor(F.xxhash64(mark))).head())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    linked = both.join(least, "a").where(F.col("b") > F.col("a"))
    return _ordered(linked.select(F.col("b").alias("a"), F.least("a", "m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(linked.unionByName(least.withColumnRenamed("m", "b")))
