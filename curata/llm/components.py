"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curata.session import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node but the roots: root is the smallest node of the component.

    ``edges``: two columns of nodes that can be ordered; loops, repeated edges and nulls are allowed and add nothing. Alternates stars towards the
    smallest neighbour over larger neighbours and over smaller ones until only stars are left, in a number of rounds
    that grows with the logarithm of the size. Each round is written, so a lost executor costs one round; minima are
    combined before they are shuffled and written before they are joined, so the join can split a node with very many edges.
    """
    a, b = edges.columns
    state = settle(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while not _only_stars(state):
        state = settle(_small_star(settle(_large_star(state))))
    return state.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _only_stars(state: DataFrame) -> bool:
    """Every node points to one other, and nothing points on from there."""
    ends = state.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in"))
    ends = ends.union(state.select("v", F.lit(0), F.lit(1)))
    counted = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return not counted.where("out > 1 or (out > 0 and in > 0)").limit(1).count()


def _large_star(state: DataFrame) -> DataFrame:
    both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m")))
    return both.join(least, F.col("u") == F.col("n")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(state: DataFrame) -> DataFrame:
    least = settle(state.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m"))
    others = state.join(least, F.col("u") == F.col("n")).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select(F.col("n"), F.col("m"))).distinct()
