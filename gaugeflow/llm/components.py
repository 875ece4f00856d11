"""Connected components of a graph held as a DataFrame of edges.

Alternates the large-star and small-star steps of Kiveris et al. (2014), which
need a logarithmic number of rounds in practice and never gather a node's
neighbours: a step is a minimum per node joined back to the edges. Each round is
written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the edges (a, b); a component is its smallest node."""
    held = materialize(_ordered(edges), "components")
    before = _digest(held)
    while before[0]:
        held = materialize(_small_star(_large_star(held)), "components")
        after = _digest(held)
        if after == before:
            break
        before = after
    roots = held.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return held.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()


def _ordered(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = (edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
    return rest.union(least).distinct()
