"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (``a``, ``b``).

    Alternates large-star and small-star steps until nothing changes: each node
    first links its larger neighbours, then its smaller ones, to the smallest
    node it knows. Rounds grow with the logarithm of the longest chain. A table
    per round is written to the shared folder. Self-loops and repeated edges do
    no harm; an empty table gives no rows.
    """
    edges = materialise(edges.select("a", "b").where("a <> b").distinct())
    while True:
        stars = materialise(_small_star(_large_star(edges)))
        changed = _digest(stars) != _digest(edges)
        edges = stars
        if not changed:
            break
    of = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component"))
    return of.union(of.select("component", "component").distinct())


def _digest(edges: DataFrame) -> tuple:
    pair = F.xxhash64(F.greatest("a", "b"), F.least("a", "b")).cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(pair)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    smallest = both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("of"), F.least("least", "a").alias("least")
    )
    return (
        both.join(smallest, F.col("a") == F.col("of"))
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = down.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "of")
    joined = down.join(smallest, F.col("a") == F.col("of"))
    return (
        joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .union(smallest.select("of", "least"))
        .where("a <> b")
        .distinct()
    )
