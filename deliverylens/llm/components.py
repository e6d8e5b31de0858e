"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .session import checkpoint


def _toward(edges: DataFrame) -> DataFrame:
    """The least neighbour of each u and how many it has, checkpointed: Spark splits the
    edges of a hub only where both sides of a join are shuffles of their own."""
    return checkpoint(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))


def _each(rows: DataFrame, *edges: Column) -> DataFrame:
    """The edges (u, v) that each row gives; null ones are left out."""
    return rows.select(F.explode(F.array(*edges)).alias("e")).where("e IS NOT NULL").select("e.u", "e.v")


def _edge(u: str, v: str) -> Column:
    return F.struct(F.col(u).alias("u"), F.col(v).alias("v"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node on an edge between two different nodes.

    ``component`` is the smallest node reachable. Nodes can be of any type that
    Spark orders. Each round is two groupings with map-side minima and joins on
    unique keys, checkpointed; the number of rounds grows with the logarithm of
    the largest component. The rounds end when each node with a smaller neighbour
    has no other: then these neighbours are the components. Nothing but a count
    reaches the driver.
    """
    x, y = F.col(a), F.col(b)
    edges = edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    edges = checkpoint(edges)
    for _ in range(max_rounds):
        both = _each(edges, _edge("u", "v"), _edge("v", "u"))
        least = _toward(both)
        if least.agg(F.count_if(F.expr("m < u AND n > 1"))).first()[0] == 0:
            return least.select(F.col("u").alias("node"), F.least("u", "m").alias("component"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = checkpoint(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = large.join(_toward(large), "u")
        edges = checkpoint(_each(small, _edge("u", "m"), F.when(F.col("v") != F.col("m"), _edge("v", "m"))).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
