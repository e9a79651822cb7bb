"""Connected components by alternating large-star and small-star.

Each step reads the edge table, takes the smallest neighbour per node with a map-side combining
aggregate and joins it back, so no neighbour list is ever collected; the join splits a hub with
very many neighbours. It ends when every node has one edge, and that to a node without one of its
own: the smallest of its component. Step results are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.session import materialize


def large_star(edges: DataFrame) -> DataFrame:
    """Connect each larger neighbour of a node to the smallest one. Edges are (a, b), a > b."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _finished(edges: DataFrame) -> bool:
    """Whether every node has one edge up and no node that is pointed at points on."""
    if not edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return False
    tops = edges.select(F.col("b").alias("a")).distinct()
    return tops.join(edges.select("a"), "a", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) rows that point every node a but the smallest of its component at that one, b."""
    held = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _finished(held):
        held = materialize(small_star(materialize(large_star(held), "large")), "small")
    return held
