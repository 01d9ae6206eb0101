"""Connected components of an edge table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``, whole numbers).

    The component is its smallest node. Alternating stars: each node's larger
    neighbours, then its smaller ones, are tied to the least node it sees, until the
    edges are stars around their components' least nodes. The rounds grow with the
    logarithm of the component size. Edges with a null end and loops are ignored;
    repeated edges count once. A hub is a key with many rows on one side of a join,
    which adaptive execution splits, and aggregates are combined before the shuffle.
    Edges between rounds and the result are stored, so that Spark knows their size and
    broadcasts them only while they are small.
    """
    edges = (
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = stored(edges)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least.select("a", F.least("a", "m").alias("m")), "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        edges = stored(small.select("e.a", "e.b").where("a != b").distinct())
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stored(leaves.unionByName(roots))


def _stars(edges: DataFrame) -> bool:
    """Whether every node that has a smaller neighbour has one only and no larger ones."""
    up = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = up.unionByName(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.agg(F.max(F.expr("up > 1 or (up = 1 and down = 1)"))).first()[0]
