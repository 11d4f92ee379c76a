"""Connected components by alternating stars, with every round written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b) with a > b.

    The large star links every larger neighbour of a node to the least of its
    neighbourhood; the small star does so with the smaller ones. Least neighbours
    are combined before the shuffle, and the join back may be split by Spark.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    joined = both.join(least, both["a"] == least["node"])
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return moved.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """The least node of each node's component: node, component. Lone nodes have no row.

    ``edges`` has columns a and b. Rounds end when the edges stay as they are; the
    number of rounds grows with the logarithm of the longest path.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stored(edges.where("a <> b").select(high, low).distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.max("a")).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = now
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
