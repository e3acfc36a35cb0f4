"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch


def state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for all ends of edges (a, b): root is the least node that links reach, itself included.

    Each round points every larger neighbour of a node at the least node beside it, then each node at the least
    of its smaller ones, until nothing changes; rounds grow with the logarithm of the longest chain. Only minima
    are gathered by node, never its neighbours; each round is written to the shared folder and the one before it
    dropped. Loops and repeated edges do no harm; no edges give no rows.
    """
    scratch, turn = Scratch(edges.sparkSession, "components"), 0
    edges = scratch.table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "0")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        edges = scratch.table(small.select("x.*").where("a <> b").distinct(), str(turn + 1))
        scratch.drop(str(turn))
        turn += 1
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
