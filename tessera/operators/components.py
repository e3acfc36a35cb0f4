"""Clusters of polygons that share tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Saved


def state_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def to_least(links: DataFrame, around: DataFrame) -> DataFrame:
    """links (a, b) with the least node `m` among a's neighbours in `around` (a, b) and a itself."""
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(least, "a").withColumn("m", F.least("a", "m"))


def clusters(members: DataFrame, node: str, *shared: str) -> DataFrame:
    """(node, cluster): cluster is the least node that chains of shared keys reach.

    members has a row for each node and key (columns `shared`; a null is a value like others). A key stands for the least
    node that has it, and a node's keys are linked to the least of these: links are as many as pairs of keys that nodes
    have in common, however many nodes that are. Then rounds of two steps: each node's larger neighbours are hung on its
    least one, and each node with its smaller neighbours on the least of these, until nothing changes. A chain halves in
    each round, so rounds grow with the logarithm of the longest one. Minima alone are gathered by node, never its neighbours.
    """
    saved, turn = Saved(members.sparkSession, "clusters"), 0
    key = F.struct(F.xxhash64(*shared).alias("x"), F.xxhash64(F.lit(1), *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in shared]).alias("y"))
    keyed = saved.table(members.select(F.col(node).alias("_node"), *shared), "members").select(F.col("_node").alias("a"), key.alias("key"))
    hubs = saved.table(keyed.groupBy("key").agg(F.min("a").alias("b"), (F.min("a") < F.max("a")).alias("met")), "hubs")
    hung = keyed.join(hubs, "key").select("a", "b", "met")
    homes = saved.table(hung.groupBy("a").agg(F.min("b").alias("home")), "homes")
    linked = hung.where("met").join(homes, "a").where("b <> home")
    links = saved.table(linked.select(F.col("b").alias("a"), F.col("home").alias("b")).distinct(), "0")
    before = state_of(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = to_least(both.where("b > a"), both).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        hung = to_least(large, large).select("a", "m", "b")
        small = hung.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        links = saved.table(small.where("a <> b").distinct(), str(turn + 1))
        saved.drop(str(turn))
        turn, after = turn + 1, state_of(links)
        if after == before:
            break
        before = after
    labels = links.groupBy("a").agg(F.min("b").alias("cluster")).withColumnRenamed("a", "home")
    return homes.join(labels, "home", "left").select(F.col("a").alias(node), F.coalesce("cluster", "home").alias("cluster"))


def largest_first(clustered: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, members), the largest first, of equally large ones that with the least label."""
    return clustered.groupBy(cluster).agg(F.count("*").alias("members")).orderBy(F.desc("members"), cluster)


def cluster_bounds(boxes: DataFrame, cluster: str = "cluster") -> DataFrame:
    """The bounds (x0, y0, x1, y1) of all boxes of each cluster, and their number."""
    low, high = (lambda c: F.min(c).alias(c)), (lambda c: F.max(c).alias(c))
    return boxes.groupBy(cluster).agg(low("x0"), low("y0"), high("x1"), high("y1"), F.count("*").alias("n"))
