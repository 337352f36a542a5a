"""Connected components of a graph of edges, by Spark joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node with an edge to another; ``component`` is the smallest node of its component.

    Each round points every node at its smallest neighbour, follows those pointers twice, and contracts the edges to
    what is left between the targets. Rounds grow with the logarithm of the longest path. Minimums are partial
    aggregates and joins have one row per key on one side, so a node with very many edges is no bottleneck. Loops,
    repeated edges and nulls are ignored; no edges give no rows. Every round is written to the shared folder."""
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null and a <> b")
    current = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    maps: list[DataFrame] = []
    while not current.isEmpty():
        to = current.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        for _ in range(2):
            onward = to.select(F.col("node").alias("via"), F.col("to").alias("beyond"))
            to = to.join(onward, F.col("to") == F.col("via")).select("node", F.col("beyond").alias("to"))
        to = stored(to)
        maps.append(to)
        ends = current.join(to.withColumnRenamed("node", "a").withColumnRenamed("to", "x"), "a")
        ends = ends.join(to.withColumnRenamed("node", "b").withColumnRenamed("to", "y"), "b")
        current = stored(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())

    def follow(sofar: DataFrame, nxt: DataFrame) -> DataFrame:
        step = nxt.select(F.col("node").alias("via"), F.col("to").alias("beyond"))
        return sofar.join(step, F.col("component") == F.col("via"), "left").select("node", F.coalesce("beyond", "component").alias("component"))

    if not maps:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return reduce(follow, maps[1:], maps[0].select("node", F.col("to").alias("component")))
