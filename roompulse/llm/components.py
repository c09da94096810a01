"""Connected components by repeated contraction, each round committed to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roompulse.llm.storage import saved

JUMPS = 2


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``label`` (the same for all nodes of a component) of every node in edges (u, v).

    In each round a node points to its least neighbour, pointers are followed ``2 ** JUMPS`` steps, and the edges are
    drawn between what the nodes point to, until none is left. Only the number of edges left reaches the driver.
    """
    edges = saved(edges.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
                  f"{name}-edges")
    rounds = []
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        points = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("root"))
        for _ in range(JUMPS):
            points = saved(points, f"{name}-points")
            further = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
            points = points.join(further, "root").select("node", F.col("next").alias("root"))
        points = saved(points, f"{name}-points")
        rounds.append(points)
        u = points.select(F.col("node").alias("u"), F.col("root").alias("a"))
        v = points.select(F.col("node").alias("v"), F.col("root").alias("b"))
        left = edges.join(u, "u").join(v, "v").where("a != b").select(
            F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        edges = saved(left, f"{name}-edges")
        if edges.isEmpty():
            break
    labels = rounds.pop().withColumnRenamed("root", "label")
    for points in reversed(rounds):
        later = labels.select(F.col("node").alias("root"), "label")
        labels = saved(points.join(later, "root", "left").select("node", F.coalesce("label", "root").alias("label")), f"{name}-labels")
    return labels
