"""Connected components of a large graph, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for the nodes of ``links`` (a, b).

    Each round joins every node to its first neighbour, in turn by id and by
    hash, and contracts the links; by hash a constant share of the nodes is
    expected to go, whatever the shape. The label is the smallest node. Rounds
    are written tables, so lineage stays short and nothing is collected.
    """
    edges = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels, by_hash = nodes.withColumn("label", F.col("node")), False
    while not edges.isEmpty():
        rank = F.xxhash64 if by_hash else (lambda c: F.col(c))
        both = edges.union(edges.select("b", "a")).toDF("from", "to")
        hooks = both.groupBy("from").agg(F.min(F.struct(rank("to").alias("rank"), F.col("to"))).alias("best"))
        hooks = materialise(
            hooks.filter(F.col("best.rank") < rank("from")).select(F.col("from").alias("label"), F.col("best.to").alias("parent"))
        )
        labels = materialise(
            labels.join(hooks, "label", "left").select("node", F.coalesce("parent", "label").alias("label"))
        )
        moved = edges
        for side in ("a", "b"):
            moved = moved.join(hooks.select(F.col("label").alias(side), "parent"), side, "left").withColumn(
                side, F.coalesce("parent", side)
            ).drop("parent")
        edges = materialise(
            moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        )
        by_hash = not by_hash
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")
