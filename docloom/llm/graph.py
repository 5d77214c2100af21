"""Connected components of a table of links, with joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import Workspace


def components(work: Workspace, links: DataFrame, name: str) -> DataFrame:
    """node, label (the smallest node reachable) of every node in `links` (u, v).

    Each round maps every node to its smallest neighbour and carries the links over to the images; nodes that the images
    of all their links share drop out. The rounds grow with the logarithm of the longest path. Every round is a written
    table; hubs meet only in joins, which Spark can split.
    """
    edges = work.write(links.select("u", "v").filter("u <> v").distinct(), f"{name}-edges-0")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        k = len(rounds)
        ends = edges.select(F.col("u").alias("node"), F.col("v").alias("other")).unionByName(edges.select(F.col("v").alias("node"), F.col("u").alias("other")))
        up = ends.groupBy("node").agg(F.min("other").alias("up")).select("node", F.least("node", "up").alias("up"))
        rounds.append(work.write(up, f"{name}-up-{k}"))
        left = rounds[k].select(F.col("node").alias("u"), F.col("up").alias("u2"))
        right = rounds[k].select(F.col("node").alias("v"), F.col("up").alias("v2"))
        moved = edges.join(left, "u").join(right, "v").select(F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v"))
        edges = work.write(moved.filter("u <> v").distinct(), f"{name}-edges-{k + 1}")
        work.drop(f"{name}-edges-{k}")
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    label = rounds[0].withColumnRenamed("up", "label")
    for up in rounds[1:]:
        label = label.join(up.select(F.col("node").alias("label"), "up"), "label", "left").select("node", F.coalesce("up", "label").alias("label"))
    return work.write(label, f"{name}-labels")
