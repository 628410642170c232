"""Connected components of a link table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stage


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); root is the component's smallest node.

    Each round takes the smallest root among neighbours (a partial aggregate, so a
    node with very many links is no burden) and then jumps to that root's own root,
    which makes the rounds logarithmic even along chains. Each round's table is
    written to the shared folder.
    """
    both = stage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    at = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), "roots")
    for _ in range(max_rounds):
        near = both.join(at, both["b"] == at["node"]).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m"))
        step = at.withColumnRenamed("root", "was").join(near, "node").select("node", "was", F.least("was", "m").alias("root"))
        up = at.select(F.col("node").alias("root"), F.col("root").alias("top"))
        now = stage(step.join(up, "root", "left").select("node", "was", F.least("root", F.coalesce("top", "root")).alias("root")), "roots")
        at = now.select("node", "root")
        if now.where("was != root").isEmpty():
            return at
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
