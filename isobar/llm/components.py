"""Connected components of a graph of links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import written

_MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached, for all nodes of the links (a, b).

    Each round every node takes the smallest label among its own and its neighbours', and then the label of that label, so labels
    reach far nodes in few rounds. A node with very many links is a grouping with partial sums, not a list. Each round's
    labels are written to the shared folder. Links may repeat and point to themselves.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a <> b").distinct(), "edges")
    labels = written(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    for _ in range(_MOST_ROUNDS):
        seen = edges.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "component")
        least = labels.select("node", "component").unionByName(seen).groupBy("node").agg(F.min("component").alias("component"))
        further = least.alias("l").join(labels.alias("m"), F.col("l.component") == F.col("m.node")).select(
            F.col("l.node").alias("node"), F.least("l.component", "m.component").alias("component")
        )
        new = written(further, "labels")
        settled = new.join(labels.withColumnRenamed("component", "old"), "node").where("component <> old").isEmpty()
        labels = new
        if settled:
            return labels
    raise RuntimeError(f"components did not settle in {_MOST_ROUNDS} rounds")
