"""Connected components of a link table by contraction, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node in ``links`` (``a``, ``b``).

    Each round, every node goes to the smallest among itself and its neighbours, chains of such steps are shortened
    once, and what is left are the links between the nodes still standing: at least half of the linked ones vanish.
    Rounds are logarithmic in the number of nodes; a node may have any number of links. Links of a node with itself
    only, and an empty table, give no rows or the node itself.
    """
    edges = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    names = None
    while True:
        both = edges.union(edges.select("b", "a").toDF("a", "b"))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("to"))
        hop = step.select(F.col("node").alias("mid"), F.col("to").alias("end"))
        step = stage(step.join(hop, F.col("to") == F.col("mid"), "left").select("node", F.least("to", "end").alias("to")), "component-step")
        if names is None:
            names = step.select("node", F.col("to").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), "to")
            names = names.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        names = stage(names, "components")
        left, right = step.select(F.col("node").alias("a"), F.col("to").alias("x")), step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = edges.join(left, "a").join(right, "b").where(F.col("x") != F.col("y"))
        edges = stage(edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if not edges.head(1):
            return names
