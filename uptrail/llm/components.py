"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from uptrail.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node that can be reached, for every node of an edge.

    In a round every node takes the smallest label among its own and its neighbours', and then the
    label of that label. Rounds go on until none changes. Edges from a hub are split by the
    adaptive join; labels are minima, which are combined before the shuffle.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    pairs = written(pairs.union(pairs.select("y", "x")).distinct(), "component-edges")
    labels = written(pairs.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("root")), "components")
    while True:
        near = pairs.join(labels, pairs["y"] == labels["node"]).select(F.col("x").alias("node"), "root", F.lit(None).alias("was"))
        own = labels.select("node", "root", F.col("root").alias("was"))
        least = near.union(own).groupBy("node").agg(F.min("root").alias("root"), F.max("was").alias("was"))
        least = written(least, "component-least")
        jump = least.select(F.col("node").alias("at"), F.col("root").alias("to"))
        new = written(least.join(jump, least["root"] == jump["at"]).select(
            "node", F.col("to").alias("root"), (F.col("to") < F.col("was")).alias("moved")), "components")
        labels = new.drop("moved")
        if new.where("moved").isEmpty():
            return labels
