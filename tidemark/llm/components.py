"""Connected components of links, by least labels and pointer jumping on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; a component is named by its least node.

    Each round gives a node the least label among its neighbours' and then that label's own label, so chains
    shorten by half and more per round. Nothing but a count of changes reaches the driver.
    """
    both = links.select("a", "b").unionByName(links.selectExpr("b as a", "a as b"))
    edges = stored(both.distinct(), "edges")
    near = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    labels = stored(near.select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        of = labels.select(F.col("node").alias("of"), F.col("component").alias("label"))
        around = edges.join(of, F.col("b") == F.col("of")).groupBy("a").agg(F.min("label").alias("least"))
        lower = labels.join(around, F.col("node") == F.col("a")).select("node", F.col("component").alias("was"), F.least("component", "least").alias("now"))
        jumped = lower.join(of, F.col("now") == F.col("of")).select("node", "was", F.least("now", "label").alias("component"))
        step = stored(jumped, "labels")
        if step.filter("was <> component").isEmpty():
            return step.select("node", "component")
        labels = step.select("node", "component")
