"""Connected components of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is the
    smallest node reachable.

    Each round takes the smallest label among the neighbours (a partial
    aggregate, so a hub costs one row a task) and then the label of the label,
    which halves the depth. Every round is stored, so a lost executor repeats
    one round at most. Links to itself and repeated links change nothing;
    links with a null end are left out; no links give no rows.
    """
    pairs = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other")
    edges = stored(pairs.union(pairs.select(F.col("other"), F.col("node"))).distinct(), "cc-edges")
    labels = stored(edges.groupBy("node").agg(F.min("other").alias("low"))
                    .select("node", F.least("node", "low").alias("component")), "cc-labels")
    while True:
        low = (edges.join(labels.withColumnRenamed("node", "other"), "other")
               .groupBy("node").agg(F.min("component").alias("low")))
        step = (labels.join(low, "node")
                .select("node", F.col("component").alias("was"), F.least("component", "low").alias("now")))
        jump = step.select(F.col("node").alias("now"), F.col("now").alias("component"))
        step = stored(step.join(jump, "now").select("node", "was", "component"), "cc-labels")
        labels = step.select("node", "component")
        if step.where("was <> component").isEmpty():
            return labels
