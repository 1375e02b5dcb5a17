"""Connected components by smallest labels, entirely as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.llm.store import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; component is its smallest node.

    Each round gives a node the smallest label next to it and then the label of that label,
    so long chains shorten by powers. Labels are written to the shared folder each round;
    only the count of changed labels reaches the driver. Links with a null end are ignored;
    loops and repeated links change nothing. No links give no rows.
    """
    both = written(
        links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
        .union(links.where("a IS NOT NULL AND b IS NOT NULL").select("b", "a"))
        .distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        step = labels.join(near, "node").select(
            "node", F.col("component").alias("before"),
            F.least("component", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("component").alias("next"))
        labels = written(step.join(jump, "label", "left").select(
            "node", "before",
            F.least("label", F.coalesce("next", "label")).alias("component")), "labels")
        if labels.where("component <> before").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
