"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointgate.llm.text import materialise


def connected(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of ``links`` (columns a, b; any ordered type).

    Each round a node takes the smallest label around it and then the label of that label, so chains shrink by
    halves; each round is written to the shared folder, which cuts the lineage.  Stars settle in two rounds.
    """
    both = materialise(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = materialise(
        both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("component")
        ),
        "labels",
    )
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("near")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        nearest = labels.join(around, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        jump = nearest.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = materialise(
            nearest.join(jump, "component", "left").select(
                "node", "old", F.least("component", F.coalesce("further", "component")).alias("component")
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.where("component != old").isEmpty():
            return labels
