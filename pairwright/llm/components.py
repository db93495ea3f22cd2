"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.llm.frames import landed


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, its component's least node, for every node of ``edges`` (``a``, ``b``).

    Labels spread along edges, then each node takes its label's label, until
    nothing changes.  Each round is written to the shared folder; only the
    number of changes reaches the driver.
    """
    edges = landed(edges.select("a", "b").distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = landed(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jumped = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = landed(
            spread.join(jumped, "label", "left").select(
                "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")
            ),
            "labels",
        )
        labels = new.select("node", "label")
        if new.where(F.col("old") != F.col("label")).isEmpty():
            return labels
