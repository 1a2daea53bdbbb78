"""Connected components of an edge table, by smallest labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from market_engine.llm.common import drop_stored, stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, component): the smallest node that each node reaches.

    Every round takes the smallest label among the neighbours and then that label's own label, so long
    chains shrink by halves. Labels are written after each round; only the count of changed labels
    comes to the driver. A node with very many neighbours is one row of the label table, and its
    edges are summed in part before they move."""
    e = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
               .filter("a <> b").distinct(), "edges")
    table = labels = stored(e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = e.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("m"))
        moved = labels.join(near, "node").select("node", "component", F.least("component", "m").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("then"))
        new = stored(moved.join(jump, "to").select(
            "node", F.least("to", "then").alias("component"), (F.least("to", "then") < F.col("component")).alias("new")), "labels")
        drop_stored(table)
        table, labels = new, new.select("node", "component")
        if new.filter("new").isEmpty():
            drop_stored(e)
            return labels
