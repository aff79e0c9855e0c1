"""Connected components of an edge table: smallest reachable id of every vertex."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subspan.llm.tables import stored


def components(edges: DataFrame, under: str) -> DataFrame:
    """``id``, ``component`` of every vertex of ``edges`` (columns a, b); tables go below the folder ``under``.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    the number of rounds grows with the logarithm of the longest path. A round is written to the shared folder;
    vertices with many edges are reduced in the map tasks or split by the skew join.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges", under)
    labels = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).select(F.col("a").alias("id"), "label"), "labels", under)
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        stepped = stored(
            labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label")), "steps", under
        )
        roots = stepped.select(F.col("id").alias("label"), F.col("label").alias("root"))
        after = stored(stepped.join(roots, "label").select("id", "old", F.col("root").alias("label")), "labels", under)
        labels = after.select("id", "label")
        if after.where("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
