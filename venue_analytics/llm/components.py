"""Connected components of an edge table, by least labels and pointer jumping; every round is stored, nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v): label is the least node it is connected to.

    An empty edge table gives an empty frame. Each round takes the least label among neighbours (combined
    map-side, so a node with very many neighbours is no hot task) and then the label's own label.
    """
    both = stored(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct(), "cc-edges")
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label")), "cc-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        taken = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        parents = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = stored(taken.join(parents, "label").select("node", "old", F.least("label", "up").alias("label")), "cc-labels")
        changed = jumped.where("old <> label").isEmpty()
        labels = jumped.select("node", "label")
        if changed:
            return labels
