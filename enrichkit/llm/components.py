"""Connected components of an undirected edge table, smallest node as the name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v); component is its smallest node.

    Labels start as the smallest neighbour. Each round takes the smallest
    label around every node (a map-side combined minimum, so a node with very
    many edges costs one row per task) and then jumps to the label's label,
    which halves the distances. A round is one written table; the rounds end
    when none changes. Memory per task does not depend on the component size.
    """
    turned = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    both = written(edges.select(F.inline(F.array(F.struct("u", "v"), turned))).distinct(), "edges")
    labels = written(
        both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least")).select(
            "node", F.least("node", "least").alias("label")
        ),
        "labels",
    )
    while True:
        jumped = labels.alias("x").join(labels.alias("y"), F.col("x.label") == F.col("y.node")).select(
            "x.node", F.col("x.label").alias("old"), F.col("y.label").alias("label")
        )
        near = (
            both.join(labels, F.col("v") == F.col("node"))
            .groupBy(F.col("u").alias("near_of"))
            .agg(F.min("label").alias("near"))
        )
        step = written(
            jumped.join(near, F.col("node") == F.col("near_of")).select(
                "node", "old", F.least("label", "near").alias("label")
            ),
            "labels",
        )
        changed = not step.filter(F.col("old") != F.col("label")).isEmpty()
        labels = step.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
