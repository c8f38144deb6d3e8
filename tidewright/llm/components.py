"""Connected components by contraction: no step holds a component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.scratch import landed


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for the nodes of edges ``a, b``: nodes share a label if and only if edges connect them.

    In each round every node moves to the least of itself and its neighbours, and edges within a place fall away. Ids
    should be hashes, so that the rounds needed grow with the logarithm of a component's size.
    """
    edges = landed(edges.select("a", "b").where("a <> b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = landed(nodes.select("node", F.col("node").alias("label")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        moved = both.groupBy(F.col("a").alias("old")).agg(F.min("b").alias("b")).select("old", F.least("old", "b").alias("new"))
        moved = landed(moved, "moved")
        labels = labels.join(moved, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label"))
        labels = landed(labels, "labels")
        a, b = moved.toDF("a", "na"), moved.toDF("b", "nb")
        step = edges.join(a, "a").join(b, "b").where("na <> nb")
        edges = landed(step.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct(), "edges")
    return labels
