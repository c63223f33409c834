"""Connected components of an edge table, by repeated contraction; every round is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lensmill.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root): nodes with an edge, root being one node of the component.

    A round points every node at the smallest of itself and its neighbours, follows the pointer once more, and replaces
    the ends of each edge by where they point; edges within a point go. Minima are aggregated before the shuffle, so a
    node with many neighbours costs one row per task. Nodes left after a round are at most half of those before it.
    """
    e = materialize(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels: DataFrame | None = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("to"))
        near = materialize(near, "near")
        jump = near.select(F.col("node").alias("to"), F.col("to").alias("root"))
        points = materialize(near.join(jump, "to").select("node", "root"), "points")
        pa = points.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        pb = points.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        e = e.join(pa, "a").join(pb, "b").filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        e = materialize(e, "edges")
        if labels is None:
            labels = points
        else:
            step = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = materialize(labels.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
    if labels is None:
        labels = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
