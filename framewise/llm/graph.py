"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``v``, ``label`` (the least vertex reachable) for every vertex of the edges ``a``, ``b``.

    Every round takes the least label among a vertex and its neighbours and then
    follows the label's own label, until nothing changes.  Aggregation before
    the shuffle keeps a vertex with many edges from landing in one task.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "cc-edges")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "cc")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("m"))
        step = labels.join(near, "v").select("v", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        hop = labels.select(F.col("v").alias("label"), F.col("label").alias("next"))
        step = stored(step.join(hop, "label", "left").select("v", "was", F.least("label", "next").alias("label")), "cc")
        changed = step.filter("label <> was").limit(1).count()
        labels = step.select("v", "label")
        if not changed:
            return labels
