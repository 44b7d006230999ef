"""Connected components of an edge list, as joins that halve the distance to the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikelens.sources import stage


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, comp`` for every node of ``a, b`` edges; ``comp`` is the smallest node that is reachable.

    Every round a node takes the least label among its neighbours, then the label of that label, which
    shortens long chains; labels are combined before the shuffle, so a node with many edges is no hot
    group. Each round is written out, which cuts the lineage. It ends when no label changes.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stage(both, "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp"))
    labels = stage(labels, "labels")
    for _ in range(rounds):
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("near"))
        pulled = labels.join(near, F.col("node") == F.col("a")).select("node", "comp", F.least("comp", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("comp").alias("far"))
        new = stage(pulled.join(jump, "to", "left").select("node", F.coalesce("far", "to").alias("comp"), F.col("comp").alias("_was")), "labels")
        labels = new.select("node", "comp")
        if new.filter("comp <> _was").isEmpty():
            return labels
    raise RuntimeError("the components did not settle; allow more rounds")
