"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of ``links`` (a, b).

    Each round gives a node the least label among itself and its neighbours, then
    follows labels one step (pointer jumping), so long chains shrink fast; it ends when
    nothing changes.  Each round is written to the shared folder, nothing is collected.
    Null ends are ignored; an empty table gives an empty result."""
    pairs = links.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    both = materialise(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                       "links")
    labels = materialise(both.groupBy("a").agg(F.min("b").alias("low"))
                         .select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    for _ in range(max_rounds):
        seen = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        met = labels.join(seen, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        step = met.join(jump, "new", "left").select("node", F.least("new", "far").alias("new"),
                                                    "label")
        step = materialise(step.select("node", F.col("new").alias("label"),
                                       (F.col("new") < F.col("label")).alias("moved")), "labels")
        labels = step.select("node", "label")
        if step.where("moved").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
