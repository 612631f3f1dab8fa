"""Connected components by smallest-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breezemart.llm.shared import staged


def components(edges: DataFrame, name: str = "components", folder: str | None = None) -> DataFrame:
    """node, component (its smallest reachable node) for the ends of `edges` (a, b: long).

    Each round gives a node the smallest label among its neighbours, then the label of that label,
    so long chains shorten by halves. Every round is written: no lineage grows, and joins start from
    files, where a hub's key is cut by adaptive execution; `folder` is as for `staged`.
    """
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges", folder)
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")), f"{name}-0", folder)
    step = 0
    while True:
        step += 1
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a")
                .agg(F.min("component").alias("_near")))
        drawn = staged(labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("_old"),
            F.least("component", "_near").alias("_next")), f"{name}-{step}-near", folder)
        onward = drawn.select(F.col("node").alias("_at"), F.col("_next").alias("_far"))
        jumped = staged(drawn.join(onward, F.col("_next") == F.col("_at")).select(
            "node", F.least("_next", "_far").alias("component"), "_old"), f"{name}-{step}", folder)
        if jumped.where(F.col("component") != F.col("_old")).isEmpty():
            return jumped.select("node", "component")
        labels = jumped.select("node", "component")
