"""Connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraproof.llm.common import cut


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its smallest node.

    Each round passes the smallest known label over every edge (combined before the shuffle) and then follows
    labels of labels, so that the rounds grow with the logarithm of a chain's length, not with its length. State
    is cut in the shared checkpoint folder each round; nothing but one flag comes to the driver.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter(F.col("a") != F.col("b")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    for _ in range(max_rounds):
        told = both.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("heard"))
        heard = labels.join(told, "node").select("node", "label", F.least("label", "heard").alias("next"))
        heads = labels.select(F.col("node").alias("head"), F.col("label").alias("farther"))
        jumped = heard.join(heads, F.col("next") == F.col("head")).select("node", F.least("next", "farther").alias("label"), (F.least("next", "farther") != F.col("label")).alias("moved"))
        state = cut(jumped)
        labels = state.select("node", "label")
        if state.filter("moved").isEmpty():
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"labels still move after {max_rounds} rounds")
