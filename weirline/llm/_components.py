"""Connected components of an edge table by repeated hooking and contraction; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize, release


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another; root is the smallest node of its component.

    Each round, a node hooks to its smallest neighbour, pointers are doubled twice, and the edges are
    contracted to the roots reached; the nodes left shrink by a factor of at least two. Rounds end when no
    edge is left. Each round's tables are written, so no plan grows.
    """
    left = materialize(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct(), "edges")
    labels = None
    while left.limit(1).count():
        near = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialize(near.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("to")), "hook")
        for _ in range(2):
            far = materialize(hook.alias("h").join(hook.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").select("node", F.col("next").alias("to")), "hook")
            release(hook)
            hook = far
        to = lambda side: hook.select(F.col("node").alias(side), F.col("to").alias(f"{side}_to"))
        contracted = left.join(to("a"), "a").select("b", "a_to").join(to("b"), "b").select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).filter("a < b").distinct()
        following = materialize(contracted, "edges")
        if labels is None:
            labels = hook.select("node", F.col("to").alias("root"))
        else:
            labels = materialize(labels.join(hook.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")
        release(left)
        left = following
    return labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("root"))
