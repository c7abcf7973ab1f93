"""Connected components of a graph given as edges, by contraction.

In each round every node hooks on to its smallest neighbour, chains of hooks are halved
until all point to their ends, and the edges are carried over to the ends. A component
shrinks to its smallest node in a number of rounds that grows with the logarithm of its
size. No step gathers a component: hooks are minima with partial aggregation, and a hot
end only ever stands on the side of a join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordlog.llm.shared import stage


def _jumped(hooks: DataFrame) -> DataFrame:
    """Hooks (node, to) with every ``to`` the end of its chain."""
    while True:
        ahead = hooks.select(F.col("node").alias("_at"), F.col("to").alias("_next"))
        joined = hooks.join(ahead, F.col("to") == F.col("_at"), "left")
        further = stage(
            joined.select(
                "node",
                F.coalesce("_next", "to").alias("to"),
                (F.col("_next").isNotNull() & (F.col("_next") != F.col("to"))).alias("moved"),
            ),
            "hooks",
        )
        moved = further.filter("moved").limit(1).count()
        hooks = further.select("node", "to")
        if not moved:
            return hooks


def components(edges: DataFrame) -> DataFrame:
    """From (a, b) to (node, label): each node that has an edge, the smallest node of its
    component. Loops and repeated edges do no harm; no edges give no rows."""
    links = stage(edges.select("a", "b").filter("a <> b"), "edges")
    labels = None
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        hooks = _jumped(stage(least.withColumn("to", F.least("node", "to")), "hooks"))
        to = hooks.select(F.col("node").alias("_node"), "to")
        if labels is None:
            labels = hooks.withColumnRenamed("to", "label")
        else:
            moved = labels.join(to, F.col("label") == F.col("_node"), "left")
            labels = moved.select("node", F.coalesce("to", "label").alias("label"))
        labels = stage(labels, "labels")
        end = lambda name: to.select(F.col("_node").alias(f"_{name}"), F.col("to").alias(f"_to_{name}"))
        carried = links.join(end("a"), F.col("a") == F.col("_a")).join(end("b"), F.col("b") == F.col("_b"))
        carried = carried.select(F.least("_to_a", "_to_b").alias("a"), F.greatest("_to_a", "_to_b").alias("b"))
        links = stage(carried.filter("a <> b").distinct(), "edges")
        if not links.limit(1).count():
            return labels
