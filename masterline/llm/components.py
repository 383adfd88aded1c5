"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterline.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of edges(a, b).

    Each round hooks every node to its least neighbour, follows the hooks to their ends by doubling, and
    contracts the edges to those ends; rounds go on until no edge is left. Every step is an aggregation or
    an equi-join, written to the shared folder, and nothing but a row count reaches the driver. Edges may repeat and
    point either way; an edge from a node to itself makes it a node; null ends are not allowed (callers number
    their nodes); ties can't occur, as the least node is one; no edges give no nodes.
    """
    labels = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).withColumn("to", F.least("node", "to")), "hooks")
        while True:
            ends = hooks.select(F.col("node").alias("to"), F.col("to").alias("end"))
            jumped = stage(hooks.join(ends, "to").select("node", F.col("end").alias("to"), (F.col("end") != F.col("to")).alias("moved")), "hooks")
            hooks = jumped.select("node", "to")
            if jumped.filter("moved").limit(1).count() == 0:
                break
        if labels is None:
            labels = hooks.withColumnRenamed("to", "root")
        else:
            step = hooks.select(F.col("node").alias("root"), "to")
            labels = labels.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        on_a, on_b = (hooks.select(F.col("node").alias(c), F.col("to").alias(f"_{c}")) for c in "ab")
        moved = edges.join(on_a, "a").join(on_b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        edges = stage(moved.filter("a != b").distinct(), "edges")
        if edges.limit(1).count() == 0:
            return labels
