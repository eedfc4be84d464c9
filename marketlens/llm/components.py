"""Connected components of a list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every linked node and the root of its component.

    Rounds of hooking and contraction: each node hooks to its smallest neighbour, chains of hooks are shortened, the
    links are moved to the hooked-to nodes and those within one node drop out. Every round at least halves the nodes
    that still have links. Minimums are taken in the tasks first, so a node with most of the links is one row for each
    task; no neighbourhood is ever gathered.
    """
    edges = cut_lineage(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct())
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("root")))
        while True:                                          # a hook leads to a smaller node, so chains end
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = cut_lineage(hook.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("next"), "root"))
            moved = not jumped.where("next != root").isEmpty()
            hook = jumped.select("node", F.col("next").alias("root"))
            if not moved:
                break
        at = lambda c: hook.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
        edges = cut_lineage(edges.join(at("a"), "a").join(at("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).where(
            "a != b").distinct())
        if roots is None:
            roots = hook
        else:
            above = hook.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = cut_lineage(roots.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
