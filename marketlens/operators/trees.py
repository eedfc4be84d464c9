"""Regression trees by variance reduction, grown level by level (P-12).

The best split of a node over a feature is where the weighted variance of the two sides is least. The rows are
reduced to cells (node, feature, value) with count and sums; sums up to each value, over ranges of the sorted
cells, give every split of every feature and node of a level in one pass. Sums are decimals, so the result doesn't
depend on how rows are partitioned. Only the chosen splits, at most two to the depth, come to the driver.

A row goes left where its value is at most the threshold, a null goes right. Of equal splits the earlier
feature and the smaller value wins. Nodes of fewer than ``min_rows`` rows, and those that no split improves, are leaves.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.running import running_sums
from marketlens.session import cut_lineage

#: Digits after the point that sums of the target keep.
SCALE = 6


def _cells(df: DataFrame, features: Sequence[str], target: str, node: str) -> DataFrame:
    """(node, feature, value, n, s): rows and sum of the target for each value; the feature by its place."""
    y = F.col(target).cast(f"decimal(24,{SCALE})")
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f).cast("double").alias("value")) for i, f in enumerate(features)]))
    return (df.select(F.col(node).alias("node"), y.alias("_y"), each.alias("_c")).where("_y IS NOT NULL")
            .groupBy("node", F.col("_c.feature").alias("feature"), F.col("_c.value").alias("value"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s")))


def split_candidates(df: DataFrame, features: Sequence[str], target: str, node: str) -> DataFrame:
    """Every split with rows on both sides: (node, feature, threshold, reduction, n, mean, n_left, mean_left, n_right,
    mean_right)."""
    cells = cut_lineage(_cells(df, features, target, node))
    total = cells.where("feature = 0").groupBy("node").agg(F.sum("n").alias("n_all"), F.sum("s").alias("s_all"))
    run = running_sums(cells.where("value IS NOT NULL AND NOT isnan(value)"), ["node", "feature"], ["value"], {"n_left": "n", "s_left": "s"})
    both = run.join(F.broadcast(total), "node").where("n_left < n_all")                  # a row for each node of the level
    n, left, right = F.col("n_all"), F.col("n_left"), F.col("n_all") - F.col("n_left")
    mean_left = F.col("s_left").cast("double") / left
    mean_right = (F.col("s_all") - F.col("s_left")).cast("double") / right
    share = (left / n) * (right / n)
    return both.select("node", "feature", F.col("value").alias("threshold"), (share * (mean_left - mean_right) * (mean_left - mean_right)).alias("reduction"),
                       n.alias("n"), (F.col("s_all").cast("double") / n).alias("mean"), left.alias("n_left"), mean_left.alias("mean_left"),
                       right.alias("n_right"), mean_right.alias("mean_right"))


def best_splits(candidates: DataFrame, *by: str) -> DataFrame:
    """The best candidate for each value of ``by``."""
    first = F.struct("reduction", -F.col("feature"), -F.col("threshold"))
    rest = [c for c in candidates.columns if c not in by]
    return candidates.groupBy(*by).agg(F.max_by(F.struct(*rest), first).alias("_b")).select(*by, "_b.*")


@dataclasses.dataclass(frozen=True)
class Node:
    """A node: children are 2 i and 2 i + 1; a leaf has no feature."""

    id: int
    n: int
    mean: float
    feature: str | None = None
    threshold: float | None = None
    reduction: float | None = None


def _place(tree: dict[int, Node], at: int = 1, leaf=lambda node: F.lit(node.id)) -> Column:
    node = tree[at]
    if node.feature is None:
        return leaf(node)
    left = F.coalesce(F.col(node.feature).cast("double") <= F.lit(node.threshold), F.lit(False))
    left = left & ~F.isnan(F.col(node.feature).cast("double"))
    return F.when(left, _place(tree, 2 * at, leaf)).otherwise(_place(tree, 2 * at + 1, leaf))


def predict_tree(tree: dict[int, Node]) -> Column:
    """The leaf's mean, as one expression; at most two to the depth leaves."""
    return _place(tree, leaf=lambda node: F.lit(float(node.mean)))


def variance_tree(df: DataFrame, features: Sequence[str], target: str, depth: int = 4, min_rows: int = 2) -> dict[int, Node]:
    """The tree's nodes by number (root 1); empty for a frame without a target. The root is at depth 0 and nodes as deep as
    ``depth`` may still split, as long as they have ``min_rows`` rows."""
    rows = cut_lineage(df.select(*dict.fromkeys([*features, target])).where(F.col(target).isNotNull()))
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast(f"decimal(24,{SCALE})")).alias("s")).first()
    if not whole["n"]:
        return {}
    tree = {1: Node(1, whole["n"], float(whole["s"]) / whole["n"])}
    open_nodes = [1]
    for _ in range(depth + 1):
        open_nodes = [i for i in open_nodes if tree[i].n >= min_rows]
        if not open_nodes:
            break
        placed = rows.withColumn("_node", _place(tree)).where(F.col("_node").isin(open_nodes))
        found = best_splits(split_candidates(placed, features, target, "_node"), "node").where("reduction > 0").collect()
        open_nodes = []
        for b in found:
            i = b["node"]
            tree[i] = dataclasses.replace(tree[i], feature=features[b["feature"]], threshold=b["threshold"], reduction=b["reduction"])
            tree[2 * i], tree[2 * i + 1] = Node(2 * i, b["n_left"], b["mean_left"]), Node(2 * i + 1, b["n_right"], b["mean_right"])
            open_nodes += [2 * i, 2 * i + 1]
    return tree


def tree_frame(spark, tree: dict[int, Node]) -> DataFrame:
    """The nodes as rows."""
    return spark.createDataFrame([dataclasses.astuple(tree[i]) for i in sorted(tree)],
                                 "node bigint, n bigint, mean double, feature string, threshold double, reduction double")
