"""Connected components of links, by large-star and small-star steps.

Links stay in Spark: each step is a minimum per node, which combines in the map
tasks, and a join with it. Every round is written to the shared folder. Inputs
come from ``forest``, which keeps per task only the links of a spanning forest,
so that a group of copies does not arrive as all its pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tabfold.llm.common import settle


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest reachable node of 0..n-1 for each node, over the given links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        # Hang the roots of both ends below the smaller one, then shorten the paths.
        np.minimum.at(root, before[left], low)
        np.minimum.at(root, before[right], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            return root


def _star(links: DataFrame, small: bool) -> DataFrame:
    """One step over links (a, b) with a > b.

    Small star: a node's smaller neighbours go to the smallest of them. Large
    star: a node's larger neighbours go to the smallest neighbour, or itself.
    """
    if small:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        kept = least.select("a", F.col("m").alias("b"))
        moved = links.join(least, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return kept.unionByName(moved)
    # A node that has no smaller neighbour leaves its larger ones as they are.
    least = links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
    return links.join(least, "b", "left").select("a", F.least("b", "m").alias("b")).unionByName(
        least.select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of links (a, b): the smallest node it reaches.

    Links are read in either direction; loops and repeats do no harm. Nodes
    without a link do not occur. No links give no rows.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = settle(ordered.where(F.col("a") != F.col("b")).distinct(), "links")
    while True:
        step = settle(_star(_star(current, small=False), small=True).distinct(), "links")
        # Done when every link leads from a node straight to one that has no smaller link.
        loose = step.join(step.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count()
        several = step.groupBy("a").count().where("count > 1").limit(1).count()
        if not loose and not several:
            break
        current = step
    roots = step.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return step.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
