"""Embedding near-duplicates by int8 tile products with exact error bounds.

Equal vectors of a label are one class, so copies shrink to a row. The classes of
a label are dealt into tiles; a task multiplies two tiles in int8, and per vector
it knows how far its quantised form is from it, so the error of every product has
a bound. Pairs whose product plus bound stays below the threshold are done; only
the others are multiplied in double precision. A task returns a count of links
per vector and a spanning forest, never the pairs.

Defined results: a vector that is null, zero, or holds null or non-finite
components, or whose label is null, is linked with nothing and is its own
component. Vectors of different length are never linked. Repeated rows are equal
vectors and linked. A null id is never the smallest of a component; a component
of null ids has a null one. An empty table gives an empty result. Columns beyond
those named do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tabfold.llm.common import settle
from tabfold.llm.components import components, forest
from tabfold.llm.tiles import TILE, pairs_of_tiles, tile_of

THRESHOLD = 0.98
# Rows of a tile multiplied at a time.
BLOCK = 512
# Products of up to this many int8 components are exact as float32 sums.
EXACT_FLOAT32 = (1 << 24) // (127 * 127)
# Room for rounding in the bound itself, far above that of double sums.
SLACK = 1e-9


def usable(vector: Column, label: Column) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


class Quantised:
    """Unit vectors in double and int8 precision, with the norms the bound needs."""

    def __init__(self, vectors: np.ndarray):
        # Scaled first, so that squares neither overflow nor vanish.
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        self.unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
        self.step = np.abs(self.unit).max(axis=1) / 127.0
        self.codes = np.rint(self.unit / self.step[:, None]).astype(np.int8)
        near = self.codes * self.step[:, None]
        self.norm = np.linalg.norm(near, axis=1)
        self.error = np.linalg.norm(self.unit - near, axis=1)

    def factor(self) -> np.ndarray:
        exact = np.float32 if self.codes.shape[1] <= EXACT_FLOAT32 else np.float64
        return self.codes.astype(exact)


def possible(a: Quantised, rows: slice, b: Quantised, threshold: float) -> np.ndarray:
    """Pairs whose cosine may reach the threshold; every other pair is surely below it."""
    product = (a.factor()[rows] @ b.factor().T) * np.multiply.outer(a.step[rows], b.step)
    bound = np.multiply.outer(a.norm[rows], b.error) + np.multiply.outer(a.error[rows], b.norm + b.error)
    return product + bound >= threshold - SLACK


def _compare(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, sizes = pdf["node"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        vectors = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        is_left = pdf["is_left"].to_numpy(bool)
        left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        itself = not len(right)
        right = left if itself else right
        a = Quantised(vectors[left])
        b = a if itself else Quantised(vectors[right])
        links, found = np.zeros(len(nodes), np.int64), [(np.zeros(0, np.int64),) * 2]
        for at in range(0, len(left), BLOCK):
            maybe = possible(a, slice(at, at + BLOCK), b, threshold)
            i, j = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
            if not len(i):
                continue
            near = (a.unit[at + i] @ b.unit[j].T >= threshold) & maybe[np.ix_(i, j)]
            near &= left[at + i][:, None] != right[j][None, :]
            links[left[at + i]] += near @ sizes[right[j]]
            if not itself:
                links[right[j]] += sizes[left[at + i]] @ near
            p, q = near.nonzero()
            found.append((left[at + i][p], right[j][q]))
        root = forest(len(nodes), *map(np.concatenate, zip(*found)))
        linked = links > 0
        return pd.DataFrame({"node": nodes[linked], "links": links[linked], "root": nodes[root[linked]]})

    return run


def near_duplicates(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    tile: int = TILE,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    named = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").alias("label")
    ).withColumn("usable", usable(F.col("vector"), F.col("label")))
    usable_rows = named.where("usable")
    classes = (
        usable_rows.groupBy("label", "vector")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = settle(classes, "classes")
    sized = classes.withColumn("size", F.size("vector"))
    # Only groups of more than a tile are listed, so their number is the rows' over TILE.
    large = sized.groupBy("label", "size").agg(F.ceil(F.count("*") / float(tile)).cast("int").alias("tiles")).where("tiles > 1")
    dealt = sized.join(F.broadcast(large), ["label", "size"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    tasks = pairs_of_tiles(dealt, tile_of(F.col("node"), F.col("tiles")), F.lit(0), F.col("tiles") - 1)
    links = tasks.select("label", "size", "low", "high", "is_left", "node", "n", "vector")
    links = links.groupBy("label", "size", "low", "high").applyInPandas(_compare(threshold), "node long, links long, root long")
    links = settle(links, "links")
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    rooted = (
        classes.select("label", "vector", "least", "n", "node")
        .join(counted, "node", "left")
        .join(reached.withColumnRenamed("root", "reached"), "node", "left")
        .withColumn("root", F.coalesce("reached", "node"))
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(least, "root").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    joined = usable_rows.join(found, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = named.where(~F.col("usable")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
