"""Exact search for the largest inner products: ball trees by branch and bound.

Rows are dealt into shards of bounded size by a hash; a task builds a ball tree of
its shard, each ball with its centre and radius. The inner product of a query with
any row of a ball is at most that with the centre plus the query's norm times the
radius. A query visits balls by falling bound and stops at the first one whose
bound is below the k-th best score it has. Every query is first searched in the
shard that holds it; the k-th score found there goes with it to all others.

Components are scaled and floored to whole numbers, so scores are exact.

Defined results: a vector that is null or holds null or non-finite components takes
no part; an empty one has score 0 with other empty ones. Only vectors of equal
length meet. A query's own row is left out, other rows with its id are not; equal
scores go to the smaller id, a null id comes last, and repeated rows count each.
With fewer candidates than k, all are returned. An empty table gives an empty
result. Columns beyond those named do not matter. Scores have to fit a long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabfold.llm.common import settle

SCALE = 256
SHARD, BLOCK, LEAF = 16_384, 32_768, 256
# Stands for a null id while ids are compared.
NO_ID = (1 << 63) - 1
# Sums of products below this are exact in double precision.
EXACT = float(1 << 53)

FOUND = "query_row long, query_id long, score long, vec_id long"


def whole(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound, F.lit(False))


class BallTree:
    """Balls of at most ``leaf`` rows, from splits at the middle of the widest direction."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points.astype(np.float64)
        # Nodes in the order of their making: children follow their parent.
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        self._grow(np.arange(len(points)), leaf)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        held = self.points[rows]
        centre = held.mean(axis=0)
        distance = np.linalg.norm(held - centre, axis=1)
        node = len(self.centre)
        self.centre.append(centre)
        self.radius.append(float(distance.max()))
        self.children.append(None)
        self.rows.append(rows)
        if len(rows) > leaf and self.radius[node] > 0:
            # From the row farthest out to the one farthest from it.
            one = held[np.argmax(distance)]
            other = held[np.argmax(np.linalg.norm(held - one, axis=1))]
            order = np.argsort(held @ (other - one), kind="stable")
            half = len(rows) // 2
            left = self._grow(rows[order[:half]], leaf)
            self.children[node] = (left, self._grow(rows[order[half:]], leaf))
        return node

    def bounds(self, queries: np.ndarray, nodes: list[int]) -> np.ndarray:
        """At least the inner product of each query with any row of each node."""
        centres = np.stack([self.centre[n] for n in nodes])
        radii = np.array([self.radius[n] for n in nodes])
        norms = np.linalg.norm(queries, axis=1)
        bound = queries @ centres.T + np.multiply.outer(norms, radii)
        # Room for rounding.
        return bound + 1e-9 * (1.0 + np.multiply.outer(norms, np.linalg.norm(centres, axis=1) + radii))

    def leaves(self, queries: np.ndarray, floor: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Leaves that some query may need, from the root down, with all queries' bounds."""
        level, found = [0], []
        while level:
            bounds = self.bounds(queries, level)
            level = [n for n, b in zip(level, bounds.T) if (b >= floor).any()]
            found += [n for n in level if self.children[n] is None]
            level = [c for n in level if self.children[n] for c in self.children[n]]
        return found, self.bounds(queries, found) if found else np.zeros((len(queries), 0))


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.query, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.n = n

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = (np.concatenate(p) for p in ((self.query, query), (self.score, score), (self.ids, ids)))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        last = place == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])
        self.query, self.score, self.ids = query[keep], score[keep], ids[keep]


def search(points: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
    """Positions of queries, scores and ids: the k best of each query that reach its floor."""
    tree = BallTree(points)
    best = Best(len(queries), k, floor.astype(np.float64).copy())
    small = np.abs(points).max(initial=0) * float(np.abs(queries).max(initial=0)) * max(1, points.shape[1]) < EXACT
    kind = np.float64 if small else np.int64
    points, exact = points.astype(kind), queries.astype(kind)
    leaves, bounds = tree.leaves(queries.astype(np.float64), best.floor)
    order = np.argsort(-bounds, axis=1, kind="stable")
    for turn in range(len(leaves)):
        leaf = order[:, turn]
        open_ = np.flatnonzero(bounds[np.arange(len(queries)), leaf] >= best.floor)
        if not len(open_):
            break
        for at in np.unique(leaf[open_]):
            some = open_[leaf[open_] == at]
            members = tree.rows[leaves[at]]
            score = exact[some] @ points[members].T
            i, j = (score >= best.floor[some][:, None]).nonzero()
            other = own[some[i]] != rows[members[j]]
            i, j = i[other], j[other]
            if len(i):
                best.add(some[i], score[i, j].astype(np.int64), ids[members[j]])
    return best.query, best.score, best.ids


def _arrays(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["codes"].to_numpy()).astype(np.int64).reshape(len(pdf), -1)


def _found(queries: pd.DataFrame, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "query_row": queries["row"].to_numpy()[query],
            "query_id": queries["vec_id"].to_numpy()[query],
            "score": score,
            "vec_id": ids,
        }
    )


def _search_home(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        queries = pdf[pdf["is_query"]]
        codes, asked = _arrays(pdf), np.flatnonzero(pdf["is_query"].to_numpy())
        if not len(asked):
            return _found(queries, *[np.zeros(0, np.int64)] * 3)
        floor = np.full(len(asked), -np.inf)
        rows = pdf["row"].to_numpy()
        return _found(queries, *search(codes, pdf["vec_id"].to_numpy(), rows, codes[asked], rows[asked], floor, k))

    return run


def _search_block(k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if candidates.empty or queries.empty:
            return _found(queries, *[np.zeros(0, np.int64)] * 3)
        floor = queries["floor"].astype("float64").fillna(-np.inf).to_numpy()
        found = search(
            _arrays(candidates), candidates["vec_id"].to_numpy(), candidates["row"].to_numpy(),
            _arrays(queries), queries["row"].to_numpy(), floor, k,
        )
        return _found(queries, *found)

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) for every row that ``is_query`` picks."""
    named = vectors.select(
        F.coalesce(F.col(f"`{vec_id}`"), F.lit(NO_ID)).alias("vec_id"),
        F.col(f"`{vector}`").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    coded = named.where(usable(F.col("vector"))).select("vec_id", "is_query", whole(F.col("vector"), scale).alias("codes"))
    coded = settle(coded.withColumn("row", F.monotonically_increasing_id()).withColumn("size", F.size("codes")), "codes")
    n = coded.agg(F.count("*").alias("rows"), F.count_if("is_query").alias("queries")).first()
    shards, blocks = -(-n["rows"] // shard) or 1, -(-n["queries"] // block) or 1
    home = coded.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    first = settle(home.groupBy("size", "shard").applyInPandas(_search_home(k), FOUND), "found")
    if shards == 1:
        found = first
    else:
        floors = (
            first.groupBy("query_row").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == k)
        )
        part = F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)).cast("int")
        others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("shard"))
        queries = (
            home.where("is_query")
            .join(floors.select(F.col("query_row").alias("row"), "floor"), "row", "left")
            .select("size", part.alias("block"), F.explode(others).alias("shard"), "row", "vec_id", "codes", "floor")
        )
        candidates = home.select(
            "size", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "row", "vec_id", "codes"
        )
        keys = ("size", "shard", "block")
        # Names of its own for either side, which come from one table.
        queries, candidates = (d.select([F.col(c).alias(c) for c in d.columns]) for d in (queries, candidates))
        more = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(_search_block(k), FOUND)
        found = first.unionByName(more)
    # A query has at most k rows of each shard.
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    known = F.when(F.col("vec_id") != NO_ID, F.col("vec_id"))
    return ranked.select("query_id", "rank", known.alias("vec_id"), "score")
