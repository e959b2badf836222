"""Train/test splits and folds."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from tabfold.functions import hash_bucket
from tabfold.session import fresh_path

SPLIT_DRAW, FOLD_DRAW = 0, 1
DRAW = "_draw"


def random_split(
    df: DataFrame, weights: Sequence[float], seed: int
) -> list[DataFrame]:
    """Random parts by weight. The seed is required.

    Every row gets one draw, and a part is a filter on it: no sort. A draw depends
    on the row's place in its partition, so rows and draws are written to the
    shared folder once, as Parquet, which keeps them when executors are lost and
    lets a part read only the columns it needs.
    """
    whole = draw_once(df, seed)
    edges = [0.0, *(w / sum(weights) for w in accumulate(weights))]
    # The last edge is open, whatever the sum of the weights is rounded to.
    draw = F.col(DRAW)
    insides = [(draw >= low) & (draw < high) for low, high in zip(edges, edges[1:-1])]
    return [whole.where(c).drop(DRAW) for c in [*insides, draw >= edges[-2]]]


def draw_once(df: DataFrame, seed: int) -> DataFrame:
    """``df`` with a uniform draw per row, written and read back."""
    if DRAW in df.columns:
        raise ValueError(f"the input has a column {DRAW}")
    path = fresh_path(df.sparkSession, "drawn")
    df.withColumn(DRAW, F.rand(seed)).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _cuts(weights: Sequence[float], buckets: int) -> list[int]:
    """Upper bucket bound of each part."""
    edges = [buckets * w / sum(weights) for w in accumulate(weights)]
    cuts = [round(e) for e in edges]
    if any(abs(e - c) > 1e-9 for e, c in zip(edges, cuts)):
        raise ValueError(f"weights {list(weights)} are no multiples of 1/{buckets}")
    return cuts


def hash_part(keys: Sequence[str], weights: Sequence[float], *, buckets: int = 10) -> Column:
    """Number of the part, 0 for the first weight, that ``hash_split`` puts a row in."""
    # A lookup by bucket, so that a row is hashed once.
    cuts = _cuts(weights, buckets)
    part_of = [sum(b >= c for c in cuts) for b in range(buckets)]
    return F.lit(part_of)[hash_bucket(keys, buckets, draw=SPLIT_DRAW)]


def hash_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], *, buckets: int = 10
) -> list[DataFrame]:
    """Parts by key hash: no shuffle, no sort, same rows in any layout or engine."""
    cuts = _cuts(weights, buckets)
    bucket = hash_bucket(keys, buckets, draw=SPLIT_DRAW)

    def inside(low: int, high: int) -> Column:
        # One comparison each, so that a row is hashed once.
        if low == 0:
            return bucket < F.lit(high)
        if high == buckets:
            return bucket >= F.lit(low)
        return F.pmod(bucket - low, F.lit(buckets)) < F.lit(high - low)

    return [df.where(inside(low, high)) for low, high in zip([0, *cuts], cuts)]


def hash_fold(keys: Sequence[str], folds: int) -> Column:
    """Fold number 0..folds-1 by key hash, independent of ``hash_split``."""
    return hash_bucket(keys, folds, draw=FOLD_DRAW)


def with_hash_fold(
    df: DataFrame, keys: Sequence[str], folds: int, name: str = "fold"
) -> DataFrame:
    return df.withColumn(name, hash_fold(keys, folds))
