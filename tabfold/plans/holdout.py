"""Train and held-out rows, as every supervised workflow here needs them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tabfold.operators.relational import rename, union_all
from tabfold.operators.splits import hash_part, hash_split, random_split

WEIGHTS = (0.7, 0.3)
BUCKETS = 10
PARTS = ("train", "test")


@dataclass(frozen=True)
class Holdout:
    train: DataFrame
    test: DataFrame
    tagged: DataFrame

    def counts(self) -> DataFrame:
        """Row counts of both parts as one table."""
        return self.tagged.groupBy("part").agg(F.count("*").alias("n_rows"))


def hold_out(
    data: DataFrame,
    *,
    keys: Sequence[str] | None = None,
    seed: int | None = None,
    weights: Sequence[float] = WEIGHTS,
    label: str = "label",
    true_label: str = "trueLabel",
    buckets: int = BUCKETS,
    columns: Sequence[str] | None = None,
) -> Holdout:
    """Split by key hash, or at random by seed; the test label is renamed.

    The weights of a split by keys must be multiples of 1 / ``buckets``.
    A random split writes its rows: ``columns`` names those that are read later, all by
    default.
    """
    if (keys is None) == (seed is None):
        raise ValueError("give key columns or a seed, one of them")
    if keys is not None:
        parts = hash_split(data, keys, weights, buckets=buckets)
        # One scan tells the parts apart.
        number = hash_part(keys, weights, buckets=buckets)
        tagged = data.select(F.element_at(F.lit(list(PARTS)), number + 1).alias("part"))
    else:
        parts = random_split(data if columns is None else data.select(*columns), weights, seed)
        tagged = union_all([p.select(F.lit(n).alias("part")) for n, p in zip(PARTS, parts)])
    return Holdout(parts[0], rename(parts[1], label, true_label), tagged)
