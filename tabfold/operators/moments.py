"""Ridge regression search from second moments: one pass over the rows in all.

A least-squares fit, its prediction error on any set of rows, and the moments of
a union of sets all follow from the count, means and covariances of each fold.
So the whole grid-by-folds search and the final refit need one aggregate for the
columns' means and one for the products about them, which combine in the map
tasks and return one row per fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from tabfold.functions import as_array
from tabfold.operators.features import assemble
from tabfold.sources.delimited import require_not_null

# Directions of this share of the largest one and below count as none.
NEGLIGIBLE = 1e-10


@dataclass(frozen=True)
class Moments:
    n: int
    mean: np.ndarray
    cov: np.ndarray

    @classmethod
    def union(cls, parts: Sequence["Moments"]) -> "Moments":
        n = sum(p.n for p in parts)
        mean = sum(p.n * p.mean for p in parts) / n
        cov = sum(p.n * (p.cov + np.outer(p.mean - mean, p.mean - mean)) for p in parts) / n
        return cls(n, mean, cov)


@dataclass(frozen=True)
class RidgeFit:
    weights: np.ndarray
    intercept: float

    def rmse(self, rows: Moments) -> float:
        """Prediction error on the rows behind ``rows``."""
        direction = np.append(-self.weights, 1.0)
        bias = direction @ rows.mean - self.intercept
        return float(np.sqrt(max(direction @ rows.cov @ direction, 0.0) + bias * bias))


@dataclass(frozen=True)
class MomentsTable:
    """Rows (fold, n, means): means of all values and products of pairs, about ``centre``."""

    rows: DataFrame
    centre: np.ndarray

    def collect(self, folds: int) -> list[Moments]:
        """The moments of each fold, of which there must be ``folds``."""
        found = self.rows.orderBy("fold").limit(folds + 1).collect()
        if len(found) != folds:
            raise ValueError(f"the fold column has {'more' if len(found) > folds else 'fewer'} than {folds} values")
        return [self._moments(row) for row in found]

    def _moments(self, row) -> Moments:
        size = len(self.centre)
        means = np.array(row["means"])
        # Each value is followed by its products with those before it and with itself.
        starts = [j * (j + 3) // 2 for j in range(size)]
        mean = means[starts]
        products = np.empty((size, size))
        for j, start in enumerate(starts):
            products[j, : j + 1] = products[: j + 1, j] = means[start + 1 : start + 2 + j]
        return Moments(row["n"], self.centre + mean, products - np.outer(mean, mean))


def moments_table(df: DataFrame, features: Sequence[str], label: str, fold: str) -> MomentsTable:
    """Count, means and covariances of each fold.

    A first aggregate finds the columns' means. About these, a row's values and
    their products in pairs are one vector, and one grouped aggregate averages
    the vectors; it combines in the map tasks.
    """
    columns = [*features, label]
    checked = require_not_null(df.select(fold, *columns), columns)
    values = [F.col(c).cast("double") for c in columns]
    first = df.agg(*[F.avg(v) for v in values]).first()
    if any(v is None for v in first):
        raise ValueError("no rows, or a column without values")
    centre = np.array(list(first), dtype=float)
    shifted = checked.select(
        F.col(fold).alias("fold"), *[(v - F.lit(float(m))).alias(f"x{i}") for i, (v, m) in enumerate(zip(values, centre))]
    )
    gathered = assemble(shifted, [f"x{i}" for i in range(len(columns))], "x").select("fold", "x")
    pairs = PolynomialExpansion(degree=2, inputCol="x", outputCol="pairs").transform(gathered)
    stats = pairs.groupBy("fold").agg(Summarizer.metrics("count", "mean").summary(F.col("pairs")).alias("s"))
    return MomentsTable(
        stats.select("fold", F.col("s.count").alias("n"), as_array("s.mean").alias("means")), centre
    )


def solve(rows: Moments, reg_param: float) -> RidgeFit:
    """Weights on standardised columns, penalised, brought back to the input scale.

    The penalty is divided by the label's population standard deviation, as the
    ML library does. A constant column gets weight zero; of the weights that fit
    collinear columns equally well, the least ones are taken.
    """
    sd = np.sqrt(np.diag(rows.cov))
    weights = np.zeros(len(sd) - 1)
    used = np.flatnonzero(sd[:-1] > 0)
    if sd[-1] > 0 and len(used):
        inner = rows.cov[np.ix_(used, used)] / np.outer(sd[used], sd[used])
        target = rows.cov[used, -1] / (sd[used] * sd[-1])
        inner = inner + np.eye(len(used)) * (reg_param / sd[-1])
        inverse = np.linalg.pinv(inner, rcond=NEGLIGIBLE, hermitian=True)
        weights[used] = inverse @ target * sd[-1] / sd[used]
    return RidgeFit(weights, float(rows.mean[-1] - weights @ rows.mean[:-1]))


@dataclass(frozen=True)
class RidgeSearch:
    scores: list[float]
    metrics: DataFrame
    coefficients: DataFrame
    best: RidgeFit
    best_reg_param: float


def ridge_search(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    fold: str,
    reg_params: Sequence[float],
    *,
    folds: int,
) -> RidgeSearch:
    """Mean validation RMSE per penalty over the folds, and the refitted winner."""
    spark = train.sparkSession
    if folds < 2:
        raise ValueError("need at least two folds")
    parts = moments_table(train, features, label, fold).collect(folds)
    scores = []
    for reg_param in reg_params:
        errors = [
            solve(Moments.union(parts[:i] + parts[i + 1 :]), reg_param).rmse(held_out)
            for i, held_out in enumerate(parts)
        ]
        scores.append(float(np.mean(errors)))
    pick = scores.index(min(scores))
    best = solve(Moments.union(parts), reg_params[pick])
    terms = [("intercept", best.intercept), *zip(features, map(float, best.weights))]
    return RidgeSearch(
        scores=scores,
        metrics=spark.createDataFrame(
            [(i, float(r), s) for i, (r, s) in enumerate(zip(reg_params, scores))],
            "grid_index int, regParam double, metric double",
        ),
        coefficients=spark.createDataFrame(terms, "term string, value double"),
        best=best,
        best_reg_param=float(reg_params[pick]),
    )


def predict(df: DataFrame, fit: RidgeFit, features: Sequence[str], out: str = "prediction") -> DataFrame:
    """Linear prediction as one generated expression."""
    total = F.lit(fit.intercept)
    for name, weight in zip(features, fit.weights):
        total = total + F.col(name).cast("double") * F.lit(float(weight))
    return df.withColumn(out, total)
