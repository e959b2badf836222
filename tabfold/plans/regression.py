"""Regression tuned by cross-validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tabfold.operators.features import assembler, minmax_scaler
from tabfold.operators.metrics import rmse, rmse_evaluator
from tabfold.operators.models import chain, linear_regression, score
from tabfold.operators.relational import project
from tabfold.operators.splits import hash_fold
from tabfold.operators.tuning import cross_validate, cross_validate_ridge, grid
from tabfold.plans.holdout import BUCKETS, Holdout, hold_out
from tabfold.sources import FLIGHTS, read_csv

# The searched penalties and iteration limits, and the features.
REG_PARAMS = (0.3, 0.01)
MAX_ITERS = (10, 5)
FLIGHT_FEATURES = ("DayofMonth", "DayOfWeek", "OriginAirportID", "DestAirportID", "DepDelay")


@dataclass(frozen=True)
class TunedRegression:
    holdout: Holdout
    metrics: DataFrame
    best_index: int
    model: PipelineModel
    predictions: DataFrame
    rmse: DataFrame


def tuned_regression(
    data: DataFrame,
    features: Sequence[str],
    *,
    keys: Sequence[str] | None = None,
    seed: int = 0,
    folds: int = 2,
    reg_params: Sequence[float] = REG_PARAMS,
    max_iters: Sequence[int] = MAX_ITERS,
    search: str = "general",
    parallelism: int = 1,
    rows_per_part: int | None = None,
    buckets: int = BUCKETS,
) -> TunedRegression:
    """Scale, fit, search penalty by iterations over the folds, score the held-out rows.

    ``data`` has the features and ``label``. With ``keys`` the split and the
    folds follow the key hash; otherwise both are drawn with ``seed``.

    The general search fits every grid point on every fold. ``search="moments"``
    computes the errors from the moments of the folds and fits the winner: a linear
    fit has a closed form, in which the iteration limit has no effect, so grid points
    that differ in it tie and the first wins. ``rows_per_part`` deals the training rows
    out to more partitions during the general search, where the input has too few for them.
    """
    if search not in ("general", "moments"):
        raise ValueError("search must be 'general' or 'moments'")
    features = list(features)
    parts = hold_out(data, keys=keys, seed=None if keys else seed, buckets=buckets, columns=[*features, "label"])
    fold = hash_fold(keys, folds) if keys else F.floor(F.rand(seed) * folds).cast("int")
    train = parts.train.withColumn("fold", fold).select(*features, "label", "fold")
    assemble = assembler(features)
    scale = minmax_scaler(assemble.getOutputCol(), "normFeatures")
    line = linear_regression(scale.getOutputCol())
    steps = chain(assemble, scale, line)
    points = grid([(line.regParam, reg_params), (line.maxIter, max_iters)])
    if search == "general":
        found = cross_validate(
            train,
            steps,
            rmse_evaluator(),
            points,
            folds=folds,
            seed=seed,
            fold_column="fold",
            parallelism=parallelism,
            rows_per_part=rows_per_part,
        )
    else:
        found = cross_validate_ridge(train, features, steps, points, folds=folds, fold_column="fold")
    scored = score(found.best_model, parts.test, "normFeatures", "prediction", "trueLabel")
    return TunedRegression(parts, found.metrics, found.best_index, found.best_model, scored, rmse(scored, "trueLabel"))


def arrival_delay(
    spark: SparkSession,
    path: str,
    *,
    seed: int = 0,
    keys: Sequence[str] | None = None,
    schema: StructType | str = FLIGHTS,
    csv: Mapping | None = None,
    **options,
) -> TunedRegression:
    """The workflow on a flights CSV file: arrival delay from five columns.

    ``keys`` names columns of the file that identify a row; they replace the seeded
    split by one that neither copies nor sorts. ``schema`` declares a file with more
    columns, ``csv`` holds reader options, ``options`` are those of
    ``tuned_regression``.
    """
    flights = read_csv(spark, path, schema, **(csv or {}))
    extra = [k for k in keys or () if k not in FLIGHT_FEATURES]
    data = project(flights, *FLIGHT_FEATURES, *extra, label="ArrDelay")
    return tuned_regression(data, FLIGHT_FEATURES, keys=keys, seed=seed, **options)
