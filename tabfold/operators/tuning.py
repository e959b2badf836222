"""Parameter grids and cross-validated search for any estimator."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.operators.holding import held
from tabfold.operators.moments import ridge_search


@dataclass(frozen=True)
class Search:
    """Outcome of a search: one row per grid point, and the refitted winner."""

    metrics: DataFrame
    best_model: Model
    best_index: int


def grid(axes: Sequence[tuple[Param, Sequence]]) -> list[dict]:
    """Cross product of the axes; the last axis varies fastest."""
    builder = ParamGridBuilder()
    for param, values in axes:
        builder = builder.addGrid(param, list(values))
    return builder.build()


def cross_validate(
    train: DataFrame,
    estimator: Estimator,
    evaluator: Evaluator,
    points: list[dict],
    *,
    folds: int,
    seed: int,
    fold_column: str | None = None,
    parallelism: int = 1,
    rows_per_part: int | None = None,
) -> Search:
    """Fit every grid point on every fold, then refit the best on all rows.

    With ``fold_column`` the folds are the given ones; otherwise rows are drawn
    at random with the required seed. ``parallelism`` fits that many grid points
    at a time. Ties go to the first grid point. ``train`` should have no columns
    beyond those used, as it is held while the search runs.
    """
    _grid_columns(points)
    search = CrossValidator(
        estimator=estimator,
        evaluator=evaluator,
        estimatorParamMaps=points,
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
        **({"foldCol": fold_column} if fold_column else {}),
    )
    with held(train, *train.columns, rows_per_part=rows_per_part) as rows:
        fitted = search.fit(rows)
    scores = fitted.avgMetrics
    pick = max if evaluator.isLargerBetter() else min
    return Search(_metrics(train.sparkSession, points, scores), fitted.bestModel, scores.index(pick(scores)))


def cross_validate_ridge(
    train: DataFrame,
    features: Sequence[str],
    steps: Pipeline,
    points: list[dict],
    *,
    folds: int,
    fold_column: str,
    label: str = "label",
) -> Search:
    """``cross_validate`` by RMSE for a linear regression with squared penalty, in a few passes.

    ``steps`` assembles ``features``, may scale them, and ends with the regression. Such a
    fit has a closed form, so all errors come from the moments of the folds and only the
    winner is fitted. The iteration limit has no effect on it: grid points that differ in
    that tie, and the first wins. ``train`` is read once and held for the passes.
    """
    _grid_columns(points)
    *before, line = steps.getStages()
    if not isinstance(line, LinearRegression) or not _closed_form(line) or label != line.getLabelCol():
        raise ValueError("the last step is no linear regression with a closed form")
    penalties = [_value(p, "regParam", line.getRegParam()) for p in points]
    if any(param.parent != line.uid or param.name not in ("regParam", "maxIter") for param in points[0]):
        raise ValueError("only penalty and iteration limit can be searched by moments")
    distinct = list(dict.fromkeys(penalties))
    with held(train, *features, label, fold_column) as rows:
        by_penalty = ridge_search(rows, features, label, fold_column, distinct, folds=folds).scores
        scores = [by_penalty[distinct.index(p)] for p in penalties]
        best = scores.index(min(scores))
        model = Pipeline(stages=[*before, line.copy(points[best])]).fit(rows)
    return Search(_metrics(train.sparkSession, points, scores), model, best)


def _closed_form(line: LinearRegression) -> bool:
    """Whether the ML library fits from moments as ``moments.solve`` does."""
    return (
        line.getSolver() in ("auto", "normal")
        and line.getElasticNetParam() == 0
        and line.getLoss() == "squaredError"
        and line.getFitIntercept()
        and line.getStandardization()
        and not line.isDefined("weightCol")
    )


def _value(point: dict, name: str, default: float) -> float:
    return next((float(v) for param, v in point.items() if param.name == name), default)


def _metrics(spark: SparkSession, points: list[dict], scores: Sequence[float]) -> DataFrame:
    """One row per grid point: its number, the searched values, and the mean metric."""
    columns = _grid_columns(points)
    rows = [
        (i, *[kind(point[param]) for param, kind in columns], float(metric))
        for i, (point, metric) in enumerate(zip(points, scores))
    ]
    typed = [f"{param.name} {'double' if kind is float else 'string'}" for param, kind in columns]
    return spark.createDataFrame(rows, ", ".join(["grid_index int", *typed, "metric double"]))


def _grid_columns(points: list[dict]) -> list[tuple[Param, type]]:
    """Searched parameters with their kind in the metrics table: numbers, or else text."""
    if not points:
        raise ValueError("the grid is empty")
    if any(set(p) != set(points[0]) for p in points):
        raise ValueError("grid points set different parameters")
    if len({p.name for p in points[0]}) < len(points[0]):
        raise ValueError("two searched parameters have one name")

    def kind(param: Param) -> type:
        values = [p[param] for p in points]
        return float if all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in values) else str

    return [(param, kind(param)) for param in points[0]]


def best_row(metrics: DataFrame, metric: str = "metric", *, larger: bool, tie: str) -> DataFrame:
    """The best row of a metrics table, ties to the smallest ``tie`` value."""
    order = F.desc(metric) if larger else F.asc(metric)
    return metrics.orderBy(order, F.asc(tie)).limit(1)
