"""Estimators, pipelines of stages, fitting and scoring."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import takewhile

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession

from tabfold.operators.holding import held


def linear_regression(features: str = "features", label: str = "label", **params) -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=label, **params)


def logistic_regression(
    features: str = "features", label: str = "label", **params
) -> LogisticRegression:
    """Binary logistic regression.

    Every iteration merges one gradient per task, as wide as the feature vector.
    With a wide vector and many tasks pass ``aggregationDepth=3`` or more, so
    that the driver merges few of them.
    """
    return LogisticRegression(featuresCol=features, labelCol=label, **params)


def decision_tree(
    features: str = "features", label: str = "label", **params
) -> DecisionTreeClassifier:
    """Decision tree; ``maxBins`` must reach the largest number of categories."""
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, **params)


def chain(*stages: Transformer | Estimator) -> Pipeline:
    return Pipeline(stages=list(stages))


def fit(
    pipeline: Pipeline, train: DataFrame, keep: Sequence[str], *, rows_per_part: int | None = None
) -> PipelineModel:
    """Fit a pipeline, holding only the columns that its estimators need.

    Leading stages that have nothing to learn run first; ``keep`` names the
    columns that the stages after them read. The estimators then pass over these
    and not over the source, which for texts means over hashed words. ``rows_per_part``
    deals them out to more partitions where the input has too few for its rows.
    """
    stages = pipeline.getStages()
    lead = list(takewhile(lambda s: isinstance(s, Transformer), stages))
    prepared = PipelineModel(lead).transform(train) if lead else train
    with held(prepared, *keep, rows_per_part=rows_per_part) as rows:
        learned = Pipeline(stages=stages[len(lead) :]).fit(rows)
    return PipelineModel([*lead, *learned.stages])


def score(model: Transformer, test: DataFrame, *columns: str) -> DataFrame:
    """Predictions for held-out rows, projected to ``columns`` if any are named."""
    scored = model.transform(test)
    return scored.select(*columns) if columns else scored.select("*")


def coefficients(
    spark: SparkSession,
    model: LinearRegressionModel | LogisticRegressionModel,
    names: Sequence[str],
) -> DataFrame:
    """Fitted weights as rows (term, value), the intercept among them."""
    if len(names) != len(model.coefficients):
        raise ValueError(f"{len(names)} names for {len(model.coefficients)} weights")
    rows = [("intercept", float(model.intercept))]
    rows += [(n, float(v)) for n, v in zip(names, model.coefficients)]
    return spark.createDataFrame(rows, "term string, value double")
