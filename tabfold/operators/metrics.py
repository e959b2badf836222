"""Error metrics as one-row tables."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, functions as F


def rmse_evaluator(label: str = "label", prediction: str = "prediction") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse")


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Root mean squared error as a lazy one-row table."""
    gap = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"))
