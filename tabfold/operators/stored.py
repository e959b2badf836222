"""Fitted pipelines on disk, with what they were fitted on, checked when they are loaded."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

FORMAT = 1


@dataclass(frozen=True)
class Stored:
    """A loaded model: ``inputs`` maps the columns it reads to their types."""

    model: PipelineModel
    version: str
    inputs: dict[str, str]
    metrics: dict[str, float]

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with the model's columns and ``model_version``; refuses a schema that is not the one of the fit."""
        held = {f.name: f.dataType.simpleString() for f in df.schema}
        wrong = {c: (t, held.get(c)) for c, t in self.inputs.items() if held.get(c) != t}
        if wrong:
            raise ValueError(f"columns that differ from those of the fit: {wrong}")
        return self.model.transform(df).withColumn("model_version", F.lit(self.version))


def save_model(
    model: PipelineModel,
    path: str,
    train: DataFrame,
    inputs: Sequence[str],
    *,
    version: str,
    metrics: Mapping[str, float] | None = None,
) -> None:
    """Write the model under ``path``/``version``; a version is written once.

    ``inputs`` names the columns of ``train`` that the model reads when it scores.
    """
    spark = train.sparkSession
    kinds = {c: train.schema[c].dataType.simpleString() for c in inputs}
    model.save(f"{path}/{version}/model")
    # Written last: a version without it was not finished.
    text = json.dumps({"format": FORMAT, "version": version, "inputs": kinds, "metrics": dict(metrics or {})}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/{version}/about")


def load_model(spark: SparkSession, path: str, version: str) -> Stored:
    about = json.loads("\n".join(r["value"] for r in spark.read.text(f"{path}/{version}/about").collect()))
    if about["format"] != FORMAT:
        raise ValueError(f"format {about['format']} of {path}/{version} is not {FORMAT}")
    return Stored(PipelineModel.load(f"{path}/{version}/model"), about["version"], about["inputs"], about["metrics"])
