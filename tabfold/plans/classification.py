"""Classification by a decision tree on categories and numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tabfold.functions import threshold_label
from tabfold.operators.features import (
    assembler,
    category_indexer,
    minmax_scaler,
    string_index_model,
)
from tabfold.operators.models import chain, decision_tree, fit, score
from tabfold.operators.relational import project
from tabfold.plans.holdout import BUCKETS, Holdout, hold_out
from tabfold.sources import FLIGHTS, read_csv

# Minutes beyond which an arrival is late, and the flight columns.
LATE_AFTER = 15
FLIGHT_NAME = "Carrier"
FLIGHT_CATEGORIES = ("DayofMonth", "DayOfWeek", "OriginAirportID", "DestAirportID")
FLIGHT_NUMBERS = ("DepDelay",)
# Labels of the text column that the driver and the model hold at most.
MAX_LABEL_BYTES = 16 << 20


@dataclass(frozen=True)
class Classification:
    holdout: Holdout
    model: PipelineModel
    predictions: DataFrame


def classify(
    data: DataFrame,
    name: str,
    categories: Sequence[str],
    numbers: Sequence[str],
    *,
    keys: Sequence[str] | None = None,
    seed: int = 0,
    handle_invalid: str = "error",
    carry: Sequence[str] = (),
    rows_per_part: int | None = None,
    buckets: int = BUCKETS,
    max_label_bytes: int = MAX_LABEL_BYTES,
    **tree_params,
) -> Classification:
    """Index the text column and the categories, scale the numbers, fit a tree.

    ``data`` has a double ``label``. ``carry`` names further columns of the
    held-out rows to keep beside the predictions. The text column's labels become a
    part of the model, so more than ``max_label_bytes`` of them are refused.
    """
    used = list(dict.fromkeys([name, *categories, *numbers, *carry, "label"]))
    parts = hold_out(data, keys=keys, seed=None if keys else seed, buckets=buckets, columns=used)
    # Column names of the stages are those of the workflow's output.
    named = string_index_model(parts.train, name, f"{name}Idx", handle_invalid, max_bytes=max_label_bytes)
    gathered = assembler([named.getOutputCol(), *categories], "catFeatures")
    indexed = category_indexer(
        gathered.getOutputCol(), "idxCatFeatures", handle_invalid=handle_invalid
    )
    measured = assembler(numbers, "numFeatures")
    scaled = minmax_scaler(measured.getOutputCol(), "normFeatures")
    joined = assembler([indexed.getOutputCol(), scaled.getOutputCol()])
    tree = decision_tree(joined.getOutputCol(), **tree_params)
    model = fit(
        chain(named, gathered, indexed, measured, scaled, joined, tree),
        parts.train,
        [gathered.getOutputCol(), *numbers, "label"],
        rows_per_part=rows_per_part,
    )
    scored = score(model, parts.test, *carry, "features", "prediction", "trueLabel")
    return Classification(parts, model, scored)


def late_flights(
    spark: SparkSession,
    path: str,
    *,
    seed: int = 0,
    keys: Sequence[str] | None = None,
    schema: StructType | str = FLIGHTS,
    csv: Mapping | None = None,
    **options,
) -> Classification:
    """The workflow on a flights CSV file: will the flight arrive late?

    ``keys`` names columns of the file that identify a row; they replace the seeded
    split by one that neither copies nor sorts. ``schema`` declares a file with more
    columns, ``csv`` holds reader options, ``options`` are those of ``classify``.
    """
    used = (FLIGHT_NAME, *FLIGHT_CATEGORIES, *FLIGHT_NUMBERS)
    flights = project(
        read_csv(spark, path, schema, **(csv or {})),
        *used,
        *[k for k in keys or () if k not in used],
        label=threshold_label("ArrDelay", LATE_AFTER),
    )
    return classify(
        flights, FLIGHT_NAME, FLIGHT_CATEGORIES, FLIGHT_NUMBERS, keys=keys, seed=seed, **options
    )
