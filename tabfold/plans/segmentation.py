"""Segmentation by k-means over a range of k."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tabfold.operators.clusters import (
    Sweep,
    assign,
    cluster_profile,
    kmeans_sweep,
    model_centers,
)
from tabfold.operators.features import assemble
from tabfold.operators.relational import rows_per_group
from tabfold.sources import CUSTOMER_FEATURES, read_csv, sql

SHOWN_ROWS = 10


@dataclass(frozen=True)
class Segmentation:
    sweep: Sweep
    model: KMeansModel
    best: DataFrame
    centers: DataFrame
    assigned: DataFrame
    features: Sequence[str]

    def profile(self) -> DataFrame:
        return cluster_profile(self.assigned, "prediction", self.features)

    def examples(self, order_by: list[str], n: int = SHOWN_ROWS) -> DataFrame:
        """First n rows of every cluster, all clusters in one pass."""
        return rows_per_group(self.assigned.drop("features"), "prediction", n, order_by)


def segment(
    data: DataFrame,
    features: Sequence[str],
    *,
    ks: Iterable[int] = range(2, 7),
    seed: int = 0,
    parallelism: int = 1,
    rows_per_part: int | None = None,
    **params,
) -> Segmentation:
    """Sweep k, take the k with the best silhouette, and assign every row.

    ``params`` are those of the k-means estimator.
    """
    vectors = assemble(data, features)
    sweep = kmeans_sweep(vectors, "features", ks, seed=seed, parallelism=parallelism, rows_per_part=rows_per_part, **params)
    model = sweep.best_model()
    return Segmentation(
        sweep,
        model,
        sweep.best(),
        model_centers(data.sparkSession, model),
        assign(vectors, model),
        tuple(features),
    )


def segment_customers(
    spark: SparkSession,
    path: str,
    *,
    schema: StructType | str | None = None,
    csv: Mapping | None = None,
    **options,
) -> Segmentation:
    """The workflow on a customers CSV file.

    Types are inferred, at the cost of reading the file once more, unless a
    schema such as ``CUSTOMERS`` is given. ``csv`` holds reader options.
    """
    customers = sql(
        spark,
        "SELECT * FROM customers_csv",
        customers_csv=read_csv(spark, path, schema, infer=schema is None, **(csv or {})),
    )
    return segment(customers, CUSTOMER_FEATURES, **options)
