"""Vector arithmetic on array<double> columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F


def as_array(vector: str) -> Column:
    """ML vector column to array<double>."""
    return vector_to_array(F.col(vector), "float64")


def squared_distance(values: Column, point: Sequence[float]) -> Column:
    """Squared distance to a point; values of another length fail the query."""
    squares = F.zip_with(
        values, F.lit([float(p) for p in point]), lambda v, p: (v - p) * (v - p)
    )
    total = F.aggregate(squares, F.lit(0.0), lambda total, v: total + v)
    unequal = F.raise_error(F.concat(F.lit(f"not {len(point)} values but "), F.size(values).cast("string")))
    return F.when(values.isNotNull() & (F.size(values) != len(point)), unequal).otherwise(total)


def rescale(column: Column, low: float, high: float) -> Column:
    """Min-max scaling to [0, 1] with the given range; a constant range gives 0.5."""
    if high == low:
        return F.when(column.isNotNull(), F.lit(0.5))
    return (column.cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))
