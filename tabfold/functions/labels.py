"""Label columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def threshold_label(column: str, limit: float) -> Column:
    """1.0 above ``limit``, 0.0 at or below it, null for null."""
    return (F.col(column) > F.lit(limit)).cast("double")


def cast_label(column: str, on_bad: str = "error", to: str = "int") -> Column:
    """Cast to the label type; a value that is none of it fails the query or gives null."""
    if on_bad == "error":
        return F.col(column).cast(to)
    if on_bad == "null":
        return F.col(column).try_cast(to)
    raise ValueError("on_bad must be 'error' or 'null'")
