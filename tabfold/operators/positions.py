"""Global positions of sorted rows without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabfold.session import freeze

# monotonically_increasing_id: partition number in the upper bits, row number of
# the partition in the lower 33.
ROW_BITS = 33


def with_position(df: DataFrame, order_by: list[Column], name: str = "position") -> DataFrame:
    """Number the rows 0.. in the given order.

    A range-partitioned sort numbers the rows inside each partition; the written
    result fixes that numbering. Only one count per partition is then summed up
    in order, to give each partition its offset.
    """
    numbered = freeze(df.orderBy(*order_by).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per sort partition: bounded by the shuffle partition setting.
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
        .drop("_id", "_part", "_offset")
    )
