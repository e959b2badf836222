"""Sketches as small tables: stored per group, merged later, with proven errors.

A sketch is rows of a table, so that storing one is writing it and merging is an
aggregate that combines in the map tasks. Distinct counts keep the largest rank per
register (HyperLogLog), quantiles keep counts of logarithmic buckets, and heavy hitters
keep the largest counters after all lose what the next one has (Misra and Gries).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# 2**12 registers: a standard error of 1.04 / 64.
PRECISION = 12
SALTS = 32


def distinct_sketch(df: DataFrame, by: Sequence[str], column: str, *, precision: int = PRECISION) -> DataFrame:
    """(by, register, rank): registers that some value fell in; nulls count as no value."""
    code = F.xxhash64(F.col(column))
    register = code.bitwiseAND(F.lit((1 << precision) - 1)).cast("int").alias("register")
    # Position of the first set bit of the rest, from the lowest on.
    rest = F.shiftrightunsigned(code, precision)
    lowest = F.length(F.bin(rest.bitwiseAND(-rest)))
    rank = F.when(rest == 0, 64 - precision + 1).otherwise(lowest).cast("int")
    return df.where(F.col(column).isNotNull()).groupBy(*by, register).agg(F.max(rank).alias("rank"))


def merge_distinct(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    return sketch.groupBy(*by, "register").agg(F.max("rank").alias("rank"))


def distinct_estimate(sketch: DataFrame, by: Sequence[str], *, precision: int = PRECISION) -> DataFrame:
    """(by, estimate): within 1.04 / sqrt(2**precision) of the number of values, by standard error."""
    size = 1 << precision
    merged = merge_distinct(sketch, by)
    seen, powers = F.count("*"), F.sum(F.pow(F.lit(2.0), -F.col("rank")))
    empty = size - seen
    raw = F.lit(0.7213 / (1 + 1.079 / size) * size * size) / (powers + empty)
    # Few values: from the share of empty registers.
    estimate = F.when((raw <= 2.5 * size) & (empty > 0), size * F.log(size / empty.cast("double"))).otherwise(raw)
    return merged.groupBy(*by).agg(F.round(estimate).cast("bigint").alias("estimate"))


def quantile_sketch(df: DataFrame, by: Sequence[str], column: str, *, error: float = 0.01) -> DataFrame:
    """(by, sign, bucket, n): counts of values whose logarithm falls in the bucket; nulls and NaN are left out."""
    width = math.log((1 + error) / (1 - error))
    value = F.col(column).cast("double")
    bucket = F.when(value == 0, 0).otherwise(F.ceil(F.log(F.abs(value)) / width)).cast("int").alias("bucket")
    kept = df.where(value.isNotNull() & ~F.isnan(value))
    return kept.groupBy(*by, F.signum(value).cast("int").alias("sign"), bucket).agg(F.count("*").alias("n"))


def merge_counts(sketch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sketch.groupBy(*keys).agg(F.sum("n").alias("n"))


def quantile_estimate(sketch: DataFrame, by: Sequence[str], shares: Sequence[float], *, error: float = 0.01) -> DataFrame:
    """(by, share, estimate): within ``error`` times the value of rank ceil(share * n), at least 1.

    A group has some thousand buckets for all magnitudes of a double.
    """
    width = math.log((1 + error) / (1 - error))
    merged = merge_counts(sketch, [*by, "sign", "bucket"])
    # In the order of values: negative ones by falling buckets.
    middle = F.col("sign") * F.exp(F.col("bucket") * width) * F.lit(1 - error)
    placed = merged.withColumn("value", F.when(F.col("sign") == 0, 0.0).otherwise(middle))
    whole = Window.partitionBy(*by)
    upto = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    asked = summed.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    reached = F.col("upto") >= F.greatest(F.lit(1), F.ceil(F.col("share") * F.col("total")))
    return asked.where(reached).groupBy(*by, "share").agg(F.min("value").alias("estimate"))


def _largest(counts: DataFrame, by: Sequence[str], column: str, most: int) -> DataFrame:
    """The ``most`` largest counters of each group, less the next one."""
    order = Window.partitionBy(*by).orderBy(F.desc("n"), column)
    ranked = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most + 1)
    lost = F.coalesce(F.max(F.when(F.col("_rank") == most + 1, F.col("n"))).over(Window.partitionBy(*by)), F.lit(0))
    less = ranked.withColumn("n", F.col("n") - lost).where((F.col("_rank") <= most) & (F.col("n") > 0))
    return less.select(*by, column, "n")


def heavy_sketch(df: DataFrame, by: Sequence[str], column: str, *, most: int = 100) -> DataFrame:
    """(by, column, n): at most ``most`` values of each group.

    A value's count lies between n, zero where it is missing, and n plus the group's
    rows over ``most`` + 1: what one counter loses at a time, that many others lose too.
    This holds after any merges. Rows of a group are dealt to salts by their value, and
    the salts' counters merged.
    """
    salt = F.pmod(F.xxhash64(column), F.lit(SALTS)).alias("_salt")
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, salt, column).agg(F.count("*").alias("n"))
    return merge_heavy(_largest(counts, [*by, "_salt"], column, most).drop("_salt"), by, column, most=most)


def merge_heavy(sketch: DataFrame, by: Sequence[str], column: str, *, most: int = 100) -> DataFrame:
    """Sketches of the same ``most`` added up into one for each ``by``."""
    salt = F.pmod(F.xxhash64(column), F.lit(SALTS)).alias("_salt")
    added = sketch.groupBy(*by, salt, column).agg(F.sum("n").alias("n"))
    # The salts first, so that no task sees the counters of many sketches.
    return _largest(_largest(added, [*by, "_salt"], column, most).drop("_salt"), by, column, most)
