"""Projection, renaming, filtering, previews, counts and the schema as a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Tasks that share a group's rows before they meet in one.
SALTS = 64


def project(df: DataFrame, *columns: str | Column, **renamed: str | Column) -> DataFrame:
    """Select columns as they are, then ``new_name=column_or_expression`` ones."""
    picked = [F.col(c) if isinstance(c, str) else c for c in columns]
    picked += [
        (F.col(source) if isinstance(source, str) else source).alias(name)
        for name, source in renamed.items()
    ]
    return df.select(*picked)


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    if old not in df.columns:
        raise ValueError(f"no column {old} in {df.columns}")
    return df.withColumnRenamed(old, new)


def filter_equals(df: DataFrame, column: str, value: int | float | str) -> DataFrame:
    """Rows where ``column`` equals a literal; reaches the scan as a pushed filter."""
    return df.where(F.col(column) == F.lit(value))


def filter_sql(df: DataFrame, condition: str) -> DataFrame:
    """Rows that meet a condition written in SQL, such as ``"prediction = 3"``."""
    return df.where(condition)


def preview(df: DataFrame, n: int, order_by: list[str | Column]) -> DataFrame:
    """First n rows in a stated order: a top-n per task, merged, never a full sort."""
    return df.orderBy(*order_by).limit(n)


def rows_per_group(df: DataFrame, group: str, n: int, order_by: list[str]) -> DataFrame:
    """First n rows of every group, with their position ``rn``; one plan for every n.

    Rows are trimmed twice: to n per group and salt, then to n per group. A group
    that holds most rows is spread over ``SALTS`` tasks in the first step, and the
    second one sees at most n times as many rows of it. Rows that tie in
    ``order_by`` follow the hash of all their columns, in any layout.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    salted = df.withColumn("_tie", tie).withColumn("_salt", F.pmod("_tie", F.lit(SALTS)))
    order = [*order_by, "_tie"]
    for keys in ([group, "_salt"], [group]):
        ranked = Window.partitionBy(*keys).orderBy(*order)
        salted = salted.withColumn("rn", F.row_number().over(ranked)).where(F.col("rn") <= n)
    return salted.drop("_tie", "_salt")


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def schema_table(df: DataFrame) -> DataFrame:
    """Schema as rows: position, column, type and nullable flag. Reads no data."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Rows (column_name, n_null) for every column, from one pass over all of them."""
    fields = df.schema.fields
    nulls = df.agg(*[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.col(f"c{i}").alias("n_null")) for i, f in enumerate(fields)]
    return nulls.select(F.inline(F.array(*rows)))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
