"""Tables by name: Parquet tables of a folder and session views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` known to SQL under ``name`` for this session."""
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Run one SQL statement, registering the given frames as views first."""
    for name, df in views.items():
        register(df, name)
    return spark.sql(text)
