"""CSV input."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    *,
    infer: bool = False,
    header: bool = True,
    sep: str = ",",
    where: str | Column | None = None,
    **options,
) -> DataFrame:
    """Read CSV with a declared schema, inferred types, or all columns as strings.

    A declared schema is the form for large inputs: inference reads the whole
    input once more (``samplingRatio`` shortens that pass, at the risk of a type
    that is too narrow). A header that does not match the schema fails the query.
    Text with doubled quotes needs ``escape='"'``. Text with
    line breaks needs ``multiLine=True``, which stops Spark from splitting a file
    among tasks, so such inputs should come as many files of moderate size.

    Columns that the schema (a ``StructType`` or DDL text) declares as not null are
    checked as the rows stream by. A filter given as ``where`` goes to the scan,
    ahead of the check; one applied to the result stops at it. ``null_counts``
    checks every column of every row.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if schema is not None and infer:
        raise ValueError("give a schema or ask for inference, not both")
    if schema is not None and header:
        # Compare the header with the declared names instead of going by position.
        options.setdefault("enforceSchema", False)
    reader = spark.read.format("csv").options(header=header, sep=sep, **options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    df = reader.load(path)
    if where is not None:
        df = df.where(where)
    if isinstance(schema, StructType):
        # A file read reports every column as nullable, so declared non-null
        # columns are enforced on the rows.
        df = require_not_null(df, [f.name for f in schema.fields if not f.nullable])
    return df


def require_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail the query on a null in ``columns``, checked as the rows stream by.

    The check is part of the projection, so it costs no extra pass; a column that
    a later step prunes is not read and not checked.
    """
    checked = {
        name: F.when(
            F.col(name).isNull(), F.raise_error(F.lit(f"null in required column {name}"))
        ).otherwise(F.col(name))
        for name in columns
    }
    return df.withColumns(checked) if checked else df
