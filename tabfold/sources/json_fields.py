"""Typed columns from a column of JSON objects whose fields are not known.

The kinds of value that each field has are counted by an aggregate that combines in the
map tasks. Kinds are joined in a lattice: whole numbers and decimals are numbers, any
other two kinds are text, and null joins nothing. What one part of the rows finds can
so be merged with what another does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MOST_FIELDS = 1000


def field_kinds(df: DataFrame, column: str) -> DataFrame:
    """(field, kind, n): how many values of each kind a field has.

    Kinds are null, boolean, long, double, text, and json for objects and arrays. Rows
    that are null, malformed or no objects have no fields.
    """
    parsed = df.select(F.try_parse_json(F.col(column)).alias("_json"))
    parsed = parsed.where(F.schema_of_variant("_json").startswith("OBJECT"))
    found = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_json").outer()))
    shape = F.schema_of_variant("value")
    kind = (
        F.when(shape == "VOID", "null")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "BIGINT", "long")
        .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), "double")
        .when(shape == "STRING", "text")
        .otherwise("json")
    )
    return found.groupBy(F.col("key").alias("field"), kind.alias("kind")).agg(F.count("*").alias("n"))


def merge_kinds(kinds: DataFrame) -> DataFrame:
    return kinds.groupBy("field", "kind").agg(F.sum("n").alias("n"))


def field_types(kinds: DataFrame) -> DataFrame:
    """(field, type, n): the type that holds all values of a field, and how many are not null."""
    has = lambda *names: F.max(F.col("kind").isin(*names))
    several = F.count_distinct(F.when(F.col("kind") != "null", F.when(F.col("kind") == "long", "double").otherwise(F.col("kind"))))
    numbers = F.when(has("double"), "double").when(has("long"), "bigint").when(has("boolean"), "boolean").otherwise("string")
    held = F.coalesce(F.sum(F.when(F.col("kind") != "null", F.col("n"))), F.lit(0)).alias("n")
    return kinds.groupBy("field").agg(F.when(several == 1, numbers).otherwise("string").alias("type"), held)


def typed_fields(df: DataFrame, column: str, *, prefix: str = "", most: int = MOST_FIELDS) -> DataFrame:
    """``df`` with a column per field that occurs, of its type, in the order of names.

    The ``most`` most frequent fields get columns, ties by name; the text itself stays, with
    all others. Values of conflicting kinds are text, objects and arrays JSON text; a
    missing field and a null are null.
    """
    found = field_types(field_kinds(df, column)).orderBy(F.desc("n"), "field").limit(most).collect()
    names = {r["field"]: r["type"] for r in found}
    if clash := {prefix + n for n in names} & set(df.columns):
        raise ValueError(f"fields named like other columns: {sorted(clash)}")
    parsed = df.withColumn("_json", F.try_parse_json(F.col(column)))

    def value(name: str) -> Column:
        path = "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        return F.try_variant_get("_json", path, names[name]).alias(prefix + name)

    return parsed.select(*[F.col(f"`{c}`") for c in df.columns], *[value(n) for n in sorted(names)])
