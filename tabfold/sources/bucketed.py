"""Partitioned and bucketed tables: writes that may be repeated, joins without a shuffle.

A table is a folder of Parquet files and a description of its layout beside them. A
write replaces the partitions that its rows belong to and leaves the others alone, so
running it again, after a failure or not, gives the same table. Rows are dealt to the
writing tasks by partition and bucket; adaptive execution joins small ones and splits
crowded ones, whose buckets then have several files.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 65_536
BUCKET = "_tabfold_bucket"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two, so that the counts of two tables divide each other."""
    wanted = max(1, -(-rows // rows_per_bucket))
    return min(MAX_BUCKETS, 1 << (wanted - 1).bit_length())


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


@dataclass(frozen=True)
class BucketedTable:
    """A table of the session's catalogue over the files in a folder."""

    spark: SparkSession
    name: str
    columns: tuple[str, ...]
    by: tuple[str, ...]
    keys: tuple[str, ...]
    buckets: int

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*[f"`{c}`" for c in self.columns])

    def replace(self, df: DataFrame) -> None:
        """Put ``df`` in the place of all rows of the partitions that it has rows of.

        Without partition columns it takes the place of all rows. A partition that
        ``df`` has no row of stays as it is; no rows at all change nothing then.
        """
        held = self.spark.table(self.name)
        if missing := set(held.columns) - set(df.columns):
            raise ValueError(f"columns of the table that the rows lack: {sorted(missing)}")
        wrong = {f.name: (f.dataType.simpleString(), df.schema[f.name].dataType.simpleString()) for f in held.schema if df.schema[f.name].dataType != f.dataType}
        if wrong:
            raise ValueError(f"types of the table and of the rows differ: {wrong}")
        # The writer's own rule for buckets, so that a bucket comes from few tasks.
        bucket = F.pmod(F.hash(*[F.col(f"`{c}`") for c in self.keys]), F.lit(self.buckets))
        kept = [F.col(f"`{c}`") for c in held.columns]
        rows = df.select(*kept, bucket.alias(BUCKET)).hint("rebalance", *[F.col(f"`{c}`") for c in self.by], F.col(BUCKET))
        # Only the session's setting reaches an insert into a table of the catalogue.
        before = self.spark.conf.get(OVERWRITE)
        self.spark.conf.set(OVERWRITE, "dynamic" if self.by else "static")
        try:
            rows.select(*kept).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(OVERWRITE, before)


def bucketed_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    buckets: int,
    *,
    by: Sequence[str] = (),
) -> BucketedTable:
    """Open the table in folder ``path`` under ``name``, or begin it.

    ``by`` are its partition columns; rows are bucketed by ``keys`` and sorted by them
    within a file. A folder that was begun with another layout is refused, as a join
    would trust the wrong buckets.
    """
    by, keys = tuple(by), tuple(keys)
    if not keys or set(keys) & set(by) or not set(keys) | set(by) <= set(schema.names):
        raise ValueError("keys and partition columns are different columns of the schema")
    # Partition columns come last in the catalogue and in the files' order.
    fields = [f for f in schema if f.name not in by] + [schema[c] for c in by]
    ordered = StructType([StructField(f.name, f.dataType) for f in fields])
    layout = {"schema": ordered.simpleString(), "by": list(by), "keys": list(keys), "buckets": buckets}
    _agree(spark, f"{path}/layout", layout)
    spark.sql(
        f"CREATE TABLE `{name}` ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in ordered)}) USING parquet "
        + (f"PARTITIONED BY ({_names(by)}) " if by else "")
        + f"CLUSTERED BY ({_names(keys)}) SORTED BY ({_names(keys)}) INTO {buckets} BUCKETS LOCATION '{path}/rows'"
    )
    if by:
        # Makes the folder of a table that has no partition yet.
        spark.createDataFrame([], ordered).write.mode("ignore").partitionBy(*by).parquet(f"{path}/rows")
        spark.catalog.recoverPartitions(f"`{name}`")
    return BucketedTable(spark, name, tuple(schema.names), by, keys, buckets)


def _agree(spark: SparkSession, path: str, layout: dict) -> None:
    """Write the layout if the folder has none; refuse one that differs."""
    text = json.dumps(layout, sort_keys=True)
    # Leaves a layout that is there untouched.
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("ignore").text(path)
    held = "\n".join(r["value"] for r in spark.read.text(path).collect())
    if held != text:
        raise ValueError(f"the folder was begun as {held}, not as {text}")


def bucketed_join(left: BucketedTable, right: BucketedTable, how: str = "inner", *, where: dict[str, str] | None = None) -> DataFrame:
    """Both tables joined on their keys, bucket by bucket: no row is shuffled.

    The tables have equal keys and bucket counts. ``where`` maps ``left`` and ``right``
    to filters, which reach the scans. Null keys equal nothing.
    """
    if left.keys != right.keys or left.buckets != right.buckets:
        raise ValueError("the tables are bucketed differently")
    sides = {"left": left.read(), "right": right.read()}
    for side, text in (where or {}).items():
        sides[side] = sides[side].where(text)
    return sides["left"].hint("merge").join(sides["right"], list(left.keys), how)
