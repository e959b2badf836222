"""Counts and sums per event-time window.

Rows are combined per task before they meet the state, so a hot key costs one row per
task and window. A window is final when the watermark, the latest time seen less the
delay, has passed its end; it is then written and its state dropped. Rows of final
windows are late: they are dropped and counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.streaming.runs import Run

KINDS = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def window_stream(
    stream: DataFrame,
    time: str,
    size: str,
    delay: str,
    aggregates: Mapping[str, tuple[str, str]],
    *,
    by: Sequence[str] = (),
    slide: str | None = None,
) -> DataFrame:
    """``start``, ``end``, the ``by`` columns and the aggregates of each window of ``size``.

    ``aggregates`` maps names to (count, sum, min or max, column); ``*`` counts rows.
    Windows overlap with a ``slide`` smaller than the size. Rows without a time belong
    to no window; nulls in ``by`` are a key of their own.
    """
    if len(set(aggregates.values())) < len(aggregates):
        raise ValueError("an aggregate is asked for twice, but the state has it once")
    found = [KINDS[kind](column if column == "*" else F.col(column)).alias(name) for name, (kind, column) in aggregates.items()]
    timed = stream.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    grouped = timed.groupBy(F.window("_time", size, slide).alias("_window"), *by).agg(*found)
    return grouped.select(F.col("_window.start").alias("start"), F.col("_window.end").alias("end"), *by, *aggregates)


def windows_of(spark: SparkSession, run: Run, schema, by: Sequence[str] = ()) -> DataFrame:
    """All windows of a run, those not final yet with ``final`` false; ``schema`` is that of the stream's result.

    Final windows come from the output, the others from the state, whose values are the
    aggregates in their order.
    """
    names = [f.name for f in schema if f.name not in ("start", "end", *by)]
    value = ", ".join(f"`{n}`: {schema[n].dataType.simpleString()}" for n in names)
    final = spark.read.schema(schema).parquet(run.output).withColumn("final", F.lit(True))
    held = run.state(spark).withColumn("value", F.col("value").cast(f"struct<{value}>"))
    window = F.col("key").getField(held.schema["key"].dataType.names[0])
    still = held.select(
        window["start"].alias("start"), window["end"].alias("end"), *[F.col(f"key.`{c}`") for c in by], "value.*", F.lit(False).alias("final")
    )
    return final.unionByName(still.select(*final.columns))
