"""Sessions of keys: rows whose gaps are at most some length.

The state has one row per open session, kept by Spark's session windows. Rows are merged
into sessions in any order; a session is closed, written and forgotten once the watermark
has passed its end by more than the gap. Rows are first joined to sessions within each task,
so that a hot key sends sessions and not rows to the one task that keeps it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.streaming.runs import Run


def session_stream(stream: DataFrame, key: str, time: str, gap_seconds: float, delay: str, *, amount: str) -> DataFrame:
    """Closed sessions: ``key``, ``start`` and ``end`` in microseconds, rows ``n`` and ``total`` of a long column.

    Rows without key or time belong to no session; null amounts add nothing. Rows that are
    older than the watermark by the gap or more are late: they are dropped and counted. One that
    is older by less than the gap joins a session that is open, or else begins one.
    """
    rows = stream.select(
        F.col(key).alias("key"), F.col(time).cast("timestamp").alias("at"), F.coalesce(F.col(amount).cast("bigint"), F.lit(0)).alias("amount")
    ).where("key IS NOT NULL AND at IS NOT NULL")
    window = F.session_window("at", f"{int(gap_seconds * 1_000_000)} microseconds").alias("window")
    # A session ends as the watermark reaches its last row and the gap, but a row at the watermark may still come.
    timed = rows.withWatermark("at", f"{delay} 1 millisecond")
    found = timed.groupBy(window, "key").agg(F.max("at").alias("last"), F.count("*").alias("n"), F.sum("amount").alias("total"))
    return found.select("key", F.unix_micros("window.start").alias("start"), F.unix_micros("last").alias("end"), "n", "total")


def sessions_of(spark: SparkSession, run: Run, key_type: str) -> DataFrame:
    """All sessions of a run, those still open with ``final`` false, read from the state."""
    final = spark.read.schema(f"key {key_type}, start long, end long, n long, total long").parquet(run.output)
    # The window, the key and the aggregates in their order.
    kept = f"struct<window: struct<start: timestamp, end: timestamp>, key: {key_type}, last: timestamp, n: bigint, total: bigint>"
    value = run.state(spark).select(F.col("value").cast(kept).alias("s"))
    still = value.select("s.key", F.unix_micros("s.window.start").alias("start"), F.unix_micros("s.last").alias("end"), "s.n", "s.total")
    return final.withColumn("final", F.lit(True)).unionByName(still.withColumn("final", F.lit(False)))
