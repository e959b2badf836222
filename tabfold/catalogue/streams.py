"""The events as a stream of files, run to its end."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.catalogue.registry import registered
from tabfold.session import fresh_path
from tabfold.sources import load_table
from tabfold.streaming import file_stream, run_available, session_stream, sessions_of, window_stream, windows_of

CENTS_SQL = "round(value * 100)::bigint"
GAP_HOURS = 6
# No event of the table comes later than this after a newer one.
DELAY = "31 days"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    events = load_table(spark, folder, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    return file_stream(spark, f"{folder}/events.parquet", events.schema).withColumn("cents", cents)


@registered(
    "SELECT time_bucket(interval '1' hour, ts) AS start, event_type, count(*) AS n, "
    f"sum({CENTS_SQL})::bigint AS cents, max(value) AS most FROM events GROUP BY ALL"
)
def stream_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Events per hour and type, final or not."""
    found = {"n": ("count", "*"), "cents": ("sum", "cents"), "most": ("max", "value")}
    stream = window_stream(_events(spark, folder), "ts", "1 hour", DELAY, found, by=["event_type"])
    run = run_available(stream, fresh_path(spark, "hourly"))
    windows = windows_of(spark, run, stream.schema, ["event_type"])
    return windows.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", *found)


@registered(
    "SELECT time_bucket(interval '6' hour, ts) + shift.s * interval '6' hour AS start, count(*) AS n, "
    f"sum({CENTS_SQL})::bigint AS cents FROM events, (SELECT unnest([0, -1, -2, -3]) AS s) shift GROUP BY ALL"
)
def stream_sliding_day(spark: SparkSession, folder: str) -> DataFrame:
    """Events per day that begins every six hours."""
    found = {"n": ("count", "*"), "cents": ("sum", "cents")}
    stream = window_stream(_events(spark, folder), "ts", "24 hours", DELAY, found, slide="6 hours")
    run = run_available(stream, fresh_path(spark, "sliding"))
    return windows_of(spark, run, stream.schema).select(F.col("start").cast("timestamp_ntz").alias("start"), *found)


@registered(
    f"""WITH marked AS (
  SELECT user_id, ts, {CENTS_SQL} AS cents,
    coalesce(ts - lag(ts) OVER w > interval '{GAP_HOURS}' hour, true)::int AS first
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), numbered AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked)
SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS n, sum(cents)::bigint AS cents
FROM numbered GROUP BY user_id, session"""
)
def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of users with gaps of six hours at most, closed or open."""
    stream = session_stream(_events(spark, folder), "user_id", "ts", GAP_HOURS * 3600, "2 days", amount="cents")
    run = run_available(stream, fresh_path(spark, "sessions"))
    moment = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return sessions_of(spark, run, "bigint").select(
        F.col("key").alias("user_id"), moment("start").alias("started"), moment("end").alias("ended"), "n", F.col("total").alias("cents")
    )
