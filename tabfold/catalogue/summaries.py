"""Grouping sets, pivots, stored sketches and a stored model."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.catalogue.registry import registered
from tabfold.operators import sketches
from tabfold.operators.features import assembler
from tabfold.operators.grouping import cube_sets, grouping_sets, pivot_found, rollup_sets
from tabfold.operators.models import chain, fit, linear_regression
from tabfold.operators.ranges import running_totals
from tabfold.operators.stored import load_model, save_model
from tabfold.session import fresh_path
from tabfold.sources import load_table

CENTS_SQL = "round(l_extendedprice * 100)::bigint"
WANTED = {"n": ("count", "*"), "total": ("sum", "cents"), "least": ("min", "cents"), "mean": ("avg", "cents")}
WANTED_SQL = f"count(*) AS n, sum({CENTS_SQL})::bigint AS total, min({CENTS_SQL}) AS least, sum({CENTS_SQL})::bigint / count(*) AS mean"
SETS_SQL = (
    "SELECT l_returnflag, l_linestatus, l_linenumber, {wanted}, grouping(l_returnflag, l_linestatus, l_linenumber)::int AS grouping "
    "FROM lineitem GROUP BY {how}(l_returnflag, l_linestatus, l_linenumber)"
)
DIMENSIONS = ["l_returnflag", "l_linestatus", "l_linenumber"]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "lineitem").select(*DIMENSIONS, F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))


@registered(SETS_SQL.format(wanted=WANTED_SQL, how="CUBE"))
def cube_lines(spark: SparkSession, folder: str) -> DataFrame:
    return grouping_sets(_lines(spark, folder), cube_sets(DIMENSIONS), WANTED)


@registered(SETS_SQL.format(wanted=WANTED_SQL, how="ROLLUP"))
def rollup_lines(spark: SparkSession, folder: str) -> DataFrame:
    return grouping_sets(_lines(spark, folder), rollup_sets(DIMENSIONS), WANTED)


@registered(
    "SELECT o_orderstatus, " + ", ".join(
        f"sum(CASE WHEN o_orderpriority = '{p}' THEN round(o_totalprice * 100)::bigint END)::bigint AS \"{p}\"" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM")
    ) + ", sum(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN round(o_totalprice * 100)::bigint END)::bigint AS other "
    "FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderkey % 2 = 0 GROUP BY o_orderstatus"
)
def pivot_priorities(spark: SparkSession, folder: str) -> DataFrame:
    """Cents by status, with a column for each of three priorities and the rest in another.

    Names are given so that the columns do not depend on the counts; tests discover them.
    """
    orders = load_table(spark, folder, "orders").where("o_orderpriority <> '5-LOW' OR o_orderkey % 2 = 0")
    named = F.when(F.col("o_orderpriority") < "4", F.col("o_orderpriority"))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return pivot_found(orders.select("o_orderstatus", named.alias("p"), cents.alias("cents")), ["o_orderstatus"], "p", "cents")


def _days(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "events").withColumn("day", F.to_date("ts"))


def _stored(sketch: DataFrame, stem: str) -> DataFrame:
    path = fresh_path(sketch.sparkSession, stem)
    sketch.write.parquet(path)
    return sketch.sparkSession.read.parquet(path)


@registered("SELECT event_type, count(DISTINCT user_id) AS n_users, true AS near FROM events GROUP BY event_type")
def sketch_distinct_users(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct users of each type from sketches per day and type: within five standard errors of the exact number."""
    events = _days(spark, folder)
    by_day = _stored(sketches.distinct_sketch(events, ["day", "event_type"], "user_id"), "distinct")
    found = sketches.distinct_estimate(by_day, ["event_type"])
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("n_users"))
    near = F.abs(F.col("estimate") - F.col("n_users")) <= F.greatest(F.lit(1.0), 5 * 1.04 / 64 * F.col("n_users"))
    return exact.join(found, "event_type").select("event_type", "n_users", near.alias("near"))


@registered(
    "SELECT event_type, s AS share, list_sort(list(value))[greatest(1, ceil(s * count(*)))::int] AS exact, true AS near "
    "FROM events, (SELECT unnest([0.01, 0.5, 0.99]::double[]) AS s) GROUP BY event_type, s"
)
def sketch_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles of each type from sketches per day and type: within one per cent of the exact value of that rank."""
    events = _days(spark, folder).select("day", "event_type", "value")
    by_day = _stored(sketches.quantile_sketch(events, ["day", "event_type"], "value"), "quantiles")
    found = sketches.quantile_estimate(by_day, ["event_type"], [0.01, 0.5, 0.99])
    ranked = running_totals(events.withColumn("one", F.lit(1).cast("bigint")), ["value"], {"place": "one"}, by=["event_type"])
    sizes = events.groupBy("event_type").agg(F.count("*").alias("n"))
    asked = found.join(sizes, "event_type").withColumn("place", F.greatest(F.lit(1), F.ceil(F.col("share") * F.col("n"))))
    both = asked.join(ranked.select("event_type", "place", F.col("value").alias("exact")), ["event_type", "place"])
    near = F.abs(F.col("estimate") - F.col("exact")) <= 0.01 * F.abs("exact") + 1e-9
    return both.select("event_type", "share", "exact", near.alias("near"))


@registered(
    "SELECT user_id, count(*) AS exact, true AS bounded FROM (SELECT CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id FROM events) "
    "GROUP BY user_id HAVING count(*) > (SELECT count(*) FROM events) / 20.0"
)
def sketch_heavy_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users with over a twentieth of the events, all of which sketches per day of fifty users must have, and their bounds."""
    user = F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id"))
    events = _days(spark, folder).select("day", user.alias("user_id"))
    by_day = _stored(sketches.heavy_sketch(events, ["day"], "user_id", most=50), "heavy")
    found = sketches.merge_heavy(by_day, [], "user_id", most=50)
    exact = events.groupBy("user_id").agg(F.count("*").alias("exact"))
    total = F.lit(events.count())
    often = exact.where(F.col("exact") > total / 20).join(found, "user_id", "left")
    bounded = (F.col("n") <= F.col("exact")) & (F.col("exact") <= F.col("n") + total / 51)
    return often.select("user_id", "exact", F.coalesce(bounded, F.lit(False)).alias("bounded"))


@registered(
    "SELECT l_linenumber, count(*) AS n_rows, round(regr_slope(l_extendedprice, l_quantity) * sum(l_quantity) "
    "+ regr_intercept(l_extendedprice, l_quantity) * count(*), 0) > 0 AS positive, 'v1' AS model_version FROM lineitem GROUP BY l_linenumber"
)
def stored_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A model saved, loaded and scored: rows per line number, and whether its predictions add up to more than nothing."""
    lines = load_table(spark, folder, "lineitem").select("l_linenumber", "l_quantity", F.col("l_extendedprice").alias("label"))
    model = fit(chain(assembler(["l_quantity"]), linear_regression("features")), lines, ["features", "label"])
    path = fresh_path(spark, "model")
    save_model(model, path, lines, ["l_quantity"], version="v1", metrics={"rmse": model.stages[-1].summary.rootMeanSquaredError})
    scored = load_model(spark, path, "v1").score(lines)
    return scored.groupBy("l_linenumber", "model_version").agg(
        F.count("*").alias("n_rows"), (F.sum("prediction") > 0).alias("positive")
    )
