"""Grouping sets, pivots, sketches and stored models."""

import contextlib
import io
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabfold.operators import sketches
from tabfold.operators.features import assembler
from tabfold.operators.grouping import cube_sets, grouping_sets, pivot_found, rollup_sets
from tabfold.operators.models import chain, fit, linear_regression
from tabfold.operators.stored import load_model, save_model

WANTED = {"n": ("count", "*"), "k": ("count", "x"), "s": ("sum", "x"), "low": ("min", "x"), "high": ("max", "x"), "m": ("avg", "x")}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows(spark):
    text = F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), F.col("id") % 5))
    return spark.range(600).select("id", text.alias("a"), (F.col("id") % 3).alias("b"), F.when(F.col("id") % 4 > 0, F.col("id")).alias("x"))


@pytest.mark.parametrize("how", ["cube", "rollup"])
def test_sets_equal_expanded_rows(rows, how):
    wanted = getattr(rows, how)("a", "b").agg(
        F.count("*").alias("n"), F.count("x").alias("k"), F.sum("x").alias("s"), F.min("x").alias("low"), F.max("x").alias("high"),
        F.avg("x").alias("m"), F.grouping_id().cast("int").alias("grouping"),
    )
    sets = (cube_sets if how == "cube" else rollup_sets)(["a", "b"])
    assert rows_of(grouping_sets(rows, sets, WANTED)) == rows_of(wanted)


def test_sets_of_no_rows_and_sets_given_by_hand(rows):
    found = grouping_sets(rows.limit(0), rollup_sets(["a"]), WANTED)
    assert rows_of(found) == [(None, 0, 0, None, None, None, None, 1)]
    found = grouping_sets(rows, [["a"], ["b"]], {"n": ("count", "*")})
    assert found.where("grouping = 1").count() == 6 and found.where("grouping = 2").count() == 3
    with pytest.raises(ValueError):
        grouping_sets(rows, [["a"]], {"d": ("distinct", "x")})


def test_base_rows_are_read_and_shuffled_once(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/rows")
    found = grouping_sets(spark.read.parquet(f"{tmp_path}/rows"), cube_sets(["a", "b"]), WANTED)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        found.explain()
    # All sets are made from the finest one, which is written.
    assert "FileScan" not in text.getvalue() and "Expand" not in text.getvalue()


def test_pivot_discovers_columns_and_keeps_the_rest(rows):
    found = pivot_found(rows, ["b"], "a", "x", most=2)
    counts = Counter(r.a for r in rows.collect() if r.a is not None)
    names = sorted(sorted(counts, key=lambda v: (-counts[v], v))[:2])
    assert found.columns == ["b", *names, "other"]
    totals = {r.b: r.s for r in rows.groupBy("b").agg(F.sum("x").alias("s")).collect()}
    assert {r.b: sum(r[c] or 0 for c in found.columns[1:]) for r in found.collect()} == totals
    whole = pivot_found(rows, ["b"], "a", "x")
    assert whole.columns == ["b", *sorted(counts), "other"]
    with pytest.raises(ValueError):
        pivot_found(rows.withColumn("a", F.lit("b")), ["b"], "a", "x")


def test_merged_distinct_sketches_are_those_of_all_rows(spark):
    df = spark.range(60000).select((F.col("id") % 6).alias("g"), (F.col("id") % 23456).alias("v"))
    parts = sketches.distinct_sketch(df, ["g"], "v")
    assert rows_of(sketches.merge_distinct(parts, [])) == rows_of(sketches.distinct_sketch(df, [], "v"))
    for n in (1, 50, 3000, 23456):
        found = sketches.distinct_estimate(sketches.distinct_sketch(df.where(F.col("v") < n), ["g"], "v"), []).first()[0]
        assert abs(found - n) <= max(1, 4 * 1.04 / 64 * n)
    assert sketches.distinct_estimate(sketches.distinct_sketch(df.where("v < 0"), ["g"], "v"), ["g"]).collect() == []


def test_quantiles_are_within_the_error_of_the_value_of_their_rank(spark):
    value = F.when(F.col("id") % 10 == 0, 0.0).otherwise((F.col("id") - 3000) * F.exp(F.col("id") / 400.0))
    df = spark.range(9000).select((F.col("id") % 4).alias("g"), F.when(F.col("id") % 11 > 0, value).alias("v"))
    df = df.unionAll(spark.createDataFrame([(0, float("nan"))], "g long, v double"))
    values = sorted(r.v for r in df.collect() if r.v is not None and r.v == r.v)
    sketch = sketches.quantile_sketch(df, ["g"], "v", error=0.02)
    shares = [0.0, 0.001, 0.2, 0.33, 0.5, 0.9, 1.0]
    for row in sketches.quantile_estimate(sketch, [], shares, error=0.02).collect():
        exact = values[max(1, -int(-row.share * len(values) // 1)) - 1]
        assert abs(row.estimate - exact) <= 0.02 * abs(exact) * (1 + 1e-9)
    assert sketch.count() < 9000 / 2


@pytest.mark.parametrize("most", [3, 20])
def test_heavy_values_are_kept_within_the_bound(spark, most):
    df = spark.range(20000).select((F.col("id") % 5).alias("g"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") * 7919 % F.sqrt("id")).cast("long").alias("v"))
    exact = Counter(r.v for r in df.collect() if r.v is not None)
    total = sum(exact.values())
    merged = sketches.merge_heavy(sketches.heavy_sketch(df, ["g"], "v", most=most), [], "v", most=most)
    found = {r.v: r.n for r in merged.collect()}
    assert 0 < len(found) <= most
    assert all(found.get(v, 0) <= n <= found.get(v, 0) + total / (most + 1) for v, n in exact.items())
    assert {v for v, n in exact.items() if n > total / (most + 1)} <= set(found)


def test_a_stored_model_scores_alike_and_refuses_other_columns(spark, tmp_path):
    train = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("label"), F.lit("k").alias("key"))
    model = fit(chain(assembler(["x"]), linear_regression("features")), train, ["features", "label"])
    save_model(model, str(tmp_path), train, ["x"], version="v7", metrics={"rmse": 0.0})
    stored = load_model(spark, str(tmp_path), "v7")
    scored = stored.score(train)
    assert stored.metrics == {"rmse": 0.0} and stored.inputs == {"x": "double"}
    assert rows_of(scored.select("x", "prediction")) == rows_of(model.transform(train).select("x", "prediction"))
    assert {r.model_version for r in scored.collect()} == {"v7"}
    for wrong in (train.drop("x"), train.withColumn("x", F.col("x").cast("int"))):
        with pytest.raises(ValueError, match="differ"):
            stored.score(wrong)
    # A version is written once.
    with pytest.raises(Exception):
        save_model(model, str(tmp_path), train, ["x"], version="v7")
