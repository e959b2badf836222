import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfold.catalogue import QUERIES
from tabfold.operators.features import assembler, minmax_scaler
from tabfold.operators.metrics import rmse, rmse_evaluator
from tabfold.operators.models import chain, linear_regression
from tabfold.operators.moments import Moments, moments_table, predict, ridge_search, solve
from tabfold.operators.tuning import best_row, cross_validate, cross_validate_ridge, grid
from tabfold.sources import load_table

FEATURES = ["l_quantity", "l_linenumber", "l_discount", "l_suppkey"]


@pytest.fixture(scope="module")
def train(spark, folder):
    return (
        load_table(spark, folder, "lineitem")
        .select(*FEATURES, F.col("l_extendedprice").alias("label"))
        .withColumn("fold", F.pmod(F.hash("l_suppkey", "label"), F.lit(3)))
    )


@pytest.fixture(scope="module")
def searched(train):
    stages = assembler(FEATURES), minmax_scaler("features", "s")
    line = linear_regression("s")
    return cross_validate(
        train,
        chain(*stages, line),
        rmse_evaluator(),
        grid([(line.regParam, [300.0, 0.01]), (line.maxIter, [10, 5])]),
        folds=3,
        seed=1,
        fold_column="fold",
        parallelism=4,
    )


def test_grid_order(spark):
    line = linear_regression()
    points = grid([(line.regParam, [0.3, 0.01]), (line.maxIter, [10, 5])])
    assert [(p[line.regParam], p[line.maxIter]) for p in points] == [
        (0.3, 10),
        (0.3, 5),
        (0.01, 10),
        (0.01, 5),
    ]


def test_iteration_limit_ties_and_the_first_wins(searched):
    rows = searched.metrics.orderBy("grid_index").collect()
    assert [(r["regParam"], r["maxIter"]) for r in rows] == [
        (300.0, 10.0),
        (300.0, 5.0),
        (0.01, 10.0),
        (0.01, 5.0),
    ]
    assert rows[0]["metric"] == rows[1]["metric"] and rows[2]["metric"] == rows[3]["metric"]
    best = min(rows, key=lambda r: (r["metric"], r["grid_index"]))
    assert searched.best_index == best["grid_index"] in (0, 2)


def test_one_pass_search_equals_the_general_one(train, searched):
    found = ridge_search(train, FEATURES, "label", "fold", [300.0, 0.01], folds=3)
    general = searched.metrics.where("maxIter = 10").orderBy("grid_index").collect()
    assert found.scores == pytest.approx([r["metric"] for r in general], rel=1e-9)
    one = predict(train, found.best, FEATURES, "p1")
    both = searched.best_model.transform(one)
    assert both.agg(F.max(F.abs(F.col("p1") - F.col("prediction")))).first()[0] < 1e-5
    assert found.metrics.count() == 2 and found.coefficients.count() == len(FEATURES) + 1


def test_random_folds_need_only_a_seed(train):
    line = linear_regression()
    found = cross_validate(
        train.drop("fold"),
        chain(assembler(FEATURES), line),
        rmse_evaluator(),
        grid([(line.regParam, [0.3, 0.01])]),
        folds=2,
        seed=3,
    )
    assert found.metrics.count() == 2


def test_moments_merge_exactly(train):
    parts = moments_table(train, FEATURES, "label", "fold").collect(3)
    assert len(parts) == 3
    whole = Moments.union(parts)
    data = np.array(train.drop("fold").collect(), dtype=float)
    assert whole.n == len(data)
    assert whole.mean == pytest.approx(data.mean(axis=0))
    assert whole.cov == pytest.approx(np.cov(data.T, bias=True), rel=1e-9, abs=1e-9)


def test_error_from_moments_is_the_error_of_the_rows(train):
    parts = moments_table(train, FEATURES, "label", "fold").collect(3)
    fitted = solve(Moments.union(parts[1:]), 0.3)
    held_out = predict(train.where("fold = 0"), fitted, FEATURES)
    assert fitted.rmse(parts[0]) == pytest.approx(rmse(held_out).first()["rmse"], rel=1e-10)


def test_one_pass_is_one_grouped_aggregate(train, capsys):
    moments_table(train, FEATURES, "label", "fold").rows.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    assert "BatchEvalPython" not in plan


def test_constant_columns_and_labels(spark):
    df = spark.createDataFrame(
        [(float(i), 3.0, 2.0 * i + 1, i % 2) for i in range(10)],
        "x double, k double, label double, fold int",
    )
    best = ridge_search(df, ["x", "k"], "label", "fold", [0.0], folds=2).best
    assert best.weights.tolist() == pytest.approx([2.0, 0.0])
    assert best.intercept == pytest.approx(1.0)
    flat = ridge_search(df, ["x"], "k", "fold", [0.3], folds=2).best
    assert flat.weights.tolist() == [0.0] and flat.intercept == 3.0


def test_collinear_columns_get_the_least_weights(spark):
    df = spark.createDataFrame(
        [(float(i), float(i), 3.0 * i + (i % 3) * 0.01, i % 2) for i in range(30)], "x double, y double, label double, fold int"
    )
    best = ridge_search(df, ["x", "y"], "label", "fold", [0.0], folds=2).best
    model = linear_regression().fit(assembler(["x", "y"]).transform(df))
    assert best.weights.tolist() == pytest.approx(list(model.coefficients), rel=1e-6)
    assert best.intercept == pytest.approx(model.intercept, abs=1e-6)


def test_grid_values_of_any_kind_and_checked_before_fitting(train):
    line = linear_regression()
    steps = chain(assembler(FEATURES), line)
    points = grid([(line.solver, ["normal", "auto"]), (line.regParam, [0.3])])
    found = cross_validate(train, steps, rmse_evaluator(), points, folds=3, seed=1, fold_column="fold")
    rows = found.metrics.orderBy("grid_index").collect()
    assert [(r.solver, r.regParam) for r in rows] == [("normal", 0.3), ("auto", 0.3)]
    uneven = [{line.regParam: 0.1}, {line.maxIter: 5}]
    with pytest.raises(ValueError, match="different parameters"):
        cross_validate(None, steps, rmse_evaluator(), uneven, folds=2, seed=1)


def test_one_pass_refuses_nulls_and_wrong_folds(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0), (None, 2.0, 1)], "x double, label double, fold int")
    with pytest.raises(Exception, match="null in required column x"):
        ridge_search(df, ["x"], "label", "fold", [0.1], folds=2)
    with pytest.raises(ValueError, match="fewer than 2"):
        ridge_search(df.where("fold = 0"), ["x"], "label", "fold", [0.1], folds=2)
    ids = spark.range(50).selectExpr("id as x", "id as label", "id as fold")
    with pytest.raises(ValueError, match="more than 2"):
        ridge_search(ids, ["x"], "label", "fold", [0.1], folds=2)


def test_best_row_breaks_ties_by_the_smallest(spark):
    df = spark.createDataFrame([(2, 0.5), (3, 0.9), (4, 0.9)], "k int, m double")
    assert best_row(df, "m", larger=True, tie="k").first()["k"] == 3
    assert best_row(df, "m", larger=False, tie="k").first()["k"] == 2


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["flight_like_regression", "cv_metrics", "cv_best"])
def test_searches_of_a_closed_form_pass_over_their_rows_a_few_times(spark, folder, name):
    assert jobs_of(spark, name, lambda: QUERIES[name](spark, folder).collect()) <= 20


def test_closed_form_search_equals_the_general_one_with_its_model(train, searched):
    line = linear_regression("s")
    points = grid([(line.regParam, [300.0, 0.01]), (line.maxIter, [10, 5])])
    steps = chain(assembler(FEATURES), minmax_scaler("features", "s"), line)
    found = cross_validate_ridge(train, FEATURES, steps, points, folds=3, fold_column="fold")
    assert found.metrics.schema == searched.metrics.schema and found.best_index == searched.best_index
    one, general = ([tuple(r) for r in s.metrics.orderBy("grid_index").collect()] for s in (found, searched))
    assert [r[:3] for r in one] == [r[:3] for r in general]
    assert [r[3] for r in one] == pytest.approx([r[3] for r in general], rel=1e-9)
    fits = [s.best_model.stages[-1] for s in (found, searched)]
    assert list(fits[0].coefficients) == pytest.approx(list(fits[1].coefficients), rel=1e-9)
    assert fits[0].getRegParam() == fits[1].getRegParam() and fits[0].getMaxIter() == fits[1].getMaxIter()


def test_closed_form_search_refuses_what_has_none(train):
    def search(line, axes):
        steps = chain(assembler(FEATURES), line)
        return cross_validate_ridge(train, FEATURES, steps, grid(axes(line)), folds=3, fold_column="fold")

    for odd in ({"elasticNetParam": 0.5}, {"solver": "l-bfgs"}, {"fitIntercept": False}):
        with pytest.raises(ValueError, match="no linear regression with a closed form"):
            search(linear_regression(**odd), lambda line: [(line.regParam, [0.3])])
    with pytest.raises(ValueError, match="only penalty and iteration limit"):
        search(linear_regression(), lambda line: [(line.elasticNetParam, [0.0, 0.5])])
