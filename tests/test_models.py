import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tabfold.functions import threshold_label
from tabfold.operators.features import assemble, assembler, minmax_scaler
from tabfold.operators.metrics import rmse, rmse_evaluator
from tabfold.operators.models import (
    chain,
    coefficients,
    decision_tree,
    fit,
    linear_regression,
    logistic_regression,
    score,
)
from tabfold.sources import load_table

POINTS = [(1.0, 2.0), (2.0, 3.5), (3.0, 3.9), (5.0, 9.0), (8.0, 9.5)]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(POINTS, "x double, label double")


@pytest.fixture(scope="module")
def lines(spark, folder):
    return load_table(spark, folder, "lineitem").select(
        "l_quantity", "l_linenumber", "l_discount", F.col("l_extendedprice").alias("price")
    )


@pytest.mark.parametrize(
    "penalty, slope", [(0.0, 1.1584415584), (0.3, 1.0552198692), (0.01, 1.1546765402)]
)
def test_linear_regression_by_hand(spark, points, penalty, slope):
    vectors = assemble(points, ["x"])
    model = linear_regression(regParam=penalty).fit(vectors)
    table = {r["term"]: r["value"] for r in coefficients(spark, model, ["x"]).collect()}
    with pytest.raises(ValueError):
        coefficients(spark, model, ["x", "y"])
    assert table["x"] == pytest.approx(slope, abs=1e-9)
    assert table["intercept"] == pytest.approx(27.9 / 5 - slope * 19 / 5, abs=1e-8)


def test_scaling_does_not_change_predictions(points):
    plain = assembler(["x"])
    scale = minmax_scaler("features", "s")
    a = fit(chain(plain, linear_regression(regParam=0.3)), points, ["features", "label"])
    b = fit(chain(plain, scale, linear_regression("s", regParam=0.3)), points, ["features", "label"])
    got = [
        [r["prediction"] for r in m.transform(points).orderBy("x").collect()] for m in (a, b)
    ]
    assert got[0] == pytest.approx(got[1], abs=1e-9)


def test_rmse_formula_equals_the_evaluator(points):
    df = points.withColumn("prediction", F.col("x") * 1.2 + 1)
    want = RegressionEvaluator(metricName="rmse").evaluate(df)
    assert rmse(df).first()["rmse"] == pytest.approx(want, rel=1e-12)
    assert rmse_evaluator().evaluate(df) == want
    named = df.withColumnRenamed("label", "trueLabel")
    assert rmse(named, "trueLabel").first()["rmse"] == pytest.approx(want, rel=1e-12)


def test_fit_runs_leading_stages_once_and_scores_raw_rows(spark, lines):
    steps = chain(
        assembler(["l_quantity", "l_linenumber"]),
        minmax_scaler("features", "s"),
        linear_regression("s", "price"),
    )
    model = fit(steps, lines, ["features", "price"])
    assert [type(s).__name__ for s in model.stages] == [
        "VectorAssembler",
        "MinMaxScalerModel",
        "LinearRegressionModel",
    ]
    assert score(model, lines, "prediction", "price").count() == lines.count()
    assert "s" in score(model, lines).columns
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_tree_beats_the_majority_and_keeps_rows(lines):
    data = lines.withColumn("label", threshold_label("price", 45000))
    steps = chain(assembler(["l_quantity", "l_linenumber"]), decision_tree())
    scored = fit(steps, data, ["features", "label"]).transform(data)
    share = data.agg(F.avg("label")).first()[0]
    right = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert right >= max(share, 1 - share)
    assert scored.count() == data.count()
    assert {r[0] for r in scored.select("prediction").distinct().collect()} <= {0.0, 1.0}


def test_logistic_probabilities_and_threshold(lines):
    data = lines.withColumn("label", threshold_label("price", 45000))
    steps = chain(assembler(["l_quantity"]), logistic_regression(maxIter=10, regParam=0.01))
    scored = fit(steps, data, ["features", "label"]).transform(data)
    for r in scored.select("probability", "prediction").limit(300).collect():
        p = r["probability"].toArray()
        assert p.sum() == pytest.approx(1.0)
        assert r["prediction"] == float(p[1] > 0.5)
