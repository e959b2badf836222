"""Whole workflows from CSV files, as a user runs them."""

import pytest
from pyspark.sql import functions as F

from tabfold.plans import (
    arrival_delay,
    classify,
    late_flights,
    segment_customers,
    tuned_regression,
    tweet_sentiment,
)
from tabfold.session import fresh_path
from tabfold.sources import CUSTOMER_FEATURES, CUSTOMERS, FLIGHTS, load_table


@pytest.fixture(scope="module")
def flights(spark, folder):
    """A flights file with the declared columns, derived from lineitem."""
    lines = load_table(spark, folder, "lineitem").select(
        (F.dayofmonth("l_shipdate")).alias("DayofMonth"),
        (F.dayofweek("l_shipdate")).alias("DayOfWeek"),
        F.concat("l_returnflag", "l_linestatus").alias("Carrier"),
        (10000 + F.col("l_suppkey")).cast("int").alias("OriginAirportID"),
        (10000 + F.col("l_partkey") % 40).cast("int").alias("DestAirportID"),
        (F.col("l_quantity") - 20).cast("int").alias("DepDelay"),
        (F.col("l_quantity") - 25 + F.col("l_tax") * 100).cast("int").alias("ArrDelay"),
    )
    assert lines.columns == FLIGHTS.fieldNames()
    path = fresh_path(spark, "flights")
    lines.write.option("header", True).csv(path)
    return path


def test_arrival_delay(spark, flights):
    tuned = arrival_delay(spark, flights, seed=3)
    assert tuned.predictions.columns == ["normFeatures", "prediction", "trueLabel"]
    assert tuned.metrics.count() == 4
    error = tuned.rmse.first()["rmse"]
    spread = tuned.predictions.agg(F.stddev("trueLabel")).first()[0]
    assert 0 < error < spread
    scores = [r["metric"] for r in tuned.metrics.orderBy("grid_index").collect()]
    assert tuned.best_index == scores.index(min(scores)) in (0, 2)
    line = tuned.model.stages[-1]
    best = tuned.metrics.where(F.col("grid_index") == tuned.best_index).first()
    assert line.getRegParam() == best["regParam"] and line.getMaxIter() == best["maxIter"]


def test_workflows_take_keys_and_reader_options(spark, tmp_path):
    names = "Id|DayofMonth|DayOfWeek|Carrier|OriginAirportID|DestAirportID|DepDelay|ArrDelay"
    rows = [f"{i}|{i % 28 + 1}|{i % 7 + 1}|C{i % 3}|{i % 11}|{i % 13}|{i % 50}|{i % 50 + i % 5}" for i in range(400)]
    path = tmp_path / "flights.csv"
    path.write_text("\n".join([names, *rows]) + "\n")
    schema = "Id INT NOT NULL, " + ", ".join(f"{f.name} {f.dataType.simpleString()} NOT NULL" for f in FLIGHTS.fields)
    options = dict(keys=["Id"], schema=schema, csv={"sep": "|"}, buckets=100)
    tuned = arrival_delay(spark, str(path), search="moments", rows_per_part=200, **options)
    assert tuned.rmse.first()["rmse"] < 3
    late = late_flights(spark, str(path), handle_invalid="keep", carry=["Id"], **options)
    assert late.predictions.columns == ["Id", "features", "prediction", "trueLabel"]
    with pytest.raises(ValueError, match="more than 2"):
        late_flights(spark, str(path), max_label_bytes=2, **options)
    tweets = tmp_path / "tweets.csv"
    tweets.write_text("Id;Sentiment;SentimentText\n" + "".join(f'{i};{i % 2};"good\n{"day" if i % 2 else "sad"} {i}"\n' for i in range(200)))
    mood = tweet_sentiment(spark, str(tweets), keys=["Id"], csv={"sep": ";", "multiLine": True}, size=4096, max_iter=30, tol=1e-9)
    scored = mood.predictions("Id")
    assert 30 < scored.count() < 100 and scored.where("prediction <> trueLabel").count() == 0


def test_both_searches_agree(spark, folder):
    data = load_table(spark, folder, "lineitem").withColumn("label", F.col("l_extendedprice"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    one, every = (
        tuned_regression(
            data, ["l_quantity", "l_discount"], keys=keys, search=search, parallelism=4
        )
        for search in ("moments", "general")
    )
    assert one.best_index == every.best_index
    assert [r["metric"] for r in one.metrics.orderBy("grid_index").collect()] == pytest.approx(
        [r["metric"] for r in every.metrics.orderBy("grid_index").collect()], rel=1e-9
    )
    assert one.rmse.first()["rmse"] == pytest.approx(every.rmse.first()["rmse"], rel=1e-9)


def test_late_flights(spark, flights):
    result = late_flights(spark, flights, seed=3, handle_invalid="keep")
    assert result.predictions.columns == ["features", "prediction", "trueLabel"]
    assert [type(s).__name__ for s in result.model.stages] == [
        "StringIndexerModel",
        "VectorAssembler",
        "VectorIndexerModel",
        "VectorAssembler",
        "MinMaxScalerModel",
        "VectorAssembler",
        "DecisionTreeClassificationModel",
    ]
    counts = {r["part"]: r["n_rows"] for r in result.holdout.counts().collect()}
    assert result.predictions.count() == counts["test"] < counts["train"]
    right = (F.col("prediction") == F.col("trueLabel")).cast("double")
    accuracy, share = result.predictions.agg(F.avg(right), F.avg("trueLabel")).first()
    assert accuracy >= max(share, 1 - share) - 0.02


def test_unseen_category_policies(spark):
    rows = [("a" if i % 2 else "b", i % 4, float(i), float(i % 2), i) for i in range(200)]
    known = spark.createDataFrame(rows, "name string, cat int, num double, label double, id int")
    odd = spark.createDataFrame([("z", 1, 1.0, 0.0, 7)], known.schema)
    result = classify(known, "name", ["cat"], ["num"], keys=["id"])
    unseen = odd.withColumnRenamed("label", "trueLabel")
    with pytest.raises(Exception, match="Unseen label"):
        result.model.transform(unseen).collect()
    keep = classify(known, "name", ["cat"], ["num"], keys=["id"], handle_invalid="keep")
    assert keep.model.transform(unseen).count() == 1
    skip = classify(known, "name", ["cat"], ["num"], keys=["id"], handle_invalid="skip")
    assert skip.model.transform(unseen).count() == 0


def test_segment_customers(spark, folder):
    customers = load_table(spark, folder, "customer")
    picked = {
        "CustomerName": F.col("c_name"),
        "IncomeRange": ((F.col("c_custkey") % 5 + 1) * 25000).cast("int"),
    }
    for i, name in enumerate(CUSTOMER_FEATURES, start=2):
        picked.setdefault(name, (F.col("c_custkey") % i).cast("int"))
    path = fresh_path(spark, "customers")
    rows = customers.select(*[picked[f].alias(f) for f in CUSTOMERS.fieldNames()])
    rows.write.option("header", True).csv(path)
    declared = segment_customers(spark, path, schema=CUSTOMERS, seed=0, ks=[5])
    assert declared.centers.count() == 5 * 10
    found = segment_customers(spark, path, seed=0, parallelism=5)
    assert found.sweep.scores.count() == 5
    assert found.best.first()["k"] == 5 and found.best.first()["silhouette"] > 0.99999
    assert found.centers.count() == 5 * 10
    assert found.profile().agg(F.sum("n_rows")).first()[0] == customers.count()
    shown = found.examples(["CustomerName"]).groupBy("prediction").count().collect()
    assert [r["count"] for r in shown] == [10] * 5


def test_tweet_sentiment(spark, tmp_path):
    good, bad = "what a LOVELY great happy day", "awful ""sad"", terrible, gloomy day"
    lines = ["ItemID,Sentiment,SentimentText"]
    for i in range(300):
        text = (good if i % 2 else bad) + f" number{i}"
        lines.append(f'{i},{i % 2},"{text}"')
    path = tmp_path / "tweets.csv"
    path.write_text("\n".join(lines) + "\n")
    inferred = tweet_sentiment(spark, str(path), seed=1, size=64, infer=True)
    assert inferred.holdout.train.count() + inferred.holdout.test.count() == 300
    result = tweet_sentiment(spark, str(path), seed=1, size=4096)
    scored = result.predictions("SentimentText")
    assert scored.columns == ["SentimentText", "prediction", "trueLabel"]
    assert scored.where("prediction <> trueLabel").count() == 0
    assert {"SentimentWords", "MeaningfulWords", "features", "rawPrediction"} <= set(
        result.scored.columns
    )
    for r in result.scored.select("probability", "prediction").collect():
        p = r["probability"].toArray()
        assert p.sum() == pytest.approx(1.0) and r["prediction"] == float(p[1] > 0.5)
    assert [type(s).__name__ for s in result.model.stages] == [
        "Tokenizer",
        "StopWordsRemover",
        "HashingTF",
        "LogisticRegressionModel",
    ]
