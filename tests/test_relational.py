import pytest
from pyspark.sql import functions as F

from tabfold.functions import cast_label, threshold_label
from tabfold.operators import relational as op


@pytest.fixture(scope="module")
def delays(spark):
    return spark.createDataFrame([(14,), (15,), (16,), (-8,), (None,)], "v int")


def test_threshold_is_strict_and_keeps_null(delays):
    got = op.project(delays, "v", label=threshold_label("v", 15))
    assert dict(got.dtypes)["label"] == "double"
    assert {r["v"]: r["label"] for r in got.collect()} == {
        14: 0.0,
        15: 0.0,
        16: 1.0,
        -8: 0.0,
        None: None,
    }


def test_bad_label_text(spark):
    df = spark.createDataFrame(
        [("x",), ("",), ("2.0",), (" 7 ",), ("-1",), ("12x",), (None,)], "s string"
    )
    got = df.select("s", cast_label("s", "null").alias("i")).collect()
    assert {r["s"]: r["i"] for r in got} == {
        "x": None,
        "": None,
        "2.0": None,
        " 7 ": 7,
        "-1": -1,
        "12x": None,
        None: None,
    }
    plain = df.select("s", F.col("s").try_cast("int").alias("i")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, plain), key=repr)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(cast_label("s")).collect()
    with pytest.raises(ValueError):
        cast_label("s", "ignore")


def test_project_and_rename(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert op.project(df, "a", F.col("b"), c="b").columns == ["a", "b", "c"]
    assert op.project(df, "*").columns == ["a", "b"]
    assert op.rename(df, "a", "x").columns == ["x", "b"]
    with pytest.raises(ValueError):
        op.rename(df, "missing", "x")


def test_filter_equals(spark):
    df = spark.createDataFrame([(1, "a"), (2, "o'b"), (None, "a")], "k int, s string")
    assert op.filter_equals(df, "k", 1).count() == 1
    assert op.filter_equals(df, "s", "o'b").first()["k"] == 2


def test_preview_is_ordered(spark):
    df = spark.range(100).repartition(5)
    assert [r["id"] for r in op.preview(df, 3, [F.desc("id")]).collect()] == [99, 98, 97]


@pytest.mark.parametrize("n", [2, 3000])
def test_rows_per_group_with_a_hot_group(spark, n):
    # Two thirds of the rows lie in group 0, some of them equal in all columns.
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7).alias("g"),
        (F.col("id") / 2).cast("int").alias("v"),
    )
    got = op.rows_per_group(df, "g", n, ["v"]).groupBy("g").agg(F.max("rn").alias("top"), F.count("*").alias("n"))
    sizes = {r["g"]: r["count"] for r in df.groupBy("g").count().collect()}
    assert {r["g"]: r["n"] for r in got.collect()} == {g: min(n, s) for g, s in sizes.items()}
    assert all(r["top"] == r["n"] for r in got.collect())
    first = op.rows_per_group(df, "g", n, ["v"]).where("g = 0 and rn = 1").first()
    assert first["v"] == 0


def test_rows_per_group_of_equal_rows_and_null_groups(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(1).alias("g"), F.lit(7).alias("v")
    )
    got = op.rows_per_group(df, "g", 1500, ["v"])
    rows = got.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("rn").alias("d")).collect()
    assert {(r["g"], r["n"], r["d"]) for r in rows} == {(None, 1500, 1500), (1, 1500, 1500)}
    assert got.columns == ["g", "v", "rn"]


def test_rows_per_group_is_one_plan_for_every_limit(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), (F.col("id") % 5).alias("v"), "id")
    few, more = (op.rows_per_group(df, "g", n, ["v"]) for n in (999, 1001))
    assert sorted(few.collect()) == sorted(more.where("rn <= 999").collect())
    moved = op.rows_per_group(df.repartition(7, "id"), "g", 999, ["v"])
    assert sorted(few.collect()) == sorted(moved.collect())


def test_schema_table_and_null_counts(delays):
    df = delays.withColumn("s", F.lit("a"))
    rows = op.schema_table(df).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [(1, "v", "int", True), (2, "s", "string", False)]
    assert {tuple(r) for r in op.null_counts(df).collect()} == {("v", 1), ("s", 0)}


def test_row_count(delays):
    assert op.row_count(delays).first()["n_rows"] == 5
