import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tabfold.operators import features as op
from tabfold.operators.positions import with_position


def test_assemble_order_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.5, 3), (4, None, 6)], "a int, b double, c long")
    with pytest.raises(Exception):
        op.assemble(df, ["a", "b"]).select("features").collect()
    kept = op.assemble(df, ["c", "a", "b"], handle_invalid="skip")
    assert kept.first()["features"].toArray().tolist() == [3.0, 1.0, 2.5]
    nan = op.assemble(df, ["b"], handle_invalid="keep").where("a = 4").first()["features"]
    assert nan[0] != nan[0]


def test_assemble_rejects_text_columns(spark):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(Exception, match="not supported"):
        op.assemble(df, ["a"])


def test_vectors_are_joined_in_order(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    both = op.assemble(op.assemble(df, ["b", "c"], "right"), ["a"], "left")
    joined = op.assemble(both, ["left", "right"])
    assert joined.first()["features"].toArray().tolist() == [1.0, 2.0, 3.0]
    flat = op.vector_columns(joined.select("features"), "features", ["x", "y", "z"])
    assert tuple(flat.first()) == (1.0, 2.0, 3.0)


def test_minmax_uses_the_training_range(spark):
    train = spark.createDataFrame([(0.0, 3.0), (10.0, 3.0)], "x double, k double")
    test = spark.createDataFrame([(5.0, 3.0), (20.0, 9.0), (None, None)], "x double, k double")
    ranges = op.fit_minmax(train, ["x", "k"])
    assert ranges == {"x": (0.0, 10.0), "k": (3.0, 3.0)}
    got = op.minmax_columns(test, ranges).select("x_scaled", "k_scaled").collect()
    assert [tuple(r) for r in got] == [(0.5, 0.5), (2.0, 0.5), (None, None)]


def test_minmax_columns_equal_the_ml_scaler(spark):
    df = spark.range(200).select(
        (F.col("id") * 1.7 - 31).alias("x"), F.sin("id").alias("y"), F.lit(3.0).alias("k")
    )
    vectors = op.assemble(df, ["x", "y", "k"])
    scaled = op.minmax_scaler("features").fit(vectors).transform(vectors)
    plain = op.minmax_columns(scaled, op.fit_minmax(df, ["x", "y", "k"]))
    for r in plain.collect():
        assert r["scaled"].toArray().tolist() == pytest.approx(
            [r["x_scaled"], r["y_scaled"], r["k_scaled"]], abs=1e-12
        )


def test_string_labels_by_frequency_then_name(spark):
    df = spark.createDataFrame([(k,) for k in "bacccdd"] + [("d",), (None,)], "k string")
    rows = op.string_labels(df, "k").orderBy("index").collect()
    assert [(r["label"], r["n"], r["index"]) for r in rows] == [
        ("c", 3, 0),
        ("d", 3, 1),
        ("a", 1, 2),
        ("b", 1, 3),
    ]


@pytest.mark.parametrize("small", [True, False])
def test_index_strings_equals_the_ml_indexer(spark, small, monkeypatch):
    if not small:  # the way beyond the broadcast bound
        monkeypatch.setattr(op, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(op, "HOT_LABELS", 2)
    # One label on a third of the rows, many rare ones.
    df = spark.range(900).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise(F.concat(F.lit("v"), (F.col("id") % 97).cast("string")))
        .alias("k"),
    )
    got = op.index_strings(df, "k", op.string_labels(df, "k"), "idx")
    ml = StringIndexer(inputCol="k", outputCol="want").fit(df).transform(got)
    assert ml.count() == 900
    assert ml.where(F.col("idx") != F.col("want")).count() == 0


@pytest.mark.parametrize("bound", [op.BROADCAST_BYTES, 0])
def test_unseen_strings(spark, bound, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_BYTES", bound)
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    labels = op.string_labels(train, "k")
    with pytest.raises(Exception, match="unseen value in k: "):
        op.index_strings(test, "k", labels, "i").collect()
    skipped = op.index_strings(test, "k", labels, "i", "skip").collect()
    assert [(r["k"], r["i"]) for r in skipped] == [("a", 1.0)]
    kept = op.index_strings(test, "k", labels, "i", "keep").collect()
    assert {(r["k"], r["i"]) for r in kept} == {("a", 1.0), ("z", 2.0), (None, 2.0)}
    with pytest.raises(ValueError):
        op.index_strings(test, "k", labels, "i", "drop")


def test_categories_zero_first_and_wide_columns_stay(spark):
    df = spark.range(60).select(
        (F.col("id") % 3 - 1).cast("double").alias("a"),
        (F.col("id") % 21).cast("double").alias("wide"),
        (F.col("id") % 20 + 5).cast("int").alias("edge"),
    )
    maps = op.category_maps(df, ["a", "wide", "edge"])
    assert maps["a"] == {0.0: 0, -1.0: 1, 1.0: 2}
    assert "wide" not in maps
    assert maps["edge"] == {float(v): v - 5 for v in range(5, 25)}
    got = op.index_categories(df, ["a", "wide", "edge"], maps)
    assert got.where("wide_cat <> wide or edge_cat <> edge - 5").count() == 0
    vectors = op.assemble(got, ["a", "wide", "edge"], "v")
    ml = op.category_indexer("v", "w").fit(vectors).transform(vectors)
    for r in ml.collect():
        assert r["w"].toArray().tolist() == [r["a_cat"], r["wide_cat"], r["edge_cat"]]


def test_unseen_categories_and_negative_zero(spark):
    maps = {"a": {0.0: 0, 2.0: 1}}
    df = spark.createDataFrame([(-0.0,), (2.0,), (7.0,)], "a double")
    with pytest.raises(Exception, match="unseen value in a: 7.0"):
        op.index_categories(df, ["a"], maps).collect()
    skip = op.index_categories(df, ["a"], maps, handle_invalid="skip")
    assert [r["a_cat"] for r in skip.collect()] == [0.0, 1.0]
    keep = op.index_categories(df, ["a"], maps, handle_invalid="keep")
    assert [r["a_cat"] for r in keep.collect()] == [0.0, 1.0, 2.0]


def test_positions_span_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(16)
    got = with_position(df, [F.desc("v")])
    assert got.where(F.col("position") != 4999 - F.col("v")).count() == 0
    assert got.count() == 5000
