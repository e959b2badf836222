import hashlib

import pytest
from pyspark.sql import functions as F

from tabfold.operators.splits import hash_fold, hash_part, hash_split, random_split, with_hash_fold
from tabfold.plans.holdout import hold_out


def bucket(key, n, draw=0):
    return int(hashlib.md5(key.encode()).hexdigest()[8 * draw : 8 * draw + 8], 16) % n


def test_hash_split_follows_the_key_alone(spark):
    df = spark.range(2000).withColumn("other", F.rand())
    train, test = hash_split(df, ["id"], [0.7, 0.3])
    want = {i for i in range(2000) if bucket(str(i), 10) < 7}
    assert {r["id"] for r in train.collect()} == want
    assert {r["id"] for r in test.collect()} == set(range(2000)) - want
    moved, _ = hash_split(df.repartition(13), ["id"], [0.7, 0.3])
    assert {r["id"] for r in moved.collect()} == want


def test_hash_split_joins_keys_and_takes_finer_weights(spark):
    df = spark.createDataFrame([(i, f"k{i % 3}") for i in range(300)], "a int, b string")
    parts = hash_split(df, ["a", "b"], [1, 1, 2], buckets=100)
    counts = [p.count() for p in parts]
    assert sum(counts) == 300 and counts[2] > max(counts[:2])
    assert {(r["a"]) for r in parts[0].collect()} == {
        i for i in range(300) if bucket(f"{i}-k{i % 3}", 100) < 25
    }
    numbered = df.withColumn("part", hash_part(["a", "b"], [1, 1, 2], buckets=100))
    assert [numbered.where(F.col("part") == i).count() for i in range(3)] == counts
    with pytest.raises(ValueError):
        hash_split(df, ["a"], [0.75, 0.25])


def test_folds_are_independent_of_the_split(spark):
    df = with_hash_fold(spark.range(5000), ["id"], 2)
    train, _ = hash_split(df, ["id"], [0.7, 0.3])
    share = train.agg(F.avg("fold")).first()[0]
    assert 0.46 < share < 0.54
    row = spark.range(1).select(hash_fold(["id"], 5).alias("f")).first()
    assert row["f"] == bucket("0", 5, draw=1)


def test_random_split_is_whole_and_seeded(spark):
    df = spark.range(4000)
    parts = random_split(df, [0.7, 0.3], 5)
    ids = [{r["id"] for r in p.collect()} for p in parts]
    assert not ids[0] & ids[1] and ids[0] | ids[1] == set(range(4000))
    assert 2600 < len(ids[0]) < 3000
    again = random_split(df, [0.7, 0.3], 5)
    assert {r["id"] for r in again[0].collect()} == ids[0]


def test_random_parts_are_filters_without_a_sort(spark, capsys):
    for part in random_split(spark.range(100).withColumn("v", F.lit("x")), [1, 1, 2], 5):
        part.select("id").explain()
        plan = capsys.readouterr().out
        assert "Sort" not in plan and "Exchange" not in plan and "ReadSchema: struct<id:bigint,_draw:double>" in plan


def test_keys_that_look_alike_are_told_apart_and_null_keys_refused(spark):
    pairs = [("1-2", "3"), ("1", "2-3"), ("1\\", "-2-3"), ("1", "\\2-3")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert len({r.f for r in df.select(hash_fold(["a", "b"], 1 << 30).alias("f")).collect()}) == 4
    for keys in (["a"], ["a", "b"]):
        with pytest.raises(Exception, match="null in key column a"):
            hash_split(spark.createDataFrame([(None, "x")], "a string, b string"), keys, [1, 1])[0].collect()


def test_hold_out_takes_finer_weights(spark):
    df = spark.range(2000).withColumn("label", F.lit(1.0))
    parts = hold_out(df, keys=["id"], weights=(0.75, 0.25), buckets=100)
    assert {r["id"] for r in parts.train.collect()} == {i for i in range(2000) if bucket(str(i), 100) < 75}


def test_hold_out_renames_the_test_label_and_counts(spark):
    df = spark.range(1000).withColumn("label", F.lit(1.0))
    parts = hold_out(df, keys=["id"])
    assert "label" in parts.train.columns and "trueLabel" in parts.test.columns
    counts = {r["part"]: r["n_rows"] for r in parts.counts().collect()}
    assert counts == {"train": parts.train.count(), "test": parts.test.count()}
    drawn = hold_out(df, seed=2)
    counts = {r["part"]: r["n_rows"] for r in drawn.counts().collect()}
    assert counts == {"train": drawn.train.count(), "test": drawn.test.count()}
    with pytest.raises(ValueError):
        hold_out(df)
    with pytest.raises(ValueError):
        hold_out(df, keys=["id"], seed=1)
