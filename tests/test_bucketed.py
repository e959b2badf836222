import pytest
from pyspark.sql import functions as F

from tabfold.session import fresh_path
from tabfold.sources import bucketed_join, bucketed_table, buckets_for

DDL = "day int, `key` long, `odd name` string"


def rows(spark, days, keys=range(40), note="a"):
    return spark.createDataFrame([(d, k, f"{note}{k}") for d in days for k in keys], DDL)


def begin(spark, name, df, buckets=4, by=(), path=None, keys=("key",)):
    path = path or fresh_path(spark, name)
    return bucketed_table(spark, f"{name}_{abs(hash(path)):x}", path, df.schema, keys, buckets, by=by), path


def contents(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_bucket_counts_are_powers_of_two():
    assert [buckets_for(n, 10) for n in (0, 1, 10, 11, 20, 21, 1000)] == [1, 1, 1, 2, 2, 4, 128]
    assert buckets_for(10**15) == 65_536


def test_a_write_replaces_its_own_partitions_and_may_be_repeated(spark):
    first, again = rows(spark, [1, 2, None]), rows(spark, [2, 3], range(7), "b")
    held, _ = begin(spark, "t", first, by=("day",))
    assert held.read().columns == first.columns and held.read().count() == 0
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    held.replace(first)
    for _ in range(2):
        held.replace(again)
        assert contents(held.read()) == contents(first.where("day = 1 OR day IS NULL").union(again))
    held.replace(again.limit(0))
    assert held.read().count() == 94
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_without_partitions_all_rows_are_replaced(spark):
    held, _ = begin(spark, "u", rows(spark, [1]))
    for days in ([1, 2], [3], [3]):
        held.replace(rows(spark, days))
    assert contents(held.read()) == contents(rows(spark, [3]))
    # Repeated rows and null keys are kept as they are.
    twice = rows(spark, [1], [None, None, 5, 5])
    held.replace(twice.select("odd name", "day", "key", F.lit(1).alias("more")))
    assert contents(held.read()) == contents(twice)


def test_join_by_buckets_has_no_exchange(spark, capsys):
    left = rows(spark, range(3), [*range(30), None])
    right = rows(spark, [9], [*range(20, 50), None], "r").select("key", F.col("odd name").alias("note"))
    (a, _), (b, _) = begin(spark, "a", left, 8, by=("day",)), begin(spark, "b", right, 8)
    a.replace(left)
    a.replace(left.where("day = 1"))
    b.replace(right)
    for how in ("inner", "left", "full", "left_semi", "left_anti"):
        joined = bucketed_join(a, b, how)
        joined.explain()
        assert "Exchange" not in capsys.readouterr().out
        assert contents(joined) == contents(left.join(right, "key", how))
    some = bucketed_join(a, b, where={"left": "day = 2"})
    some.explain()
    plan = capsys.readouterr().out
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert some.count() == 10


def test_a_hot_key_is_written_and_joined_whole(spark):
    left = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("key"), F.col("id").alias("row"))
    right = spark.createDataFrame([(7, "x"), (9, "y")], "`key` long, note string")
    (a, _), (b, _) = begin(spark, "h", left), begin(spark, "i", right)
    a.replace(left)
    b.replace(right)
    assert bucketed_join(a, b).count() == 10_000 + 2


def test_another_layout_is_refused_and_the_same_is_opened(spark):
    df = rows(spark, [1, 2])
    held, path = begin(spark, "v", df, 4, by=("day",))
    held.replace(df)
    opened = bucketed_table(spark, held.name + "_again", path, df.schema, ["key"], 4, by=["day"])
    assert contents(opened.read()) == contents(df)
    with pytest.raises(ValueError, match="begun as"):
        bucketed_table(spark, held.name + "_other", path, df.schema, ["key"], 8, by=["day"])
    for keys, by in (([], ["day"]), (["day"], ["day"]), (["none"], [])):
        with pytest.raises(ValueError, match="different columns"):
            bucketed_table(spark, "w", path, df.schema, keys, 4, by=by)
    with pytest.raises(ValueError, match="lack"):
        held.replace(df.drop("key"))
    with pytest.raises(ValueError, match="types"):
        held.replace(df.withColumn("key", F.col("key").cast("string")))
    with pytest.raises(ValueError, match="differently"):
        bucketed_join(held, begin(spark, "x", df, 2)[0])
