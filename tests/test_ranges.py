"""Ordered operators against plain Python, with keys that hold most rows."""

import random
import re

import pytest
from pyspark.sql import Window, functions as F

from tabfold.operators.asof import asof_join
from tabfold.operators.intervals import block_size, overlap_join, points_in_intervals
from tabfold.operators.ranges import PART, by_range, moving, running_totals


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    draw = random.Random(1)
    key = lambda most: draw.choice([1, 1, 1, 2, 3, None, draw.randint(4, most)])
    time = lambda: draw.choice([None] + [draw.randint(0, 400)] * 30)
    left = spark.createDataFrame([(i, key(40), time()) for i in range(700)], "i long, k long, t long").repartition(5)
    right = spark.createDataFrame([(key(50), time(), j) for j in range(300)], "k long, u long, v long").repartition(4)
    return left, right


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tolerance", [None, 3])
def test_asof_equals_a_search_per_row(sides, direction, exact, tolerance):
    left, right = sides
    known, sign, wanted = right.collect(), 1 if direction == "backward" else -1, []
    for r in left.collect():
        fits = []
        if r.k is not None and r.t is not None:
            fits = [x for x in known if x.k == r.k and x.u is not None and (x.u * sign < r.t * sign or exact and x.u == r.t)]
            fits = [x for x in fits if tolerance is None or (r.t - x.u) * sign <= tolerance]
        best = max(fits, key=lambda x: (x.u * sign, x.v), default=None)
        wanted.append((r.i, r.k, r.t, best and best.v))
    options = {"values": ["v"], "direction": direction, "exact": exact, "tolerance": tolerance, "parts": 13}
    assert rows_of(asof_join(left, right, ["k"], "t", "u", **options)) == sorted(wanted, key=repr)
    inner = asof_join(left, right, ["k"], "t", "u", how="inner", **options)
    assert rows_of(inner) == sorted((w for w in wanted if w[3] is not None), key=repr)


def test_asof_over_ranges_without_right_rows(spark):
    left = spark.range(5000).select(F.col("id").alias("t"), F.lit("a").alias("k"))
    right = spark.createDataFrame([("a", 10, 1), ("a", 3000, 2), ("b", 20, 3)], "k string, u long, v long")
    found = asof_join(left, right, ["k"], "t", "u", values=["v"], parts=16)
    wanted = [(t, "a", None if t < 10 else 1 if t < 3000 else 2) for t in range(5000)]
    assert rows_of(found) == sorted(wanted, key=repr)


def test_asof_empty_sides_and_timestamps(spark):
    times = spark.sql("SELECT timestamp '2024-01-01 00:00:01.5' + make_interval(0,0,0,0,0,0,id) AS t, id % 2 AS k FROM range(10)")
    none = spark.createDataFrame([], "k long, u timestamp, v long")
    assert [r.v for r in asof_join(times, none, ["k"], "t", "u", values=["v"]).collect()] == [None] * 10
    assert asof_join(times.limit(0), none, ["k"], "t", "u", values=["v"]).collect() == []
    marks = times.where("second(t) IN (2, 6)").select("k", F.col("t").alias("u"), F.second("t").alias("v"))
    found = asof_join(times, marks, ["k"], "t", "u", values=["v"], tolerance=2_000_000).collect()
    # Seconds 1 to 10, odd ones of key 0; only 2 and 6 are known, to key 1.
    assert {r.t.second: r.v for r in found if r.v is not None} == {2: 2, 4: 2, 6: 6, 8: 6}


def test_one_key_on_half_the_rows_is_cut(spark):
    rows = spark.range(20000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    ranges = by_range(rows, ["k", "t"], 16)
    sizes = [r["count"] for r in ranges.rows.groupBy(PART).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 20000 / 16
    assert ranges.rows.where("k = 0").select(PART).distinct().count() >= 7
    # Equal orders are told apart by the rest of the row.
    tied = by_range(rows.withColumn("k", F.lit(1)), ["k"], 16)
    assert max(r["count"] for r in tied.rows.groupBy(PART).count().collect()) < 2 * 20000 / 16


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_totals_and_frames_equal_plain_windows(spark, by):
    rows = spark.range(900).select(
        "id", (F.col("id") * 7 % 900).alias("o"), F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, (F.col("id") % 11).cast("string")).alias("g"),
        (F.col("id") % 2).alias("h"), F.when(F.col("id") % 5 > 0, F.col("id") % 13).alias("x"),
    ).repartition(6)
    whole = Window.partitionBy(*by).orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.withColumns({"s": F.coalesce(F.sum("x").over(whole), F.lit(0)), "n": F.sum("h").over(whole)})
    assert rows_of(running_totals(rows, ["o"], {"s": "x", "n": "h"}, by=by, parts=11)) == rows_of(plain)
    for preceding in (0, 3, 200, 2000):
        frame = Window.partitionBy(*by).orderBy("o").rowsBetween(-preceding, 0)
        wanted = {"m": F.max("x"), "n": F.count("*"), "a": F.sum("x")}
        plain = rows.withColumns({k: v.over(frame) for k, v in wanted.items()})
        assert rows_of(moving(rows, ["o"], preceding, wanted, by=by, parts=11)) == rows_of(plain)


def test_last_rows_are_sought_at_the_end_of_a_range(spark):
    ranges = by_range(spark.range(40000).select(F.col("id").alias("t")), ["t"], 8)
    late = ranges.rows.where(ranges.is_late())
    n, found = late.groupBy(PART).agg(F.count("*").alias("n"), F.min("t").alias("least")), {}
    for r in n.collect():
        found[r[PART]] = r["least"], r["n"]
    assert len(found) == 8 and sum(n for _, n in found.values()) < 40000 / 4
    # They are the last: from the least one on no row of the range is left out.
    for part, (least, n) in found.items():
        assert ranges.rows.where((F.col(PART) == part) & (F.col("t") >= least)).count() == n


def test_totals_of_nothing(spark):
    none = spark.createDataFrame([], "o long, x long")
    assert running_totals(none, ["o"], {"s": "x"}).collect() == [] == moving(none, ["o"], 2, {"s": F.sum("x")}).collect()
    ties = spark.createDataFrame([(1, 2)] * 50 + [(None, None)], "o long, x long")
    assert max(r.s for r in running_totals(ties, ["o"], {"s": "x"}, parts=4).collect()) == 100


def intervals(spark, seed, n, names):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        start = draw.choice([None, draw.randint(0, 300), draw.randint(100, 110)])
        rows.append((i, draw.choice(["a", "a", "b", None]), start, None if start is None else start + draw.choice([0, -3, 1, 5, 300])))
    return spark.createDataFrame(rows, f"{names[0]} long, k string, {names[1]} long, {names[2]} long")


@pytest.mark.parametrize("on", [[], ["k"]])
def test_intervals_equal_all_pairs(spark, on):
    left, right = intervals(spark, 1, 150, ("i", "s", "e")), intervals(spark, 2, 120, ("j", "u", "w"))
    if not on:
        right = right.drop("k")
    ones, others = left.collect(), right.collect()
    full = lambda r, a, b: r[a] is not None and r[a] < r[b]
    same = lambda a, b: not on or a.k is not None and a.k == b.k
    wanted = [(*a, *[x for c, x in b.asDict().items() if c not in on]) for a in ones for b in others
              if full(a, "s", "e") and full(b, "u", "w") and same(a, b) and a.s < b.w and b.u < a.e]
    found = overlap_join(left, right, ("s", "e"), ("u", "w"), on=on, parts=7)
    assert rows_of(found) == sorted(wanted, key=repr) and found.columns == [*left.columns, *[c for c in right.columns if c not in on]]
    wanted = [(*a, *[x for c, x in b.asDict().items() if c not in on]) for a in ones for b in others
              if a.s is not None and full(b, "u", "w") and same(a, b) and b.u <= a.s < b.w]
    assert rows_of(points_in_intervals(left, right, "s", "u", "w", on=on, parts=7)) == sorted(wanted, key=repr)


def test_an_interval_over_all_points_is_shared_by_the_tasks(spark):
    points = spark.range(60000).select(F.col("id").alias("p"))
    wide = spark.createDataFrame([(1, -1, 100000), (2, 5, 6)], "i long, s long, e long")
    found = points_in_intervals(points, wide, "p", "s", "e", parts=8)
    assert found.groupBy("i").count().orderBy("i").collect() == [(1, 60000), (2, 1)]


def test_pairs_come_into_being_after_the_shuffle(spark):
    left = spark.range(2000).select(F.col("id").alias("i"), F.col("id").alias("s"), (F.col("id") + 1500).alias("e"))
    right = left.toDF("j", "u", "w")
    found = overlap_join(left, right, ("s", "e"), ("u", "w"), parts=4)
    assert found.count() == sum(abs(a - b) < 1500 for a in range(2000) for b in range(2000))
    # What is moved is a row per block that an interval reaches, not one per pair.
    made = re.findall(r"explode\(sequence\((\S+)", found._jdf.queryExecution().optimizedPlan().toString())
    assert any(m.startswith("FLOOR") for m in made) and not any("_start" in m for m in made)


def test_a_block_that_all_intervals_hold_is_shared_by_the_tasks(spark):
    points = spark.range(64000).select((F.col("id") * 10).alias("p"))
    same = spark.range(3000).select(F.col("id").alias("i"), F.lit(100).alias("s"), F.lit(740).alias("e"))
    found = points_in_intervals(points, same, "p", "s", "e", parts=8)
    sizes = found.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert sum(r["count"] for r in sizes) == 3000 * 64
    assert found.groupBy("p").count().where("count = 3000").count() == 64


def test_blocks_follow_the_intervals(spark):
    placed = spark.range(1, 100001).select(F.col("id").alias("_place"))
    held = lambda *bounds: spark.createDataFrame(bounds, "_from long, _upto long")
    assert block_size(held((0, 1), (5, 6)), placed, 8) == 1
    assert block_size(held((0, 100), (5, 105)), placed, 8) == 64
    assert block_size(held((0, 100000)), placed, 8) == 2048 and block_size(held((0, 100000)), placed, 1) == 4096
    assert block_size(held((0, 1)).limit(0), placed.limit(0), 8) == 1


def spans(spark, n, spread):
    """Spans of many lengths, numbered out of order, some far longer than a stretch of places."""
    start = F.col("id") * 10 + F.col("id") * 7 % 10
    length = F.when(F.col("id") % 1000 == 5, n * 4).otherwise(F.col("id") * 31 % spread + 1)
    return spark.range(n).select((F.col("id") * 7919 % n).alias("i"), start.alias("s"), (start + length).alias("e")).repartition(3)


@pytest.mark.parametrize("spread", [25, 900, 9000])
def test_spans_over_many_stretches_equal_a_nested_loop(spark, spread):
    left, right = spans(spark, 3000, spread), spans(spark, 2500, spread // 2).toDF("j", "u", "w")
    wanted = left.join(right, (F.col("s") < F.col("w")) & (F.col("u") < F.col("e"))).select("i", "j")
    found = overlap_join(left, right, ("s", "e"), ("u", "w"), keep=["i", "j"], parts=5)
    summed = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("i", "j").cast("decimal(20,0)"))).first()
    assert found.columns == ["i", "j"] and summed(found) == summed(wanted)
    within = points_in_intervals(right, left, "u", "s", "e", parts=5).select("i", "j")
    assert summed(within) == summed(left.join(right, (F.col("s") <= F.col("u")) & (F.col("u") < F.col("e"))).select("i", "j"))


def test_pairs_take_little_room_in_column_files(spark, tmp_path):
    found = overlap_join(spans(spark, 6000, 40000), spans(spark, 6000, 40000).toDF("j", "u", "w"), ("s", "e"), ("u", "w"), parts=4).select("i", "j")
    found.write.parquet(str(tmp_path / "pairs"))
    rows = spark.read.parquet(str(tmp_path / "pairs")).count()
    assert rows > 10_000_000 and sum(p.stat().st_size for p in (tmp_path / "pairs").glob("*.parquet")) < 0.3 * rows


def test_only_kept_columns_are_moved(spark):
    left, right = spans(spark, 50, 100).withColumn("text", F.lit("x")), spans(spark, 50, 100).toDF("j", "u", "w")
    found = overlap_join(left, right, ("s", "e"), ("u", "w"), keep=["i", "w"], parts=4)
    assert found.columns == ["i", "w"]
    stored = {spark.read.parquet(f).schema.simpleString() for f in found.inputFiles()}
    assert stored and not any(re.search(r"\b(text|j|s|u):", kinds) for kinds in stored)
    none = overlap_join(left, right, ("s", "e"), ("u", "w"), keep=["j"], parts=4)
    whole = overlap_join(left, right, ("s", "e"), ("u", "w"), parts=4)
    assert none.columns == ["j"] and rows_of(none) == rows_of(whole.select("j"))
    with pytest.raises(ValueError):
        overlap_join(left, right, ("s", "e"), ("u", "w"), keep=["nothing"])


def test_clashing_columns_are_refused(spark):
    one = spark.createDataFrame([(1, 2, 3)], "k long, s long, e long")
    with pytest.raises(ValueError):
        overlap_join(one, one, ("s", "e"), ("s", "e"), on=["k"])
    with pytest.raises(ValueError):
        asof_join(one, one, ["k"], "s", "s")
