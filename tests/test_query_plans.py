"""What the physical plans of the registered queries must and must not contain."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tabfold.catalogue import QUERIES
from tabfold.operators import features
from tabfold.operators.features import assemble, index_strings, string_labels
from tabfold.operators.relational import filter_equals, preview, rows_per_group
from tabfold.operators.splits import hash_split
from tabfold.sources import FLIGHTS, load_table, read_csv


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairing_and_no_python_rows(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas"):
        assert banned not in plan, plan


@pytest.mark.parametrize(
    "name, columns",
    [
        ("threshold_label", {"l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"}),
        ("filter_equals", {"vec_id", "label"}),
        ("hash_split_counts", {"o_orderkey"}),
        ("hash_split_train", {"o_orderkey", "o_totalprice"}),
        ("rename_label", {"o_orderkey", "o_totalprice"}),
        ("rmse_holdout", {"l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice"}),
        ("tokenize", {"doc_id", "text"}),
        ("kmeans_rows", {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"}),
        ("view_project", {"c_custkey", "c_acctbal"}),
    ],
)
def test_only_used_columns_are_read(spark, folder, name, columns):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan_of(QUERIES[name](spark, folder)))
    read = {field.split(":")[0] for s in schemas for field in s.split(",")}
    assert read == columns


def test_filters_reach_the_scan(spark, folder):
    plan = plan_of(filter_equals(load_table(spark, folder, "embeddings"), "label", 3))
    assert "EqualTo(label,3)" in plan


def test_hash_split_moves_nothing(spark, folder):
    for part in hash_split(load_table(spark, folder, "orders"), ["o_orderkey"], [0.7, 0.3]):
        assert "Exchange" not in plan_of(part) and "Sort" not in plan_of(part)


def test_split_counts_take_one_scan(spark, folder):
    plan = plan_of(QUERIES["hash_split_counts"](spark, folder))
    assert plan.count("FileScan") == 1


def test_preview_is_a_top_n(spark, folder):
    plan = plan_of(preview(load_table(spark, folder, "orders"), 5, ["o_totalprice"]))
    assert "TakeOrderedAndProject" in plan


def test_groups_are_trimmed_before_the_shuffle(spark, folder):
    plan = plan_of(rows_per_group(load_table(spark, folder, "orders"), "o_orderstatus", 10, ["o_orderkey"]))
    above, below = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in below and "Partial" in below


def test_groups_are_trimmed_by_salt_before_they_meet(spark, folder):
    orders = load_table(spark, folder, "orders")
    for n in (10, 2000):
        plan = plan_of(rows_per_group(orders, "o_orderstatus", n, ["o_orderkey"]))
        assert plan.count("Exchange hashpartitioning(o_orderstatus") == 2 and plan.count("_salt") > 0
        assert plan.count("FileScan") == 1


def test_filters_reach_the_scan_of_a_declared_csv(spark, tmp_path):
    row = ",".join(["1", "1", "AA", "1", "1", "1", "20"])
    (tmp_path / "f.csv").write_text(",".join(FLIGHTS.names) + f"\n{row}\n")
    plan = plan_of(read_csv(spark, str(tmp_path / "f.csv"), FLIGHTS, where="ArrDelay > 15").select("Carrier"))
    assert "GreaterThan(ArrDelay,15)" in plan


def test_string_indexes_beyond_the_broadcast_take_one_scan(spark, folder, monkeypatch):
    customers = load_table(spark, folder, "customer").select("c_custkey", "c_name")
    labels = string_labels(customers, "c_name")
    monkeypatch.setattr(features, "BROADCAST_BYTES", 1000)
    plan = plan_of(index_strings(customers, "c_name", labels, "i"))
    assert plan.count("FileScan") == 1


def test_holding_rows_runs_nothing_and_keeps_one_copy(spark):
    from tabfold.operators.holding import held

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("holding", "")
    with held(spark.range(100), "id") as rows:
        assert not tracker.getJobIdsForGroup("holding")
        assert rows.storageLevel.useMemory
    assert not rows.storageLevel.useMemory
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_held_rows_fill_as_many_parts_as_they_take_and_never_fewer_than_the_input_has(spark):
    from tabfold.operators.holding import held

    for rows_per_part, wanted in ((30, 4), (60, 2), (1000, 2)):
        with held(spark.range(0, 100, 1, 2), "id", rows_per_part=rows_per_part) as rows:
            assert rows.rdd.getNumPartitions() == wanted and rows.count() == 100
    assert not rows.storageLevel.useMemory


def test_label_numbering_has_no_single_task_window_over_labels(spark, folder):
    labels = string_labels(load_table(spark, folder, "customer"), "c_name")
    plan = plan_of(labels)
    single = plan.split("Exchange SinglePartition")
    # The one window over all rows sees one row per sort partition.
    assert len(single) == 2 and "HashAggregate" in single[1]


@pytest.mark.parametrize("name", ["running_revenue", "running_revenue_by_flag", "moving_hundred_lines", "asof_last_order", "overlapping_spans"])
def test_ordered_work_has_no_task_that_sees_all_rows(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    assert "SinglePartition" not in plan
    assert all("windowspecdefinition(_part" in w or "windowspecdefinition(_key" in w for w in re.findall(r"Window \[.*", plan))


def test_asof_shuffles_its_rows_once(spark, folder):
    plan = plan_of(QUERIES["asof_last_order"](spark, folder))
    # Besides that, only the rows of keys at cuts are reduced to one per cut.
    assert plan.count("Exchange hashpartitioning(_part") == 2 and plan.count("max_by") > 0


def test_vector_steps_stay_in_generated_code(spark, folder):
    lines = load_table(spark, folder, "lineitem")
    plan = plan_of(assemble(lines, ["l_quantity", "l_tax"]).select("features"))
    assert "Exchange" not in plan and "PythonUDF" not in plan
    assert plan_of(lines.where(F.col("l_quantity") > 1)).count("PushedFilters") == 1
