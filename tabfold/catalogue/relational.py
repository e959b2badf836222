from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.catalogue.registry import registered
from tabfold.functions import cast_label as to_label, threshold_label as above
from tabfold.operators import relational as op
from tabfold.sources import load_table

PRICE_LIMIT = 45000

LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@registered(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice AS label FROM lineitem"
)
def project_alias(spark: SparkSession, folder: str) -> DataFrame:
    lines = load_table(spark, folder, "lineitem")
    return op.project(
        lines, "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", label="l_extendedprice"
    )


@registered("SELECT * FROM orders")
def select_all(spark: SparkSession, folder: str) -> DataFrame:
    return op.project(load_table(spark, folder, "orders"), "*")


@registered('SELECT o_orderkey, o_totalprice AS "trueLabel" FROM orders')
def rename_label(spark: SparkSession, folder: str) -> DataFrame:
    orders = op.project(load_table(spark, folder, "orders"), "o_orderkey", label="o_totalprice")
    return op.rename(orders, "label", "trueLabel")


@registered(
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    f"cast(l_extendedprice > {PRICE_LIMIT} AS double) AS label FROM lineitem"
)
def threshold_label(spark: SparkSession, folder: str) -> DataFrame:
    lines = load_table(spark, folder, "lineitem")
    return op.project(
        lines,
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        label=above("l_extendedprice", PRICE_LIMIT),
    )


@registered("SELECT doc_id, quality AS label FROM labels")
def cast_label(spark: SparkSession, folder: str) -> DataFrame:
    texts = load_table(spark, folder, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("quality")
    )
    return op.project(texts, "doc_id", label=to_label("quality"))


@registered("SELECT event_id, event_type, try_cast(event_type AS integer) AS label FROM events")
def cast_label_null(spark: SparkSession, folder: str) -> DataFrame:
    events = load_table(spark, folder, "events")
    return op.project(events, "event_id", "event_type", label=to_label("event_type", "null"))


@registered("SELECT vec_id, label FROM embeddings WHERE label = 0")
def filter_equals(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load_table(spark, folder, "embeddings")
    return op.filter_equals(vectors, "label", 0).select("vec_id", "label")


@registered("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def filter_sql(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    return op.filter_sql(orders, "o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")


@registered(
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10"
)
def preview_top(spark: SparkSession, folder: str) -> DataFrame:
    customers = load_table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    return op.preview(customers, 10, [F.desc("c_acctbal"), "c_custkey"])


@registered("SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return op.row_count(load_table(spark, folder, "lineitem"))


@registered(
    " UNION ALL ".join(
        f"SELECT {i}::integer AS position, '{name}' AS column_name, '{kind}' AS data_type, "
        f"true AS nullable, (count(*) - count({name}))::bigint AS n_null FROM lineitem"
        for i, (name, kind) in enumerate(LINEITEM_TYPES.items(), start=1)
    )
)
def schema_report(spark: SparkSession, folder: str) -> DataFrame:
    """The schema, and beside it what one pass over the rows finds."""
    lines = load_table(spark, folder, "lineitem")
    return op.schema_table(lines).join(op.null_counts(lines), "column_name")
