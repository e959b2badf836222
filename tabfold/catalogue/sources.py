from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tabfold.catalogue.registry import registered
from tabfold.session import fresh_path
from tabfold.sources import bucketed_join, bucketed_table, buckets_for, load_table, read_csv, register, sql
from tabfold.sources.json_fields import field_kinds, field_types, typed_fields

CUSTOMER_COLUMNS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
CUSTOMER_DDL = (
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)


def _as_csv(df: DataFrame, **options) -> str:
    """Write ``df`` as CSV to the shared folder and return the path."""
    path = fresh_path(df.sparkSession, "csv")
    df.write.options(header=True, **options).csv(path)
    return path


@registered(f"SELECT {CUSTOMER_COLUMNS} FROM customer")
def csv_infer(spark: SparkSession, folder: str) -> DataFrame:
    path = _as_csv(load_table(spark, folder, "customer"))
    # Inference takes the narrowest type, so the key comes back as int.
    return read_csv(spark, path, infer=True).withColumn("c_custkey", F.col("c_custkey").cast("long"))


@registered(f"SELECT {CUSTOMER_COLUMNS} FROM customer")
def csv_schema(spark: SparkSession, folder: str) -> DataFrame:
    return read_csv(spark, _as_csv(load_table(spark, folder, "customer")), CUSTOMER_DDL)


@registered(
    "SELECT c_custkey::varchar AS c_custkey, c_name, c_nationkey::varchar AS c_nationkey, "
    "c_acctbal::varchar AS c_acctbal, c_mktsegment FROM customer"
)
def csv_strings(spark: SparkSession, folder: str) -> DataFrame:
    path = _as_csv(load_table(spark, folder, "customer"), sep="|")
    return read_csv(spark, path, sep="|")


@registered("SELECT doc_id, text FROM documents")
def csv_text(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with quotes, commas and line breaks, through CSV and back."""
    docs = load_table(spark, folder, "documents").select("doc_id", "text")
    # Files with line breaks are read whole by one task each, so keep them short.
    path = _as_csv(docs, escape='"', quoteAll=True, maxRecordsPerFile=20_000)
    return read_csv(spark, path, "doc_id bigint, text string", escape='"', multiLine=True)


@registered(f"SELECT {CUSTOMER_COLUMNS} FROM customer")
def view_select_star(spark: SparkSession, folder: str) -> DataFrame:
    register(load_table(spark, folder, "customer"), "customers_view")
    return sql(spark, "SELECT * FROM customers_view")


@registered("SELECT c_custkey, c_acctbal AS balance FROM customer")
def view_project(spark: SparkSession, folder: str) -> DataFrame:
    return sql(
        spark,
        "SELECT c_custkey, c_acctbal AS balance FROM balances",
        balances=load_table(spark, folder, "customer"),
    )


LINES = StructType(
    [
        StructField("l_orderkey", LongType(), nullable=False),
        StructField("l_linenumber", IntegerType(), nullable=False),
        StructField("l_quantity", DoubleType(), nullable=False),
        StructField("l_returnflag", StringType(), nullable=False),
    ]
)


@registered(
    "SELECT l_returnflag, count(*) AS n_rows, round(sum(l_quantity), 4) AS quantity, max(l_linenumber) AS last_line "
    "FROM lineitem WHERE l_quantity > 15 GROUP BY l_returnflag"
)
def csv_not_null(spark: SparkSession, folder: str) -> DataFrame:
    """A filtered aggregate over a CSV whose columns are declared as not null."""
    path = _as_csv(load_table(spark, folder, "lineitem").select(*LINES.names))
    lines = read_csv(spark, path, LINES, where="l_quantity > 15")
    return lines.groupBy("l_returnflag").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("l_quantity"), 4).alias("quantity"), F.max("l_linenumber").alias("last_line")
    )


@registered("SELECT event_id, (props ->> 'k')::bigint AS k FROM events")
def json_typed_props(spark: SparkSession, folder: str) -> DataFrame:
    """A column for each field that the properties of events turn out to have."""
    events = load_table(spark, folder, "events").select("event_id", "props")
    return typed_fields(events, "props").drop("props")


@registered(
    "SELECT 'k' AS field, 'bigint' AS type, count(*) AS n FROM events WHERE json_type(props, '$.k') IN ('BIGINT', 'UBIGINT')"
)
def json_field_types(spark: SparkSession, folder: str) -> DataFrame:
    return field_types(field_kinds(load_table(spark, folder, "events"), "props"))


def _stored(df: DataFrame, stem: str, key: str, buckets: int, by: tuple[str, ...] = ()):
    path = fresh_path(df.sparkSession, stem)
    return bucketed_table(df.sparkSession, path.rsplit("/", 1)[1].replace("-", "_"), path, df.schema, [key], buckets, by=by)


@registered(
    "SELECT year(o_orderdate)::int AS year, count(*) AS orders, "
    "sum(CASE WHEN year(o_orderdate) % 2 = 1 THEN 1 ELSE 2 END * round(o_totalprice * 100)::bigint)::bigint AS cents, "
    "count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1"
)
def partitions_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """Doubled prices by year of order; the odd years are then replaced by the plain ones, twice."""
    orders = load_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.year("o_orderdate").alias("year")
    )
    held = _stored(orders, "orders", "o_orderkey", buckets_for(orders.count()), by=("year",))
    held.replace(orders.withColumn("cents", F.col("cents") * 2))
    for _ in range(2):
        held.replace(orders.where("year % 2 = 1"))
    return held.read().groupBy("year").agg(
        F.count("*").alias("orders"), F.sum("cents").alias("cents"), F.count_distinct("o_custkey").alias("customers")
    )


@registered(
    "SELECT o_orderpriority, l_returnflag, count(*) AS lines, sum(l_quantity) AS quantity "
    "FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderdate < DATE '1997-01-01' GROUP BY ALL"
)
def bucketed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and their lines, stored in equal buckets and joined without a shuffle."""
    orders = load_table(spark, folder, "orders").withColumnRenamed("o_orderkey", "orderkey")
    lines = load_table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    buckets = buckets_for(lines.count())
    left, right = _stored(orders, "orders", "orderkey", buckets), _stored(lines, "lines", "orderkey", buckets)
    left.replace(orders)
    right.replace(lines)
    joined = bucketed_join(left, right, where={"left": "o_orderdate < DATE '1997-01-01'"})
    return joined.groupBy("o_orderpriority", "l_returnflag").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
