"""Joins on a key that half of all rows share, and that some lack."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.catalogue.registry import registered
from tabfold.operators.joins import skew_join
from tabfold.sources import load_table

# Every other order is given to one customer, and some to none.
LEFT_SQL = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 7 WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS k, o_totalprice FROM orders"
)
RIGHT_SQL = "SELECT CASE WHEN c_custkey % 13 = 1 THEN NULL ELSE c_custkey + 5 END AS k, c_custkey, c_acctbal FROM customer"
FULL_COLUMNS = "o_orderkey, coalesce(l.k, r.k) AS k, o_totalprice, c_custkey, c_acctbal"


def _sql(columns: str, join: str) -> str:
    return f"SELECT {columns} FROM ({LEFT_SQL}) l {join} ({RIGHT_SQL}) r ON l.k = r.k"


def _joined(spark: SparkSession, folder: str, how: str) -> DataFrame:
    order, customer = F.col("o_orderkey"), F.col("c_custkey")
    given = F.when(order % 2 == 0, 7).when(order % 11 != 0, F.col("o_custkey"))
    orders = load_table(spark, folder, "orders").select("o_orderkey", given.alias("k"), "o_totalprice")
    customers = load_table(spark, folder, "customer").select(
        F.when(customer % 13 != 1, customer + 5).alias("k"), "c_custkey", "c_acctbal"
    )
    return skew_join(orders, customers, ["k"], how)


@registered(_sql(FULL_COLUMNS, "JOIN"))
def skew_join_inner(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(spark, folder, "inner")


@registered(_sql(FULL_COLUMNS.replace("coalesce(l.k, r.k) AS k", "l.k"), "LEFT JOIN"))
def skew_join_left(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(spark, folder, "left")


@registered(_sql(FULL_COLUMNS, "FULL JOIN"))
def skew_join_full(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(spark, folder, "full")


@registered(_sql("l.*", "SEMI JOIN"))
def skew_join_semi(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(spark, folder, "semi")


@registered(_sql("l.*", "ANTI JOIN"))
def skew_join_anti(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(spark, folder, "anti")
