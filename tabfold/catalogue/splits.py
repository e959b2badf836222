from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.catalogue.registry import bucket_sql, registered
from tabfold.operators.relational import union_all
from tabfold.operators.splits import hash_split, random_split, with_hash_fold
from tabfold.plans.holdout import hold_out
from tabfold.sources import load_table

SEED = 7
ORDER_BUCKET = bucket_sql("o_orderkey::varchar", 10)


@registered(
    f"SELECT CASE WHEN {ORDER_BUCKET} < 7 THEN 'train' ELSE 'test' END AS part, "
    "count(*) AS n_rows FROM orders GROUP BY 1"
)
def hash_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders").withColumn("label", F.col("o_totalprice"))
    return hold_out(orders, keys=["o_orderkey"]).counts()


@registered(f"SELECT o_orderkey, o_totalprice FROM orders WHERE {ORDER_BUCKET} < 7")
def hash_split_train(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    train, _ = hash_split(orders, ["o_orderkey"], [0.7, 0.3])
    return train


@registered(
    f"SELECT {bucket_sql('o_orderkey::varchar', 3, draw=1)}::integer AS fold, "
    "count(*) AS n_rows FROM orders GROUP BY 1"
)
def hash_fold_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders").select("o_orderkey")
    return with_hash_fold(orders, ["o_orderkey"], 3).groupBy("fold").agg(
        F.count("*").alias("n_rows")
    )


def _random_parts(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders").select("o_orderkey")
    parts = random_split(orders, [0.7, 0.3], SEED)
    return union_all(
        [p.withColumn("part", F.lit(n)) for n, p in zip(("train", "test"), parts)]
    )


@registered("SELECT count(*) AS n_rows, true AS train_share_is_near FROM orders")
def random_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All rows, and whether the larger part is within six standard errors of its share."""
    counts = _random_parts(spark, folder).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("part") == "train").alias("n_train")
    )
    error = F.sqrt(F.col("n_rows") * 0.7 * 0.3)
    near = F.abs(F.col("n_train") - 0.7 * F.col("n_rows")) <= 6 * error
    return counts.select("n_rows", near.alias("train_share_is_near"))


@registered("SELECT o_orderkey, 1::bigint AS n_parts FROM orders")
def random_split_cover(spark: SparkSession, folder: str) -> DataFrame:
    """Every row is in exactly one part."""
    return _random_parts(spark, folder).groupBy("o_orderkey").agg(F.count("*").alias("n_parts"))
