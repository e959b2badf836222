from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.catalogue.registry import LINE_KEYS, registered
from tabfold.operators import features as op
from tabfold.sources import load_table

KEYS_SQL = ", ".join(LINE_KEYS)
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return load_table(spark, folder, "lineitem").select(
        *LINE_KEYS, *[c for c in columns if c not in LINE_KEYS]
    )


@registered(
    f"SELECT {KEYS_SQL}, l_quantity AS v0, l_extendedprice AS v1, l_discount AS v2, l_tax AS v3, "
    "l_linenumber::double AS v4 FROM lineitem"
)
def assemble_features(spark: SparkSession, folder: str) -> DataFrame:
    vectors = op.assemble(_lines(spark, folder, *MEASURES), MEASURES)
    return op.vector_columns(
        vectors.select(*LINE_KEYS, "features"), "features", [f"v{i}" for i in range(5)]
    )


@registered(
    f"SELECT {KEYS_SQL}, l_linenumber::double AS v0, l_quantity AS v1, l_discount AS v2 FROM lineitem"
)
def assemble_vectors(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder, "l_quantity", "l_discount")
    codes = op.assemble(lines, ["l_linenumber"], "codes")
    both = op.assemble(codes, ["l_quantity", "l_discount"], "numbers")
    joined = op.assemble(both, ["codes", "numbers"])
    return op.vector_columns(joined.select(*LINE_KEYS, "features"), "features", ["v0", "v1", "v2"])


@registered(
    "WITH ends AS (SELECT min(l_quantity) q0, max(l_quantity) q1, min(l_extendedprice) p0, "
    "max(l_extendedprice) p1 FROM lineitem) "
    f"SELECT {KEYS_SQL}, round((l_quantity - q0) / (q1 - q0), 9) AS v0, "
    "round((l_extendedprice - p0) / (p1 - p0), 9) AS v1 FROM lineitem CROSS JOIN ends"
)
def minmax_scale(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder, "l_quantity", "l_extendedprice")
    vectors = op.assemble(lines, ["l_quantity", "l_extendedprice"])
    scaler = op.minmax_scaler("features").fit(vectors)
    scaled = scaler.transform(vectors).select(*LINE_KEYS, "scaled")
    return op.vector_columns(scaled, "scaled", ["v0", "v1"]).withColumns(
        {v: F.round(v, 9) for v in ("v0", "v1")}
    )


@registered(
    "WITH ends AS (SELECT min(o_totalprice) p0, max(o_totalprice) p1 FROM orders) "
    "SELECT o_orderkey, round((o_totalprice - p0) / (p1 - p0), 9) AS price, 0.5::double AS flat "
    "FROM orders CROSS JOIN ends"
)
def minmax_constant(spark: SparkSession, folder: str) -> DataFrame:
    """Plain-column form; a column with one value scales to 0.5."""
    orders = load_table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("price"),
        (F.length("o_orderstatus") * 1.0).cast("double").alias("flat"),
    )
    scaled = op.minmax_columns(orders, op.fit_minmax(orders, ["price", "flat"]))
    return scaled.select(
        "o_orderkey", F.round("price_scaled", 9).alias("price"), F.col("flat_scaled").alias("flat")
    )


PRIORITY_INDEX = (
    "SELECT o_orderpriority AS label, count(*) AS n, "
    'row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS "index" '
    "FROM orders GROUP BY 1"
)


@registered(PRIORITY_INDEX)
def string_index_map(spark: SparkSession, folder: str) -> DataFrame:
    return op.string_labels(load_table(spark, folder, "orders"), "o_orderpriority")


@registered(
    f'SELECT o_orderkey, o_orderpriority, "index"::double AS idx FROM orders '
    f"JOIN ({PRIORITY_INDEX}) m ON m.label = o_orderpriority"
)
def string_index_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    labels = op.string_labels(orders, "o_orderpriority")
    return op.index_strings(orders, "o_orderpriority", labels, "idx")


@registered(
    "SELECT c_name AS label, count(*) AS n, "
    'row_number() OVER (ORDER BY count(*) DESC, c_name) - 1 AS "index" FROM customer GROUP BY 1'
)
def string_index_wide(spark: SparkSession, folder: str) -> DataFrame:
    """A column with as many labels as rows: the numbering itself is distributed."""
    return op.string_labels(load_table(spark, folder, "customer"), "c_name")


def _category_sql(column: str) -> str:
    return (
        f"SELECT {column} AS raw, CASE WHEN (SELECT count(DISTINCT {column}) FROM lineitem) <= 20 "
        f"THEN (dense_rank() OVER (ORDER BY {column} <> 0, {column}) - 1)::double "
        f"ELSE {column}::double END AS cat FROM (SELECT DISTINCT {column} FROM lineitem) d"
    )


@registered(
    f"SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_tax, n.cat AS l_linenumber_cat, "
    f"s.cat AS l_suppkey_cat, t.cat AS l_tax_cat FROM lineitem "
    f"JOIN ({_category_sql('l_linenumber')}) n ON n.raw = l_linenumber "
    f"JOIN ({_category_sql('l_suppkey')}) s ON s.raw = l_suppkey "
    f"JOIN ({_category_sql('l_tax')}) t ON t.raw = l_tax"
)
def category_index(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_linenumber", "l_suppkey", "l_tax"]
    lines = load_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", *columns)
    return op.index_categories(lines, columns, op.category_maps(lines, columns))
