from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.catalogue.registry import registered
from tabfold.operators.holding import ROWS_PER_PART
from tabfold.operators import clusters as op
from tabfold.operators.features import assemble
from tabfold.operators.relational import rows_per_group
from tabfold.plans.segmentation import segment
from tabfold.sources import load_table

SEED = 0


# --- given labels on embeddings ------------------------------------------------

LABELLED = "SELECT label AS c, embedding::double[] AS x FROM embeddings"


def _silhouette_sql(rows: str, tail: str) -> str:
    """CTEs over ``rows`` (c, x DOUBLE[]): ``stats`` per cluster, ``scored`` per row."""
    return f"""
WITH v AS (SELECT row_number() OVER () AS id, c, x FROM ({rows}) r),
totals AS (
  SELECT c, list(s ORDER BY d) AS t FROM (
    SELECT c, d, sum(e) AS s
    FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS d FROM v) u GROUP BY c, d) g
  GROUP BY c
),
stats AS (
  SELECT c, n, q, t, [e / n for e in t] AS mean
  FROM (SELECT c, count(*)::double AS n, sum(list_inner_product(x, x)) AS q FROM v GROUP BY c) a
  JOIN totals USING (c)
),
distances AS (
  SELECT v.id, v.c = s.c AS own, s.n,
    list_inner_product(x, x) + q / s.n - 2 * list_inner_product(x, t) / s.n AS d
  FROM v, stats s
),
sides AS (
  SELECT id, max(n) FILTER (own) AS n,
    max(d * n / greatest(n - 1, 1)) FILTER (own) AS a, min(d) FILTER (NOT own) AS b
  FROM distances GROUP BY id
),
scored AS (
  SELECT CASE WHEN n = 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1
         ELSE 0.0 END AS s FROM sides
),
spread AS (
  SELECT sum(list_inner_product(g, g)) AS w
  FROM (SELECT [x[i] - mean[i] for i in range(1, len(x) + 1)] AS g
        FROM v JOIN stats USING (c)) e
)
{tail}"""


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load_table(spark, folder, "embeddings")
    return vectors.select("vec_id", "label", op.array_vector("embedding").alias("features"))


@registered(
    "SELECT label AS cluster, (d - 1)::integer AS dim, round(avg(e), 8) AS value FROM ("
    "SELECT label, unnest(embedding::double[]) AS e, generate_subscripts(embedding, 1) AS d "
    "FROM embeddings) u GROUP BY 1, 2"
)
def centers_by_label(spark: SparkSession, folder: str) -> DataFrame:
    centers = op.group_centers(_labelled(spark, folder), "features", "label")
    return centers.withColumn("value", F.round("value", 8))


@registered(_silhouette_sql(LABELLED, "SELECT round(w, 6) AS wssse FROM spread"))
def wssse_by_label(spark: SparkSession, folder: str) -> DataFrame:
    total = op.wssse(_labelled(spark, folder), "features", "label")
    return total.select(F.round("wssse", 6).alias("wssse"))


@registered(_silhouette_sql(LABELLED, "SELECT round(avg(s), 9) AS silhouette FROM scored"))
def silhouette_by_label(spark: SparkSession, folder: str) -> DataFrame:
    score = op.silhouette(_labelled(spark, folder), "features", "label")
    return spark.createDataFrame([(round(score, 9),)], "silhouette double")


@registered(
    "SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id)::integer AS rn "
    "FROM embeddings QUALIFY rn <= 10"
)
def cluster_rows(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load_table(spark, folder, "embeddings").select("vec_id", "label")
    return rows_per_group(vectors, "label", 10, ["vec_id"])


@registered(
    "SELECT c_nationkey, count(*) AS n_rows, round(avg(c_acctbal), 6) AS avg_c_acctbal, "
    "min(c_acctbal) AS min_c_acctbal, max(c_acctbal) AS max_c_acctbal, "
    "round(avg(c_custkey), 6) AS avg_c_custkey, min(c_custkey)::double AS min_c_custkey, "
    "max(c_custkey)::double AS max_c_custkey FROM customer GROUP BY c_nationkey"
)
def cluster_profile(spark: SparkSession, folder: str) -> DataFrame:
    customers = load_table(spark, folder, "customer")
    profile = op.cluster_profile(customers, "c_nationkey", ["c_acctbal", "c_custkey"])
    return profile.withColumns(
        {c: F.round(c, 6) for c in ("avg_c_acctbal", "avg_c_custkey")}
    )


# --- given centres on customers ---------------------------------------------------

CENTERS = [(4.0, 0.0), (12.0, 3000.0), (20.0, 6000.0), (8.0, 9000.0)]


@registered(
    "WITH d AS (SELECT c_custkey, ["
    + ", ".join(f"(c_nationkey - {x}) ** 2 + (c_acctbal - {y}) ** 2" for x, y in CENTERS)
    + "]::double[] AS d FROM customer) "
    "SELECT c_custkey, (list_position(d, list_min(d)) - 1)::integer AS prediction FROM d"
)
def nearest_center(spark: SparkSession, folder: str) -> DataFrame:
    customers = load_table(spark, folder, "customer")
    vectors = assemble(customers, ["c_nationkey", "c_acctbal"])
    return op.nearest(vectors, "features", CENTERS).select("c_custkey", "prediction")


@registered(
    "SELECT round(sum(least("
    + ", ".join(f"(c_nationkey - {x}) ** 2 + (c_acctbal - {y}) ** 2" for x, y in CENTERS)
    + ")), 2) AS cost FROM customer"
)
def cost_of_centers(spark: SparkSession, folder: str) -> DataFrame:
    customers = load_table(spark, folder, "customer")
    vectors = assemble(customers, ["c_nationkey", "c_acctbal"])
    return op.cost(vectors, "features", CENTERS).select(F.round("cost", 2).alias("cost"))


# --- k-means ------------------------------------------------------------------------

# Ten numeric traits of an order. As in a customer file with an income column, one
# trait (the priority band, in steps of 25,000) is far larger than the codes beside
# it, so five clusters, the five bands, are the clear optimum.
TRAITS_SPARK = {
    "band": "cast(substr(o_orderpriority, 1, 1) as int) * 25000",
    "status": "case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end",
    "month": "month(o_orderdate)",
    "day": "dayofmonth(o_orderdate)",
    "weekday": "dayofweek(o_orderdate)",
    "quarter": "quarter(o_orderdate)",
    "year": "year(o_orderdate) - 1995",
    "price_step": "cast(floor(o_totalprice / 100000) as int)",
    "customer_digit": "cast(o_custkey % 10 as int)",
    "customer_parity": "cast(o_custkey % 2 as int)",
}
TRAITS_SQL = {**TRAITS_SPARK, "weekday": "dayofweek(o_orderdate) + 1"}
TRAITS = list(TRAITS_SPARK)
BANDS = (
    f"SELECT {TRAITS_SQL['band']} / 25000 - 1 AS c, "
    f"[{', '.join(f'({e})::double' for e in TRAITS_SQL.values())}] AS x FROM orders"
)


def _traits(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    return orders.selectExpr("o_orderkey", *[f"{e} AS {n}" for n, e in TRAITS_SPARK.items()])


# For the sweep the large trait has six levels, each ten times the one before. The
# best k clusters are then the k - 1 highest levels and all lower ones together.
# Each round of the search for first centres reaches about one level further down.
LEVELS = 6
SWEEP = {"seed": SEED, "parallelism": 5, "rows_per_part": ROWS_PER_PART, "initSteps": 3 * LEVELS}
STEPPED_SPARK = TRAITS_SPARK | {"band": f"100.0 * pow(10, o_custkey % {LEVELS})"}
STEPPED_SQL = TRAITS_SQL | {"band": f"100.0 * pow(10, o_custkey % {LEVELS})"}
STEPPED_X = f"[{', '.join(f'({e})::double' for e in STEPPED_SQL.values())}]"


def _sweep_row_sql(k: int) -> str:
    groups = f"SELECT greatest(o_custkey % {LEVELS}, {LEVELS - k}) AS c, {STEPPED_X} AS x FROM orders"
    tail = (
        f"SELECT {k}::integer AS k, (SELECT avg(s) FROM scored) AS silhouette, "
        "(SELECT w FROM spread) AS training_cost"
    )
    return f"SELECT * FROM ({_silhouette_sql(groups, tail)}) k{k}"


SWEEP_SQL = " UNION ALL ".join(map(_sweep_row_sql, range(2, LEVELS + 1)))


def _stepped(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    return orders.selectExpr(*[f"{e} AS {n}" for n, e in STEPPED_SPARK.items()])


def _rounded(scores: DataFrame) -> DataFrame:
    return scores.select(
        "k", F.round("silhouette", 6).alias("silhouette"), F.format_string("%.5e", "training_cost").alias("training_cost")
    )


ROUNDED_SQL = "k, round(silhouette, 6) AS silhouette, printf('%.5e', training_cost) AS training_cost"


@registered(f"SELECT {ROUNDED_SQL} FROM ({SWEEP_SQL}) sweep")
def kmeans_sweep(spark: SparkSession, folder: str) -> DataFrame:
    vectors = assemble(_stepped(spark, folder), TRAITS)
    return _rounded(op.kmeans_sweep(vectors, "features", **SWEEP).scores)


@registered(f"SELECT {ROUNDED_SQL} FROM ({SWEEP_SQL}) sweep ORDER BY sweep.silhouette DESC, k LIMIT 1")
def best_k(spark: SparkSession, folder: str) -> DataFrame:
    found = segment(_stepped(spark, folder), TRAITS, **SWEEP)
    return _rounded(found.best)


def _five_clusters(spark: SparkSession, folder: str):
    vectors = assemble(_traits(spark, folder), TRAITS)
    return vectors, op.fit_kmeans(vectors.select("features"), "features", 5, SEED, rows_per_part=ROWS_PER_PART)


@registered(
    "SELECT o_orderkey, cast(substr(o_orderpriority, 1, 1) AS integer) * 25000 AS center_band "
    "FROM orders"
)
def kmeans_assign(spark: SparkSession, folder: str) -> DataFrame:
    """Every row with the leading coordinate of the centre of its cluster."""
    vectors, model = _five_clusters(spark, folder)
    bands = F.lit([int(round(c[0])) for c in model.clusterCenters()])
    return op.assign(vectors, model).select(
        "o_orderkey", F.element_at(bands, F.col("prediction") + 1).alias("center_band")
    )


@registered(
    _silhouette_sql(
        BANDS,
        "SELECT round(mean[1])::integer AS center_band, (i - 1)::integer AS dim, "
        "round(mean[i], 6) AS value FROM stats, range(1, 11) r(i)",
    )
)
def kmeans_centers(spark: SparkSession, folder: str) -> DataFrame:
    _, model = _five_clusters(spark, folder)
    centers = op.model_centers(spark, model)
    leading = centers.where("dim = 0").select(
        "cluster", F.round("value").cast("int").alias("center_band")
    )
    return centers.join(leading, "cluster").select(
        "center_band", "dim", F.round("value", 6).alias("value")
    )


@registered(
    "SELECT "
    f"{TRAITS_SQL['band']} AS band, o_orderkey, "
    f"row_number() OVER (PARTITION BY {TRAITS_SQL['band']} ORDER BY o_orderkey)::integer AS rn "
    "FROM orders QUALIFY rn <= 10"
)
def kmeans_rows(spark: SparkSession, folder: str) -> DataFrame:
    """First ten rows of every fitted cluster."""
    vectors, model = _five_clusters(spark, folder)
    assigned = op.assign(vectors, model).select("o_orderkey", "band", "prediction")
    shown = rows_per_group(assigned, "prediction", 10, ["o_orderkey"])
    return shown.select("band", "o_orderkey", "rn")


@registered(
    f"SELECT {TRAITS_SQL['band']} AS center_band, count(*) AS n_rows, "
    + ", ".join(
        f"round(avg({TRAITS_SQL[t]}), 6) AS avg_{t}, min({TRAITS_SQL[t]})::double AS min_{t}, "
        f"max({TRAITS_SQL[t]})::double AS max_{t}"
        for t in TRAITS[1:]
    )
    + " FROM orders GROUP BY 1"
)
def kmeans_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Size, mean and range of every trait per fitted cluster."""
    vectors, model = _five_clusters(spark, folder)
    profile = op.cluster_profile(op.assign(vectors, model), "prediction", TRAITS)
    averages = {f"avg_{t}": F.round(f"avg_{t}", 6) for t in TRAITS[1:]}
    return (
        profile.withColumns(averages)
        .withColumn("center_band", F.round("avg_band").cast("int"))
        .drop("prediction", "avg_band", "min_band", "max_band")
    )
