"""K-means over a range of k, cluster quality, and tables about clusters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from tabfold.functions import as_array, squared_distance
from tabfold.operators.holding import held
from tabfold.operators.tuning import best_row


@dataclass(frozen=True)
class Sweep:
    models: dict[int, KMeansModel]
    scores: DataFrame

    def best(self) -> DataFrame:
        """The k with the highest silhouette, the smallest one on a tie."""
        return best_row(self.scores, "silhouette", larger=True, tie="k")

    def best_model(self) -> KMeansModel:
        return self.models[self.best().first()["k"]]


# --- statistics per cluster --------------------------------------------------


def cluster_stats(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Rows (cluster, n, mean, spread), spread being the sum of squared distances
    to the mean, from the running variance, so that large means do no harm.

    The vectors are summed in the map tasks: one partial row per cluster and task
    is shuffled, however many rows one cluster holds.
    """
    wanted = Summarizer.metrics("count", "mean", "variance")
    stats = df.groupBy(F.col(cluster).alias("cluster")).agg(
        wanted.summary(F.col(vector)).alias("s")
    )
    variance = F.aggregate(as_array("s.variance"), F.lit(0.0), lambda t, v: t + v)
    return stats.select(
        "cluster",
        F.col("s.count").alias("n"),
        as_array("s.mean").alias("mean"),
        (variance * (F.col("s.count") - 1)).alias("spread"),
    )


def wssse(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Sum of squared distances to the own cluster's mean, in one pass."""
    return cluster_stats(df, vector, cluster).agg(F.sum("spread").alias("wssse"))


def _with_distances(df: DataFrame, vector: str, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``_distances``, the squared distances to each of the centres."""
    # Two projections: the array is taken from the vector once per row.
    distances = F.array(*[squared_distance(F.col("_values"), c) for c in centers])
    return (
        df.withColumn("_values", as_array(vector))
        .withColumn("_distances", distances)
        .drop("_values")
    )


def cost(df: DataFrame, vector: str, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Sum of squared distances to the nearest of the given centres."""
    near = _with_distances(df.select(vector), vector, centers)
    return near.agg(F.sum(F.array_min("_distances")).alias("cost"))


def nearest(
    df: DataFrame, vector: str, centers: Sequence[Sequence[float]], out: str = "prediction"
) -> DataFrame:
    """Assign rows to given centres by a plain expression, the first centre on a tie."""
    place = F.array_position("_distances", F.array_min("_distances")).cast("int")
    return _with_distances(df, vector, centers).withColumn(out, place - 1).drop("_distances")


# --- silhouette --------------------------------------------------------------


def silhouette(df: DataFrame, vector: str = "features", cluster: str = "prediction") -> float:
    """Mean silhouette under squared Euclidean distance, for two clusters or more.

    No pair of rows is formed: one pass sums up each cluster, and a second one
    compares every row with these sums.
    """
    return ClusteringEvaluator(featuresCol=vector, predictionCol=cluster).evaluate(df)


def weighted_silhouette(df: DataFrame, vector: str, cluster: str, weight: str) -> float:
    """The silhouette of rows that each stand for ``weight`` copies of themselves.

    The ML library leaves out a row with all its weight where it is compared with its
    own cluster; here a copy is compared with the others of its kind, as it is without
    weights. The mean squared distance to a cluster is that to its mean and the mean
    square about the mean; one row per cluster reaches the driver.
    """
    mean = Summarizer.metrics("mean").summary(F.col(vector), F.col(weight)).alias("s")
    sums = df.groupBy(F.col(cluster).alias("c")).agg(F.sum(weight).alias("n"), mean)
    found = sums.select("c", "n", as_array("s.mean").alias("mean")).orderBy("c").collect()
    own = F.array_position(F.array(*[F.lit(r["c"]) for r in found]), F.col(cluster)).cast("int")
    rows = _with_distances(df.select(vector, cluster, F.col(weight).alias("_w")), vector, [r["mean"] for r in found])
    rows = rows.withColumn("_own", own)
    spread = rows.groupBy("_own").agg(F.sum(F.element_at("_distances", F.col("_own")) * F.col("_w")).alias("q")).collect()
    of_own = {r["_own"]: r["q"] for r in spread}
    about = F.array(*[F.lit(float(of_own[i] / r["n"])) for i, r in enumerate(found, start=1)])
    size = F.element_at(F.array(*[F.lit(float(r["n"])) for r in found]), F.col("_own"))
    rows = rows.select("_own", "_w", size.alias("_n"), F.zip_with("_distances", about, lambda d, q: d + q).alias("_far"))
    a = F.element_at("_far", F.col("_own")) * F.col("_n") / (F.col("_n") - 1)
    b = F.array_min(F.transform("_far", lambda d, i: F.when(i + 1 != F.col("_own"), d)))
    rows = rows.select("_w", "_n", F.when(F.col("_n") > 1, a).alias("_a"), b.alias("_b"))
    s = F.when(F.col("_a") < F.col("_b"), 1 - F.col("_a") / F.col("_b")).when(F.col("_a") > F.col("_b"), F.col("_b") / F.col("_a") - 1)
    return rows.agg(F.sum(F.coalesce(s, F.lit(0.0)) * F.col("_w")) / F.sum("_w")).first()[0]


# --- k-means -----------------------------------------------------------------


def _kmeans(rows: DataFrame, vector: str, k: int, seed: int, **params) -> KMeansModel:
    return KMeans(
        featuresCol=vector, predictionCol="prediction", k=k, seed=seed, **params
    ).fit(rows)


def fit_kmeans(
    df: DataFrame, vector: str, k: int, seed: int, *, rows_per_part: int | None = None, **params
) -> KMeansModel:
    """One k-means fit, the feature vectors held while it iterates.

    Centres depend on how rows lie in partitions, not on the seed alone.
    """
    with held(df, vector, rows_per_part=rows_per_part) as rows:
        return _kmeans(rows, vector, k, seed, **params)


def assign(df: DataFrame, model: KMeansModel) -> DataFrame:
    """Add the int ``prediction`` column; extra columns of ``df`` are kept."""
    return model.transform(df)


def distinct_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Each vector once, with its number of rows in ``_weight``; rows lie the same way in every run."""
    counted = df.groupBy(vector).agg(F.count("*").cast("double").alias("_weight"))
    return counted.sortWithinPartitions(F.xxhash64(vector))


def kmeans_sweep(
    df: DataFrame,
    vector: str,
    ks: Iterable[int] = range(2, 7),
    *,
    seed: int,
    parallelism: int = 1,
    rows_per_part: int | None = None,
    **params,
) -> Sweep:
    """Fit and score every k: rows (k, silhouette, training_cost).

    Only the feature vectors are held between the passes, each once and with its
    number of rows as weight, so that the passes grow with the distinct vectors.
    ``parallelism`` works on that many values of k at a time. A fit that ends with
    a single cluster has a null silhouette.
    """
    ks = list(ks)
    weighted = distinct_vectors(df, vector)
    with held(weighted, vector, "_weight", rows_per_part=rows_per_part) as rows:

        def run(k: int) -> tuple[KMeansModel, float | None]:
            model = _kmeans(rows, vector, k, seed, weightCol="_weight", **params)
            several = len(model.clusterCenters()) > 1
            return model, weighted_silhouette(model.transform(rows), vector, "prediction", "_weight") if several else None

        with ThreadPoolExecutor(parallelism) as pool:
            results = list(pool.map(inheritable_thread_target(df.sparkSession)(run), ks))
    models = {k: model for k, (model, _) in zip(ks, results)}
    scores = [(k, s, float(m.summary.trainingCost)) for k, (m, s) in zip(ks, results)]
    return Sweep(
        models,
        df.sparkSession.createDataFrame(
            scores, "k int, silhouette double, training_cost double"
        ),
    )


# --- tables about clusters ---------------------------------------------------


def model_centers(spark, model: KMeansModel) -> DataFrame:
    """Fitted centres as rows (cluster, dim, value)."""
    rows = [
        (cluster, dim, float(v))
        for cluster, center in enumerate(model.clusterCenters())
        for dim, v in enumerate(center)
    ]
    return spark.createDataFrame(rows, "cluster int, dim int, value double")


def group_centers(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Mean vector of each cluster as rows (cluster, dim, value)."""
    return cluster_stats(df, vector, cluster).select(
        "cluster", F.posexplode("mean").alias("dim", "value")
    )


def cluster_profile(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Row count and avg, min and max of every feature, per cluster."""
    parts = [
        f(F.col(c).cast("double")).alias(f"{f.__name__}_{c}")
        for c in features
        for f in (F.avg, F.min, F.max)
    ]
    return df.groupBy(cluster).agg(F.count("*").alias("n_rows"), *parts)


def array_vector(column: str) -> Column:
    """array<float|double> column to ML vector."""
    return array_to_vector(F.col(column).cast("array<double>"))
