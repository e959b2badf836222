from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.catalogue.registry import (
    LINE_FOLD_SQL,
    LINE_KEYS,
    LINE_TEST_SQL,
    LINE_TRAIN_SQL,
    registered,
)
from tabfold.operators.holding import ROWS_PER_PART
from tabfold.operators.features import assemble, assembler, minmax_scaler
from tabfold.operators.metrics import rmse
from tabfold.operators.models import chain, coefficients, fit, linear_regression, score
from tabfold.operators.moments import predict, ridge_search
from tabfold.operators.relational import project
from tabfold.operators.splits import with_hash_fold
from tabfold.operators.tuning import cross_validate_ridge, grid
from tabfold.plans.holdout import hold_out
from tabfold.plans.regression import MAX_ITERS, REG_PARAMS, tuned_regression
from tabfold.sources import load_table, sql

FIVE = ["l_quantity", "l_linenumber", "l_discount", "l_tax", "l_suppkey"]
# A target that the features explain in part; the price adds noise.
TARGET = "l_quantity + 200 * l_discount + 3 * l_linenumber + l_extendedprice / 5000"
LAMBDA = 0.3
SEED = 11


# --- oracle text ---------------------------------------------------------------


def _columns_sql(features: Sequence[str]) -> str:
    return ", ".join(f"{f}::double AS x{i}" for i, f in enumerate(features, start=1))


def _solve_sql(features: Sequence[str], systems: str, lambdas: Sequence[float]) -> str:
    """CTEs that fit one ridge regression per row set and penalty.

    ``systems`` yields (s, x1.., y). The normal equations on standardised columns
    are solved by elimination; ``fits`` has (s, lam, b DOUBLE[], a).
    """
    p = range(1, len(features) + 1)
    wide = len(features) + 1
    matrix = ", ".join(
        "["
        + ", ".join(
            [("1.0 + lam / sdy" if i == j else f"c{min(i, j)}_{max(i, j)}") for j in p] + [f"r{i}"]
        )
        + "]"
        for i in p
    )
    pairs = ", ".join(f"corr(x{i}, x{j}) AS c{i}_{j}" for i in p for j in p if i < j)
    return f"""
systems AS ({systems}),
moments AS (
  SELECT s, {pairs + ', ' if pairs else ''}
    {', '.join(f'corr(x{i}, y) AS r{i}, stddev_pop(x{i}) AS sd{i}, avg(x{i}) AS m{i}' for i in p)},
    stddev_pop(y) AS sdy, avg(y) AS my
  FROM systems GROUP BY s
),
penalties(lam) AS (VALUES {', '.join(f'({v}::double)' for v in lambdas)}),
elimination(s, lam, k, m) AS (
  SELECT s, lam, 1, [{matrix}]::double[][] FROM moments, penalties
  UNION ALL
  SELECT s, lam, k + 1,
    [CASE WHEN i = k THEN [v / m[k][k] for v in m[k]]
          ELSE [m[i][j] - m[i][k] * m[k][j] / m[k][k] for j in range(1, {wide + 1})] END
     for i in range(1, {wide})]
  FROM elimination WHERE k < {wide}
),
weights AS (
  SELECT s, lam, my, {', '.join(f'm[{i}][{wide}] * sdy / sd{i} AS b{i}, m{i}' for i in p)}
  FROM elimination JOIN moments USING (s) WHERE k = {wide}
),
fits AS (
  SELECT s, lam, {', '.join(f'b{i}' for i in p)},
    my - ({' + '.join(f'b{i} * m{i}' for i in p)}) AS a FROM weights
)"""


def _predicted(features: Sequence[str]) -> str:
    return "a + " + " + ".join(f"b{i} * x{i}" for i in range(1, len(features) + 1))


def _fit_sql(features: Sequence[str], penalty: float) -> str:
    systems = f"SELECT 0 AS s, {_columns_sql(features)}, {TARGET} AS y FROM lineitem"
    terms = [("intercept", "a")] + [(f, f"b{i}") for i, f in enumerate(features, start=1)]
    picked = " UNION ALL ".join(
        f"SELECT '{t}' AS term, round({c}, 6) AS value FROM fits" for t, c in terms
    )
    return f"WITH RECURSIVE {_solve_sql(features, systems, [penalty])} {picked}"


def _search_sql(features: Sequence[str], tail: str) -> str:
    """``scores`` (lam, metric) over two folds, ``chosen`` (lam), and ``holdout`` (rmse)."""
    columns = f"{_columns_sql(features)}, {TARGET} AS y"
    # Row set 0 and 1: everything but that fold. Row set 2: all training rows.
    systems = f"""
  SELECT t.s, v.* EXCLUDE (fold) FROM
    (SELECT {LINE_FOLD_SQL} AS fold, {columns} FROM lineitem WHERE {LINE_TRAIN_SQL}) v
    JOIN (VALUES (0), (1), (2)) t(s) ON t.s <> v.fold"""
    return f"""
WITH RECURSIVE {_solve_sql(features, systems, REG_PARAMS)},
scores AS (
  SELECT lam, avg(e) AS metric FROM (
    SELECT lam, s, sqrt(avg((y - ({_predicted(features)})) ** 2)) AS e
    FROM (SELECT {LINE_FOLD_SQL} AS fold, {columns} FROM lineitem WHERE {LINE_TRAIN_SQL}) v
    JOIN fits ON fits.s = v.fold GROUP BY lam, s) f
  GROUP BY lam
),
chosen AS (SELECT lam FROM scores ORDER BY metric, lam DESC LIMIT 1),
holdout AS (
  SELECT sqrt(avg((y - ({_predicted(features)})) ** 2)) AS rmse
  FROM (SELECT {columns} FROM lineitem WHERE {LINE_TEST_SQL}) v, fits
  WHERE s = 2 AND lam = (SELECT lam FROM chosen)
)
{tail}"""


GRID_SQL = ", ".join(
    f"({i}, {r}::double, {m}::double)"
    for i, (r, m) in enumerate((r, m) for r in REG_PARAMS for m in MAX_ITERS)
)
METRICS_TAIL = f"""
SELECT g.grid_index, g."regParam", g."maxIter", round(metric, 6) AS metric
FROM (VALUES {GRID_SQL}) g(grid_index, "regParam", "maxIter") JOIN scores ON lam = g."regParam" """
PENALTIES_TAIL = f"""
SELECT g.grid_index, g."regParam", round(metric, 6) AS metric
FROM (VALUES {', '.join(f'({i}, {r}::double)' for i, r in enumerate(REG_PARAMS))})
  g(grid_index, "regParam") JOIN scores ON lam = g."regParam" """


# --- fits ------------------------------------------------------------------------


def _lines(spark: SparkSession, folder: str, features: Sequence[str]) -> DataFrame:
    extra = [f for f in features if f not in LINE_KEYS]
    return project(
        load_table(spark, folder, "lineitem"), *LINE_KEYS, *extra, label=F.expr(TARGET)
    )


def _fitted(spark: SparkSession, folder: str, features: list[str], penalty: float) -> DataFrame:
    vectors = assemble(_lines(spark, folder, features), features).select("features", "label")
    model = linear_regression(regParam=penalty).fit(vectors)
    return coefficients(spark, model, features).withColumn("value", F.round("value", 6))


@registered(_fit_sql(["l_quantity"], 0.0))
def linear_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted(spark, folder, ["l_quantity"], 0.0)


@registered(_fit_sql(["l_quantity"], LAMBDA))
def ridge_fit_1(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted(spark, folder, ["l_quantity"], LAMBDA)


@registered(_fit_sql(["l_quantity", "l_discount"], LAMBDA))
def ridge_fit_2(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted(spark, folder, ["l_quantity", "l_discount"], LAMBDA)


@registered(_fit_sql(FIVE, LAMBDA))
def ridge_fit_5(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted(spark, folder, FIVE, LAMBDA)


# --- held-out rows -----------------------------------------------------------------

HOLDOUT_SYSTEM = (
    f"SELECT 0 AS s, {_columns_sql(['l_quantity'])}, {TARGET} AS y "
    f"FROM lineitem WHERE {LINE_TRAIN_SQL}"
)


def _held_out_scores(spark: SparkSession, folder: str) -> DataFrame:
    parts = hold_out(_lines(spark, folder, ["l_quantity"]), keys=LINE_KEYS)
    assemble_stage = assembler(["l_quantity"])
    scale = minmax_scaler(assemble_stage.getOutputCol(), "normFeatures")
    line = linear_regression(scale.getOutputCol(), regParam=LAMBDA)
    model = fit(chain(assemble_stage, scale, line), parts.train, ["features", "label"], rows_per_part=ROWS_PER_PART)
    return score(model, parts.test, *LINE_KEYS, "prediction", "trueLabel")


@registered(
    f"WITH RECURSIVE {_solve_sql(['l_quantity'], HOLDOUT_SYSTEM, [LAMBDA])} "
    f'SELECT l_orderkey, l_linenumber, l_partkey, {TARGET} AS "trueLabel", '
    f"round(a + b1 * l_quantity, 6) AS prediction FROM lineitem, fits WHERE {LINE_TEST_SQL}"
)
def linear_predict(spark: SparkSession, folder: str) -> DataFrame:
    return _held_out_scores(spark, folder).withColumn("prediction", F.round("prediction", 6))


@registered(
    f"WITH RECURSIVE {_solve_sql(['l_quantity'], HOLDOUT_SYSTEM, [LAMBDA])} "
    f'SELECT {TARGET} AS "trueLabel", round(a + b1 * l_quantity, 6) AS prediction '
    f"FROM lineitem, fits WHERE {LINE_TEST_SQL}"
)
def predictions_view(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions read back by name through SQL."""
    return sql(
        spark,
        "SELECT trueLabel, round(prediction, 6) AS prediction FROM predicted_lines",
        predicted_lines=_held_out_scores(spark, folder),
    )


@registered(
    f"WITH RECURSIVE {_solve_sql(['l_quantity'], HOLDOUT_SYSTEM, [LAMBDA])} "
    f"SELECT round(sqrt(avg(({TARGET} - (a + b1 * l_quantity)) ** 2)), 6) AS rmse "
    f"FROM lineitem, fits WHERE {LINE_TEST_SQL}"
)
def rmse_holdout(spark: SparkSession, folder: str) -> DataFrame:
    errors = rmse(_held_out_scores(spark, folder), "trueLabel")
    return errors.select(F.round("rmse", 6).alias("rmse"))


# --- search ------------------------------------------------------------------------


def _train_with_folds(spark: SparkSession, folder: str, features: Sequence[str]) -> DataFrame:
    train = hold_out(_lines(spark, folder, features), keys=LINE_KEYS).train
    return with_hash_fold(train, LINE_KEYS, 2).select(*features, "label", "fold")


def _cross_validated(spark: SparkSession, folder: str):
    assemble_stage = assembler(["l_quantity"])
    scale = minmax_scaler(assemble_stage.getOutputCol(), "normFeatures")
    line = linear_regression(scale.getOutputCol())
    return cross_validate_ridge(
        _train_with_folds(spark, folder, ["l_quantity"]),
        ["l_quantity"],
        chain(assemble_stage, scale, line),
        grid([(line.regParam, REG_PARAMS), (line.maxIter, MAX_ITERS)]),
        folds=2,
        fold_column="fold",
    )


@registered(_search_sql(["l_quantity"], METRICS_TAIL))
def cv_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = _cross_validated(spark, folder).metrics
    return metrics.withColumn("metric", F.round("metric", 6))


@registered(
    _search_sql(
        ["l_quantity"],
        f"""SELECT g.grid_index, g."regParam", round(b1, 6) AS weight, round(a, 6) AS intercept
FROM (SELECT min(grid_index) AS grid_index, min("regParam") AS "regParam"
      FROM (VALUES {GRID_SQL}) v(grid_index, "regParam", "maxIter")
      WHERE "regParam" = (SELECT lam FROM chosen)) g, fits
WHERE s = 2 AND lam = g."regParam" """,
    )
)
def cv_best(spark: SparkSession, folder: str) -> DataFrame:
    """The winner refitted on all training rows, on the scale of the input column."""
    search = _cross_validated(spark, folder)
    _, scaler, line = search.best_model.stages
    low, high = scaler.originalMin[0], scaler.originalMax[0]
    weight = line.coefficients[0] / (high - low)
    return search.metrics.where(F.col("grid_index") == search.best_index).select(
        "grid_index",
        "regParam",
        F.round(F.lit(weight), 6).alias("weight"),
        F.round(F.lit(line.intercept - weight * low), 6).alias("intercept"),
    )


@registered(_search_sql(FIVE, PENALTIES_TAIL))
def ridge_search_metrics(spark: SparkSession, folder: str) -> DataFrame:
    train = _train_with_folds(spark, folder, FIVE)
    metrics = ridge_search(train, FIVE, "label", "fold", REG_PARAMS, folds=2).metrics
    return metrics.withColumn("metric", F.round("metric", 6))


@registered(_search_sql(FIVE, "SELECT round(rmse, 6) AS rmse FROM holdout"))
def ridge_search_rmse(spark: SparkSession, folder: str) -> DataFrame:
    """The one-pass search, refitted and scored on the held-out rows."""
    parts = hold_out(_lines(spark, folder, FIVE), keys=LINE_KEYS)
    best = ridge_search(
        with_hash_fold(parts.train, LINE_KEYS, 2), FIVE, "label", "fold", REG_PARAMS, folds=2
    ).best
    return rmse(predict(parts.test, best, FIVE), "trueLabel").select(F.round("rmse", 6).alias("rmse"))


@registered(_search_sql(FIVE, "SELECT round(rmse, 6) AS rmse FROM holdout"))
def flight_like_regression(spark: SparkSession, folder: str) -> DataFrame:
    """The whole tuned workflow on five features: search, refit, held-out error."""
    tuned = tuned_regression(
        _lines(spark, folder, FIVE), FIVE, keys=LINE_KEYS, seed=SEED, search="moments"
    )
    return tuned.rmse.select(F.round("rmse", 6).alias("rmse"))


# --- a wider search ------------------------------------------------------------------

# Twenty-one features: the five, their products in pairs, and their squares and a cube.
WIDE_PARTS = {f"{a}_{b}": f"{a} * {b}" for i, a in enumerate(FIVE) for b in FIVE[i:]}
WIDE_PARTS["l_quantity_cube"] = "l_quantity * l_quantity * l_quantity"
WIDE = [*FIVE, *WIDE_PARTS]
WIDE_LINES = "(SELECT *, " + ", ".join(f"({e})::double AS {n}" for n, e in WIDE_PARTS.items()) + " FROM lineitem)"


@registered(_search_sql(WIDE, PENALTIES_TAIL).replace("FROM lineitem", f"FROM {WIDE_LINES} lineitem"))
def ridge_search_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The one-pass search on twenty-one features, many of them nearly collinear."""
    lines = load_table(spark, folder, "lineitem").withColumns(
        {n: F.expr(f"cast({e} as double)") for n, e in WIDE_PARTS.items()}
    )
    extra = [f for f in WIDE if f not in LINE_KEYS]
    train = hold_out(project(lines, *LINE_KEYS, *extra, label=F.expr(TARGET)), keys=LINE_KEYS).train
    folded = with_hash_fold(train, LINE_KEYS, 2)
    metrics = ridge_search(folded, WIDE, "label", "fold", REG_PARAMS, folds=2).metrics
    return metrics.withColumn("metric", F.round("metric", 6))
