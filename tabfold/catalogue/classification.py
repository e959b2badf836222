from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.catalogue.registry import LINE_KEYS, LINE_TRAIN_SQL, bucket_sql, registered
from tabfold.catalogue.text import HASHED
from tabfold.functions import as_array, cast_label, threshold_label
from tabfold.operators.holding import ROWS_PER_PART
from tabfold.operators.features import assembler
from tabfold.operators.models import chain, coefficients, decision_tree, fit, logistic_regression
from tabfold.operators.relational import project
from tabfold.plans.classification import classify
from tabfold.plans.sentiment import sentiment
from tabfold.sources import load_table

REG_PARAM = 0.01

# A line's "delay" follows its quantity, with the discount as noise.
DELAY = "l_quantity + 200 * l_discount"
DELAY_LIMIT = 35
LATE_SQL = f"({DELAY} > {DELAY_LIMIT})"


def _lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    lines = load_table(spark, folder, "lineitem").withColumn("delay", F.expr(DELAY))
    return project(lines, *columns, label=threshold_label("delay", DELAY_LIMIT))


# Best single split of a feature by Gini gain: impurity times size, summed over the
# two sides, is smallest at the best threshold.
STUMP = f"""
WITH v AS (
  SELECT floor(l_quantity / 5)::integer AS step, count(*)::double AS n,
    sum({LATE_SQL}::integer)::double AS pos
  FROM lineitem GROUP BY 1
),
cuts AS (
  SELECT step, sum(n) OVER w AS ln, sum(pos) OVER w AS lp,
    sum(n) OVER () AS tn, sum(pos) OVER () AS tp,
    lead(step) OVER (ORDER BY step) AS following
  FROM v WINDOW w AS (ORDER BY step ROWS UNBOUNDED PRECEDING)
),
best AS (
  SELECT (step + following) / 2.0 AS threshold, lp / ln AS left_share,
    (tp - lp) / (tn - ln) AS right_share
  FROM cuts WHERE following IS NOT NULL
  ORDER BY lp * (1 - lp / ln) + (tp - lp) * (1 - (tp - lp) / (tn - ln)), step LIMIT 1
)
SELECT step, n::bigint AS n_rows,
  CASE WHEN (CASE WHEN step <= threshold THEN left_share ELSE right_share END) > 0.5
       THEN 1.0::double ELSE 0.0::double END AS prediction
FROM v, best
"""


@registered(STUMP)
def tree_stump(spark: SparkSession, folder: str) -> DataFrame:
    step = F.floor(F.col("l_quantity") / 5).cast("int")
    lines = _lines(spark, folder, "l_quantity").withColumn("step", step)
    steps = chain(assembler(["step"]), decision_tree(maxDepth=1))
    scored = fit(steps, lines, ["features", "label"], rows_per_part=ROWS_PER_PART).transform(lines)
    return scored.groupBy("step", "prediction").agg(F.count("*").alias("n_rows"))


@registered()
def tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The seven-stage workflow; held-out rows with their predictions."""
    result = classify(
        _lines(spark, folder, *LINE_KEYS, "l_returnflag", "l_suppkey", "l_quantity"),
        "l_returnflag",
        ["l_linenumber", "l_suppkey"],
        ["l_quantity"],
        keys=LINE_KEYS,
        carry=LINE_KEYS,
    )
    return result.predictions.drop("features")


# A tree in SQL, level by level, over one row per distinct combination of features.
# A node is cut where the two sides' summed impurity is least; categories are first
# ordered by their number of late rows, which is the ML library's order for two
# classes. Every distinct quantity is a candidate, as the tree gets more bins than
# there are quantities.
TREE_DEPTH, TREE_BINS = 5, 64
TREE_LATE = "l_quantity + 200 * l_discount + 3 * l_linenumber + 300 * l_tax"
TREE_LIMIT = 60
QUANTITY = 4
TREE_FEATURES = {1: "ascii(l_returnflag)", 2: "l_linenumber", 3: "l_tax", QUANTITY: "l_quantity"}


def _tree_level(d: int) -> str:
    values = " UNION ALL ".join(
        f"SELECT node, {f} AS f, x{f}::double AS v, sum(n) AS n, sum(pos) AS pos "
        f"FROM r{d} WHERE n > 0 GROUP BY node, x{f}"
        for f in TREE_FEATURES
    )
    return f"""
o{d} AS (
  SELECT node, f, v, row_number() OVER w AS rk, sum(n) OVER w AS ln, sum(pos) OVER w AS lp,
    sum(n) OVER (PARTITION BY node, f) AS tn, sum(pos) OVER (PARTITION BY node, f) AS tp
  FROM ({values}) u
  WINDOW w AS (PARTITION BY node, f ORDER BY CASE f WHEN {QUANTITY} THEN v ELSE pos END, v
               ROWS UNBOUNDED PRECEDING)
),
c{d} AS (
  SELECT node, f, rk FROM (
    SELECT *, lp * (1 - lp / ln) + (tp - lp) * (1 - (tp - lp) / (tn - ln)) AS impurity
    FROM o{d} WHERE ln < tn) q
  WHERE tp * (1 - tp / tn) - impurity > 1e-9
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY impurity, f, rk) = 1
),
b{d} AS (
  SELECT c.node, c.f, list(o.v) AS lefts, max(o.v) AS top
  FROM c{d} c JOIN o{d} o ON o.node = c.node AND o.f = c.f AND o.rk <= c.rk GROUP BY 1, 2
),
r{d + 1} AS (
  SELECT r.* EXCLUDE (node), CASE
    WHEN b.node IS NULL THEN r.node
    WHEN b.f = {QUANTITY} AND x{QUANTITY} <= top THEN 2 * r.node
    WHEN b.f < {QUANTITY} AND list_contains(lefts, (CASE b.f
      {' '.join(f'WHEN {f} THEN x{f}' for f in TREE_FEATURES)} END)::double) THEN 2 * r.node
    ELSE 2 * r.node + 1 END AS node
  FROM r{d} r LEFT JOIN b{d} b ON b.node = r.node
)"""


TREE = f"""
WITH rows_ AS (
  SELECT {', '.join(LINE_KEYS)}, {', '.join(f'{e} AS x{f}' for f, e in TREE_FEATURES.items())},
    {LINE_TRAIN_SQL} AS train, {TREE_LATE} > {TREE_LIMIT} AS late
  FROM lineitem
),
r1 AS (
  SELECT {', '.join(f'x{f}' for f in TREE_FEATURES)}, 1 AS node,
    sum(train::integer)::double AS n, sum((train AND late)::integer)::double AS pos
  FROM rows_ GROUP BY {', '.join(f'x{f}' for f in TREE_FEATURES)}
),
{','.join(_tree_level(d) for d in range(1, TREE_DEPTH + 1))},
leaves AS (SELECT node, sum(pos) > sum(n - pos) AS late FROM r{TREE_DEPTH + 1} GROUP BY node)
SELECT {', '.join(LINE_KEYS)}, leaves.late::integer::double AS prediction,
  rows_.late::integer::double AS "trueLabel"
FROM rows_ JOIN r{TREE_DEPTH + 1} USING ({', '.join(f'x{f}' for f in TREE_FEATURES)})
JOIN leaves USING (node) WHERE NOT train
"""


@registered(TREE)
def tree_workflow(spark: SparkSession, folder: str) -> DataFrame:
    """The seven-stage workflow on features whose every value is a candidate cut."""
    lines = load_table(spark, folder, "lineitem").withColumn("late", F.expr(TREE_LATE))
    result = classify(
        project(
            lines,
            *LINE_KEYS,
            "l_returnflag",
            "l_tax",
            "l_quantity",
            label=threshold_label("late", TREE_LIMIT),
        ),
        "l_returnflag",
        ["l_linenumber", "l_tax"],
        ["l_quantity"],
        keys=LINE_KEYS,
        carry=LINE_KEYS,
        maxDepth=TREE_DEPTH,
        maxBins=TREE_BINS,
    )
    return result.predictions.drop("features")


# Newton steps to the penalised optimum, over one row per distinct feature value.
# The penalty applies to the weight on the standardised feature, not to the intercept.
LOGISTIC = f"""
WITH RECURSIVE g AS (
  SELECT l_quantity AS x, count(*)::double AS n,
    sum({LATE_SQL}::integer)::double AS pos
  FROM lineitem GROUP BY 1
),
c AS (SELECT count(*)::double AS total, {REG_PARAM} * var_samp(l_quantity) AS ridge FROM lineitem),
newton(i, a, b) AS (
  SELECT 0, 0.0::double, 0.0::double
  UNION ALL
  SELECT i + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab),
    b - (haa * gb - hab * ga) / (haa * hbb - hab * hab)
  FROM (
    SELECT i, a, b, sum(n * p - pos) / total AS ga,
      sum((n * p - pos) * x) / total + ridge * b AS gb,
      sum(n * p * (1 - p)) / total AS haa, sum(n * p * (1 - p) * x) / total AS hab,
      sum(n * p * (1 - p) * x * x) / total + ridge AS hbb
    FROM (SELECT i, a, b, x, n, pos, total, ridge, 1 / (1 + exp(-(a + b * x))) AS p
          FROM newton, g, c WHERE i < 20) t
    GROUP BY i, a, b, total, ridge
  ) s
)
SELECT 'intercept' AS term, round(a, 5) AS value FROM newton WHERE i = 20
UNION ALL SELECT 'l_quantity', round(b, 5) FROM newton WHERE i = 20
"""


@registered(LOGISTIC)
def logistic_fit(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder, "l_quantity")
    # Run to convergence, so that the optimum itself can be compared.
    logit = logistic_regression(regParam=REG_PARAM, maxIter=100, tol=1e-8)
    model = fit(chain(assembler(["l_quantity"]), logit), lines, ["features", "label"], rows_per_part=ROWS_PER_PART)
    weights = coefficients(spark, model.stages[-1], ["l_quantity"])
    return weights.withColumn("value", F.round("value", 5))


@registered()
def sentiment_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The four-stage text workflow; held-out documents with their predictions."""
    texts = load_table(spark, folder, "documents").select("doc_id", "text")
    labels = load_table(spark, folder, "labels").select("doc_id", "quality")
    data = project(texts.join(labels, "doc_id"), "doc_id", "text", label=cast_label("quality"))
    return sentiment(data, "text", keys=["doc_id"], rows_per_part=ROWS_PER_PART).predictions("doc_id")


TWO_SLOTS = 2
DOC_BUCKET = bucket_sql("doc_id::varchar", 10)

# The text model with two hash slots: counts per slot by the hash written out in SQL,
# then Newton steps to the penalised optimum. The three unknowns of a step are solved
# by cofactors.
SENTIMENT_SQL = f"""
WITH RECURSIVE hashed AS ({HASHED}),
rows AS (
  SELECT l.doc_id, quality::double AS y, {DOC_BUCKET} < 7 AS train,
    coalesce(sum(n) FILTER (slot % {TWO_SLOTS} = 0), 0.0::double) AS u,
    coalesce(sum(n) FILTER (slot % {TWO_SLOTS} = 1), 0.0::double) AS v
  FROM labels l JOIN documents d USING (doc_id) LEFT JOIN hashed h USING (doc_id) GROUP BY ALL
),
c AS (
  SELECT count(*)::double AS total, {REG_PARAM} * var_samp(u) AS ru, {REG_PARAM} * var_samp(v) AS rv
  FROM rows WHERE train
),
newton(i, a, bu, bv) AS (
  SELECT 0, 0.0::double, 0.0::double, 0.0::double
  UNION ALL
  SELECT i + 1,
    a - (ga * (huu * hvv - huv * huv) + gu * (hav * huv - hau * hvv) + gv * (hau * huv - hav * huu)) / det,
    bu - (ga * (hav * huv - hau * hvv) + gu * (haa * hvv - hav * hav) + gv * (hau * hav - haa * huv)) / det,
    bv - (ga * (hau * huv - hav * huu) + gu * (hau * hav - haa * huv) + gv * (haa * huu - hau * hau)) / det
  FROM (
    SELECT *, haa * (huu * hvv - huv * huv) - hau * (hau * hvv - huv * hav) + hav * (hau * huv - huu * hav) AS det
    FROM (
      SELECT i, a, bu, bv, sum(p - y) / total AS ga,
        sum((p - y) * u) / total + ru * bu AS gu, sum((p - y) * v) / total + rv * bv AS gv,
        sum(q) / total AS haa, sum(q * u) / total AS hau, sum(q * v) / total AS hav,
        sum(q * u * u) / total + ru AS huu, sum(q * u * v) / total AS huv, sum(q * v * v) / total + rv AS hvv
      FROM (SELECT *, p * (1 - p) AS q FROM (
        SELECT i, a, bu, bv, u, v, y, total, ru, rv, 1 / (1 + exp(-(a + bu * u + bv * v))) AS p
        FROM newton, rows, c WHERE train AND i < 25) t) t2
      GROUP BY i, a, bu, bv, total, ru, rv
    ) h
  ) k
)
SELECT doc_id, y::integer AS "trueLabel", round(1 / (1 + exp(-(a + bu * u + bv * v))), 4) AS probability,
  (a + bu * u + bv * v > 0)::integer::double AS prediction
FROM rows, newton WHERE NOT train AND i = 25
"""


@registered(SENTIMENT_SQL)
def sentiment_converged(spark: SparkSession, folder: str) -> DataFrame:
    """All four stages on few hash slots, run to the optimum, which SQL can state."""
    texts = load_table(spark, folder, "documents").select("doc_id", "text")
    labels = load_table(spark, folder, "labels").select("doc_id", "quality")
    data = project(texts.join(labels, "doc_id"), "doc_id", "text", label=cast_label("quality"))
    scored = sentiment(data, "text", keys=["doc_id"], size=TWO_SLOTS, max_iter=500, tol=1e-12, rows_per_part=ROWS_PER_PART).scored
    return scored.select(
        "doc_id", "trueLabel", F.round(as_array("probability")[1], 4).alias("probability"), "prediction"
    )
