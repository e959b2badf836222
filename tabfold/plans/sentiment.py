"""Sentiment of short texts by logistic regression on hashed words."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tabfold.functions import cast_label
from tabfold.operators.models import chain, fit, logistic_regression, score
from tabfold.operators.relational import project
from tabfold.operators.text import HASHED_SIZE, stop_word_remover, term_hasher, tokenizer
from tabfold.plans.holdout import BUCKETS, Holdout, hold_out
from tabfold.sources import read_csv

# Iteration limit and penalty of the classifier, the tolerance it has
# by default, and the names of the word columns in the scored tweets.
MAX_ITER = 10
REG_PARAM = 0.01
TOL = 1e-6
WORDS_COLUMN = "SentimentWords"
KEPT_COLUMN = "MeaningfulWords"


@dataclass(frozen=True)
class Sentiment:
    holdout: Holdout
    model: PipelineModel
    scored: DataFrame

    def predictions(self, *carry: str) -> DataFrame:
        return self.scored.select(*carry, "prediction", "trueLabel")


def sentiment(
    data: DataFrame,
    text: str,
    *,
    keys: Sequence[str] | None = None,
    seed: int = 0,
    words_column: str = "words",
    kept_column: str = "kept_words",
    size: int = HASHED_SIZE,
    max_iter: int = MAX_ITER,
    tol: float = TOL,
    aggregation_depth: int = 2,
    rows_per_part: int | None = None,
    buckets: int = BUCKETS,
) -> Sentiment:
    """Words, less stop words, hashed and counted, then logistic regression.

    ``data`` has the text and an int ``label``. Each iteration merges a gradient
    of ``size`` numbers per task; with very many tasks raise
    ``aggregation_depth``.
    """
    parts = hold_out(data, keys=keys, seed=None if keys else seed, buckets=buckets)
    words = tokenizer(text, words_column)
    kept = stop_word_remover(words.getOutputCol(), kept_column)
    hashed = term_hasher(kept.getOutputCol(), "features", size)
    model = logistic_regression(
        hashed.getOutputCol(),
        maxIter=max_iter,
        tol=tol,
        regParam=REG_PARAM,
        aggregationDepth=aggregation_depth,
    )
    fitted = fit(
        chain(words, kept, hashed, model),
        parts.train.select(text, "label"),
        ["features", "label"],
        rows_per_part=rows_per_part,
    )
    return Sentiment(parts, fitted, score(fitted, parts.test))


def tweet_sentiment(
    spark: SparkSession,
    path: str,
    *,
    seed: int = 0,
    keys: Sequence[str] | None = None,
    infer: bool = False,
    csv: Mapping | None = None,
    **options,
) -> Sentiment:
    """The workflow on a tweets CSV file.

    The label is cast from text, which spares the pass over the file that type
    inference takes; labels written as decimals need ``infer=True``. Doubled
    quotes inside a quoted text are read as one quote. ``csv`` holds reader options,
    such as ``multiLine`` for texts with line breaks. ``keys`` names columns of the
    file that identify a row, for a split that neither copies nor sorts.
    """
    tweets = read_csv(spark, path, infer=infer, **({"escape": '"'} | dict(csv or {})))
    extra = [k for k in keys or () if k != "SentimentText"]
    data = project(tweets, "SentimentText", *extra, label=cast_label("Sentiment"))
    return sentiment(
        data,
        "SentimentText",
        keys=keys,
        seed=seed,
        words_column=WORDS_COLUMN,
        kept_column=KEPT_COLUMN,
        **options,
    )
