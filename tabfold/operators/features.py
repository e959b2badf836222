"""Feature columns: assembling, scaling, and string and category indexing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import (
    MinMaxScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabfold.functions import as_array, rescale
from tabfold.operators.positions import with_position

# Labels are broadcast up to this size, the most frequent first; of a larger table
# at most so many labels.
BROADCAST_BYTES = 64 << 20
HOT_LABELS = 10_000


# --- stages for ML pipelines -------------------------------------------------


def assembler(
    columns: Sequence[str], out: str = "features", handle_invalid: str = "error"
) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=handle_invalid)


def minmax_scaler(column: str, out: str = "scaled") -> MinMaxScaler:
    return MinMaxScaler(inputCol=column, outputCol=out)


def string_indexer(column: str, out: str, handle_invalid: str = "error") -> StringIndexer:
    return StringIndexer(inputCol=column, outputCol=out, handleInvalid=handle_invalid)


def category_indexer(
    column: str, out: str, max_categories: int = 20, handle_invalid: str = "error"
) -> VectorIndexer:
    return VectorIndexer(
        inputCol=column, outputCol=out, maxCategories=max_categories, handleInvalid=handle_invalid
    )


# --- vectors -----------------------------------------------------------------


def assemble(
    df: DataFrame, columns: Sequence[str], out: str = "features", handle_invalid: str = "error"
) -> DataFrame:
    """Numeric or vector columns to one vector, in the order given."""
    return assembler(columns, out, handle_invalid).transform(df)


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Vector elements as scalar columns, in place of the vector.

    A vector of another length than ``names`` fails the query.
    """
    values = as_array(vector)
    unequal = F.raise_error(F.concat(F.lit(f"not {len(names)} elements but "), F.size(values).cast("string")))
    checked = F.when(values.isNotNull() & (F.size(values) != len(names)), unequal).otherwise(values)
    elements = {n: F.col("_values")[i] for i, n in enumerate(names)}
    return df.withColumn("_values", checked).withColumns(elements).drop("_values", vector)


# --- min-max scaling on plain columns ----------------------------------------


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Training range of each column: one aggregate, two numbers per column."""
    ends = df.agg(*[f(F.col(c)).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)])
    row = ends.first()
    return {c: (row[f"min_{c}"], row[f"max_{c}"]) for c in columns}


def minmax_columns(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]], suffix: str = "_scaled"
) -> DataFrame:
    return df.withColumns(
        {f"{c}{suffix}": rescale(F.col(c), low, high) for c, (low, high) in ranges.items()}
    )


# --- string indexing on plain columns ----------------------------------------


def string_labels(df: DataFrame, column: str) -> DataFrame:
    """(label, n, index): labels by descending frequency, ties in text order.

    Counts are combined in the map tasks, so a label on a third of all rows costs
    what any other label costs. The numbering is a distributed sort: neither the
    driver nor one task ever holds all labels.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("label"))
        .agg(F.count("*").alias("n"))
    )
    return with_position(counts, [F.desc("n"), F.asc("label")], "index")


def string_index_model(
    df: DataFrame, column: str, out: str, handle_invalid: str = "error", *, max_bytes: int = BROADCAST_BYTES
) -> StringIndexerModel:
    """The fitted indexer of a text column, from one count of its labels.

    The labels become a part of the model and pass through the driver, so more than
    ``max_bytes`` of them, as text, are refused.
    """
    labels = string_labels(df, column)
    size = labels.agg(F.sum(F.octet_length("label"))).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"the labels of column {column} take {size} bytes, more than {max_bytes}")
    found = [r["label"] for r in labels.select("label", "index").orderBy("index").collect()]
    return StringIndexerModel.from_labels(found, inputCol=column, outputCol=out, handleInvalid=handle_invalid)


def index_strings(
    df: DataFrame, column: str, labels: DataFrame, out: str, handle_invalid: str = "error"
) -> DataFrame:
    """Add each row's label index from a ``string_labels`` table, in one scan.

    The most frequent labels, up to ``BROADCAST_BYTES``, are broadcast. If that is
    not all of them, the rows still without an index take part in a shuffle join
    with the others; rows that are served, or null, go along under keys of their
    own that match nothing and are spread over all tasks.
    """
    sized = labels.select(
        F.col("label").alias("_label"), F.col("index").cast("double").alias("_index"), "n", (F.octet_length("label") + 32).alias("_bytes")
    )
    total = sized.agg(F.sum("_bytes").alias("bytes"), F.count("*").alias("n")).first()
    text = F.col(f"`{column}`").cast("string")
    if (total["bytes"] or 0) <= BROADCAST_BYTES:
        found = df.join(F.broadcast(sized.select("_label", "_index")), text == F.col("_label"), "left")
        return _settle(found, F.col("_index"), column, out, total["n"], handle_invalid).drop("_label", "_index")
    # At most HOT_LABELS rows are summed up in order.
    upto = F.sum("_bytes").over(Window.orderBy("_index").rowsBetween(Window.unboundedPreceding, 0))
    hot = sized.where(F.col("_index") < HOT_LABELS).withColumn("_upto", upto).where(F.col("_upto") <= BROADCAST_BYTES)
    n_hot = hot.count()
    head = sized.where(F.col("_index") < n_hot).select(F.col("_label").alias("_hot"), F.col("_index").alias("_hot_index"))
    rest = sized.where(F.col("_index") >= n_hot).select("_label", "_index")
    served = df.join(F.broadcast(head), text == F.col("_hot"), "left")
    waiting = F.col("_hot").isNull() & text.isNotNull()
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    keyed = served.withColumns({"_wanted": F.when(waiting, text), "_salt": F.when(waiting, F.lit(0).cast("long")).otherwise(spread)})
    on = (F.col("_wanted") == F.col("_label")) & (F.col("_salt") == F.col("_zero"))
    found = keyed.join(rest.withColumn("_zero", F.lit(0).cast("long")), on, "left")
    index = F.coalesce("_hot_index", "_index")
    return _settle(found, index, column, out, total["n"], handle_invalid).drop(
        "_label", "_index", "_hot", "_hot_index", "_wanted", "_salt", "_zero"
    )


def _settle(
    df: DataFrame, index: Column, column: str, out: str, n_known: int, handle_invalid: str
) -> DataFrame:
    """What becomes of values that the fit has not seen."""
    if handle_invalid == "skip":
        return df.withColumn(out, index).where(F.col(out).isNotNull())
    if handle_invalid == "keep":
        return df.withColumn(out, F.coalesce(index, F.lit(float(n_known))))
    if handle_invalid == "error":
        shown = F.coalesce(F.col(column).cast("string"), F.lit("null"))
        unseen = F.raise_error(F.concat(F.lit(f"unseen value in {column}: "), shown))
        return df.withColumn(out, F.when(index.isNull(), unseen).otherwise(index))
    raise ValueError("handle_invalid must be 'error', 'skip' or 'keep'")


# --- category indexing on plain columns --------------------------------------


def category_maps(
    df: DataFrame, columns: Sequence[str], max_categories: int = 20
) -> dict[str, dict[float, int]]:
    """Value-to-index maps of the columns with at most ``max_categories`` values.

    Each task keeps at most ``max_categories`` + 1 values per column, whatever
    the column's cardinality. Values ascend, except that zero comes first.
    """
    fitted = category_indexer("_vector", "_indexed", max_categories).fit(
        assemble(df.select(*columns), columns, "_vector").select("_vector")
    )
    return {columns[i]: dict(values) for i, values in fitted.categoryMaps.items()}


def index_categories(
    df: DataFrame,
    columns: Sequence[str],
    maps: Mapping[str, Mapping[float, int]],
    suffix: str = "_cat",
    handle_invalid: str = "error",
) -> DataFrame:
    """Columns with a map become indexes, the others pass as double."""
    for c in columns:
        if c in maps:
            pairs = [F.lit(v) for k, i in maps[c].items() for v in (float(k), float(i))]
            # + 0.0 turns a negative zero, which is another map key, into zero.
            index = F.try_element_at(F.create_map(*pairs), F.col(c).cast("double") + F.lit(0.0))
            df = _settle(df, index, c, f"{c}{suffix}", len(maps[c]), handle_invalid)
        else:
            df = df.withColumn(f"{c}{suffix}", F.col(c).cast("double"))
    return df
