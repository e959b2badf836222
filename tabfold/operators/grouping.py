"""Several groupings of one table from one pass over its rows.

The finest groups are aggregated first; the rows are read and shuffled once for that,
and each row is never repeated per grouping. Coarser groupings are aggregated from the
smallest finer result that has their columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tabfold.session import freeze

# How an aggregate is made of rows, and of such aggregates of finer groups.
MERGED = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def rollup_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dimensions[:n]) for n in range(len(dimensions), -1, -1)]


def cube_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(dimensions), -1, -1) for s in combinations(dimensions, n)]


def _partials(aggregates: Mapping[str, tuple[str, str]]) -> dict[str, tuple[str, str]]:
    """The mergeable aggregates that the wanted ones need; an average is a sum and a count."""
    found = {}
    for name, (kind, column) in aggregates.items():
        if kind == "avg":
            found |= {f"_sum_{name}": ("sum", column), f"_n_{name}": ("count", column)}
        elif kind in MERGED:
            found[name] = (kind, column)
        else:
            raise ValueError(f"{kind} of finer groups is not that of coarser ones")
    return found


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], aggregates: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The dimensions, null where a set lacks them, the aggregates, and ``grouping``.

    ``aggregates`` maps names to (count, sum, min, max or avg, column); ``*`` counts rows.
    ``grouping`` has a bit for each dimension, the first one highest, set where the
    dimension is rolled up, which tells such a null from one in the rows. The empty set
    has one row, also of no rows.
    """
    dimensions = list(dict.fromkeys(d for s in sets for d in s))
    partials = _partials(aggregates)
    own = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    first = [own[kind](column if column == "*" else F.col(column)).alias(name) for name, (kind, column) in partials.items()]
    held = {frozenset(dimensions): freeze(df.groupBy(*dimensions).agg(*first))}
    zero = [n for n, (kind, _) in partials.items() if kind == "count"]
    for wanted in sorted({frozenset(s) for s in sets}, key=len, reverse=True):
        if wanted in held:
            continue
        # The result with the fewest dimensions that still has these.
        finer = held[min((h for h in held if wanted < h), key=lambda h: (len(h), sorted(h)))]
        merged = [MERGED[kind](name).alias(name) for name, (kind, _) in partials.items()]
        held[wanted] = finer.groupBy(*[d for d in dimensions if d in wanted]).agg(*merged).na.fill(0, zero)
    return reduce(DataFrame.unionByName, [_finished(held[frozenset(s)], s, dimensions, aggregates, df) for s in sets])


def _finished(found: DataFrame, own: Sequence[str], dimensions: list[str], aggregates: Mapping, df: DataFrame) -> DataFrame:
    def value(name: str, kind: str) -> Column:
        if kind != "avg":
            return F.col(name)
        return (F.col(f"_sum_{name}") / F.nullif(F.col(f"_n_{name}"), F.lit(0))).alias(name)

    shown = [F.col(d) if d in own else F.lit(None).cast(df.schema[d].dataType).alias(d) for d in dimensions]
    bits = sum(1 << i for i, d in enumerate(reversed(dimensions)) if d not in own)
    return found.select(*shown, *[value(n, k) for n, (k, _) in aggregates.items()], F.lit(bits).alias("grouping"))


def pivot_found(
    df: DataFrame, by: Sequence[str], column: str, value: str, *, most: int = 50, other: str = "other"
) -> DataFrame:
    """Sums of ``value`` by ``by``, with a column per value of ``column`` that occurs.

    The ``most`` most frequent values, ties in text order, get columns named by them; all
    others, and nulls, are added up in ``other``, so that the columns of a row add up to
    its total. Values are counted by one aggregate, and the sums take one more.
    """
    text = F.col(column).cast("string")
    counts = df.where(text.isNotNull()).groupBy(text.alias("v")).agg(F.count("*").alias("n"))
    names = sorted(r["v"] for r in counts.orderBy(F.desc("n"), "v").limit(most).collect())
    if clash := {other, *by} & set(names):
        raise ValueError(f"values named like other columns: {sorted(clash)}")
    # A lookup rather than a condition per column and row.
    grouped = df.groupBy(*by, F.when(text.isin(names), text).alias("_v")).agg(F.sum(value).alias("_sum"))
    sums = [F.sum(F.when(F.col("_v") == n, F.col("_sum"))).alias(n) for n in names]
    rest = F.sum(F.when(F.col("_v").isNull(), F.col("_sum"))).alias(other)
    return grouped.groupBy(*by).agg(*sums, rest)
