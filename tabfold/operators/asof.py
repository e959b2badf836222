"""As-of join: each left row with the last right row of its key up to its time.

Both sides are one table in the order of key and time, dealt out to ranges of it
(``ranges.py``); within a range the last right row is carried on by a window over the
range and the key. A cut through a key needs the last right row before it: these rows,
at most one per cut, are copied to the range that the cut begins. So one key with most
rows is as many ranges as it needs, and the rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from tabfold.operators.ranges import PART, TIE, Ranges, by_range


def _as_number(df: DataFrame, column: str) -> Column:
    """The time as a number that can be negated and subtracted: microseconds of a timestamp, days of a date."""
    kind = df.schema[column].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, DateType):
        return F.unix_date(column)
    if isinstance(kind, NumericType):
        return F.col(column)
    raise TypeError(f"{column} is {kind.simpleString()}, which has no distance")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    values: Sequence[str] | None = None,
    direction: str = "backward",
    exact: bool = True,
    tolerance: float | None = None,
    how: str = "left",
    parts: int | None = None,
) -> DataFrame:
    """The columns of ``left`` and the ``values`` of the matching row of ``right``, by default all but the keys.

    ``direction`` is ``backward`` (the last row not after the left one) or ``forward``
    (the first not before it); ``exact=False`` leaves out rows of the same time.
    ``tolerance`` is the largest distance, in the time's unit (microseconds, days or
    its number). ``how`` is ``left`` or ``inner``. Null keys and times match nothing.
    Right rows of equal key and time: the one with the greatest values counts, taken in
    the order of ``values``.
    """
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError("direction is backward or forward, and how is left or inner")
    values = [c for c in right.columns if c not in on] if values is None else list(values)
    if clash := set(values) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    keys = [f"_key{i}" for i in range(len(on))]
    sign = 1 if direction == "backward" else -1

    def placed(df: DataFrame, time: str, side: int, **payload: Column) -> DataFrame:
        at = (_as_number(df, time) * sign).alias("_at")
        return df.select(*[F.col(c).alias(k) for c, k in zip(on, keys)], at, F.lit(side).alias("_side"), *[p.alias(n) for n, p in payload.items()])

    # Where times are equal, the side that comes first decides whether they match.
    first = 0 if exact else 1
    asked = placed(left, left_time, 1 - first, _left=F.struct(*[F.col(f"`{c}`") for c in left.columns]))
    known = F.struct(*[F.col(f"`{c}`") for c in values])
    given = placed(right, right_time, first, _right=known).where(" AND ".join(f"{c} IS NOT NULL" for c in (*keys, "_at")))
    both = asked.unionByName(given, allowMissingColumns=True)
    ranges = by_range(both, [*keys, "_at", "_side"], parts)
    rows = ranges.rows
    if ranges.cuts:
        rows = rows.unionByName(_carried(ranges, keys))
    seen = Window.partitionBy(PART, *keys).orderBy("_at", "_side", TIE).rowsBetween(Window.unboundedPreceding, 0)
    # The greatest so far is the last, and of equal times the one with the greatest values.
    last = F.max(F.when(F.col("_right").isNotNull(), F.struct(F.col("_at").alias("at"), F.col("_right").alias("row")))).over(seen)
    found = rows.withColumn("_last", last).where(F.col("_left").isNotNull())
    near = F.col("_at").isNotNull()
    if tolerance is not None:
        near = near & (F.col("_at") - F.col("_last.at") <= F.lit(tolerance))
    found = found.withColumn("_last", F.when(near, F.col("_last")))
    if how == "inner":
        found = found.where(F.col("_last").isNotNull())
    return found.select("_left.*", *[F.col(f"_last.row.`{c}`").alias(c) for c in values])


def _carried(ranges: Ranges, keys: list[str]) -> DataFrame:
    """For each range that a cut through a key begins, the last right row of that key before it."""
    cuts = ranges.keys_at_cuts(keys)
    until = cuts.groupBy(*keys).agg(F.max(PART).alias("_until"))
    given = ranges.rows.where(F.col("_right").isNotNull()).join(F.broadcast(until), keys)
    columns = [c for c in ranges.rows.columns if c not in (PART, *keys)]
    whole = F.struct(*columns)
    # Two rows per cut at most from here on.
    ends = given.groupBy(PART, *keys).agg(F.max_by(whole, F.struct("_at", "_right")).alias("_end"), F.max("_until").alias("_until"))
    # Each goes up to the next range with a right row of its key; that range's own end takes over from there.
    following = F.lead(PART).over(Window.partitionBy(*keys).orderBy(PART))
    copies = ends.withColumn("_upto", F.least(F.coalesce(following, "_until"), "_until")).where(F.col("_upto") > F.col(PART))
    return copies.withColumn(PART, F.explode(F.sequence(F.col(PART) + 1, "_upto"))).select(*keys, PART, "_end.*")
