"""Ordered work over whole tables without a task that sees all rows.

Rows are dealt out to ranges of a total order, each of like size: the cut points come
from a sample and are part of the plan, so a row computed again falls into the same
range. What passes from row to row (a total, the last rows) is worked out within each
range; across a cut goes one small row per range. A key that fills many ranges is cut
like any other stretch of the order. Rows equal in all columns share a range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

SAMPLED_PER_PART = 40
# Sampled rows of a range's end: about a tenth of the range comes after the first of them.
LATE = 4
PART = "_part"
TIE = "_tie"


def default_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


@dataclass(frozen=True)
class Ranges:
    """``rows`` with their range in ``_part``; ``cuts`` has the first order of each range but the first.

    ``late`` has an order near the end of each range, or null where the sample has too few rows of it.
    """

    rows: DataFrame
    order: list[str]
    cuts: list[Row]
    late: list[Row | None]

    def is_late(self) -> Column:
        """Whether a row is one of the last of its range: about a tenth of them; all where that is not known."""
        place = F.struct(*[F.col(f"`{c}`") for c in self.order])
        start = F.element_at(_points(self.late, place, self.rows), F.col(PART) + 1)
        return start.isNull() | (start <= place)

    def keys_at_cuts(self, by: Sequence[str]) -> DataFrame:
        """(_part, key columns) of the stretch that each cut goes through; one row per cut."""
        spark = self.rows.sparkSession
        schema = self.rows.select(F.lit(0).alias(PART), *by).schema
        return spark.createDataFrame([(i + 1, *(cut[b] for b in by)) for i, cut in enumerate(self.cuts)], schema)


def by_range(df: DataFrame, order: Sequence[str], parts: int | None = None) -> Ranges:
    """Deal ``df`` out to ranges of its columns ``order``; equal orders are told apart by a hash of the row, ``_tie``."""
    parts = parts or default_parts(df)
    rows = df.withColumn(TIE, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    names = [*order, TIE]
    place = F.struct(*[F.col(f"`{c}`") for c in names])
    # The best of random draws: one pass, and no more than the wanted rows from each task.
    sample = rows.select(place.alias("o")).orderBy(F.rand(7)).limit(SAMPLED_PER_PART * parts)
    found = [r["o"] for r in sample.orderBy("o").collect()]
    at = {found[i]: i for i in reversed([len(found) * i // parts for i in range(1, parts)])} if found else {}
    starts = sorted(at.values())
    cuts = [found[i] for i in starts]
    late = [found[end - LATE] if end - LATE > start else None for start, end in zip([0, *starts], [*starts, len(found)])]
    return Ranges(rows.withColumn(PART, _range_of(place, cuts, rows)), names, cuts, late)


def _points(orders: list[Row | None], place: Column, rows: DataFrame) -> Column:
    """Orders as a literal array of the kind of ``place``."""
    kind = rows.select(place.alias("o")).schema["o"].dataType
    made = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(o, kind)]) if o is not None else F.lit(None).cast(kind) for o in orders]
    return F.array(*made)


def _range_of(place: Column, cuts: list[Row], rows: DataFrame) -> Column:
    """How many cuts are not beyond ``place``, by bisection."""
    if not cuts:
        return F.lit(0)
    points = _points(cuts, place, rows)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda low, step: F.when(F.try_element_at(points, low + step) <= place, low + step).otherwise(low)
    )


def _same(one: DataFrame, other: DataFrame, names: Sequence[str]) -> Column:
    """Equality that holds between nulls."""
    condition = one[PART] == other[PART]
    for n in names:
        condition = condition & one[n].eqNullSafe(other[n])
    return condition


def _of_cut_keys(ranges: Ranges, by: Sequence[str]) -> DataFrame:
    """The rows of keys that some cut goes through: all of them where there are no keys."""
    if not by:
        return ranges.rows
    keys = ranges.keys_at_cuts(by).select(*by).distinct()
    condition = F.lit(True)
    for b in by:
        condition = condition & ranges.rows[b].eqNullSafe(keys[b])
    # One row per cut at most.
    return ranges.rows.join(F.broadcast(keys), condition, "left_semi")


def running_totals(
    df: DataFrame, order_by: Sequence[str], totals: Mapping[str, str], *, by: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Each row with the totals, under the names given, of a column up to and including the row.

    ``totals`` maps new names to numeric columns; nulls add nothing, and a total over
    nulls only is zero. ``by`` starts anew for each key; null keys are one key. Nulls
    in the order come first. Rows equal in the order follow one another by a hash of
    their values.
    """
    ranges = by_range(df, [*by, *order_by], parts)
    sums = {name: F.sum(column) for name, column in totals.items()}
    local = Window.partitionBy(PART, *by).orderBy(*order_by, TIE).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranges.rows.withColumns({name: F.coalesce(s.over(local), F.lit(0)) for name, s in sums.items()})
    if ranges.cuts:
        before = _totals_before(ranges, by, sums)
        rows = rows.join(F.broadcast(before), _same(rows, before, by), "left").drop(*(before[c] for c in (PART, *by)))
        rows = rows.withColumns({n: F.col(n) + F.coalesce(F.col(f"_before_{n}"), F.lit(0)) for n in totals})
    return rows.select(*[f"`{c}`" for c in df.columns], *totals)


def _totals_before(ranges: Ranges, by: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """For the stretch at the start of each range, what earlier ranges hold of it; one row per cut."""
    held = _of_cut_keys(ranges, by).groupBy(PART, *by).agg(*[F.coalesce(s, F.lit(0)).alias(n) for n, s in sums.items()])
    kinds = held.schema
    # Two rows per cut at most, the end of a stretch and its start.
    of_key: dict = {}
    for row in held.collect():
        of_key.setdefault(tuple(row[b] for b in by), []).append(row)
    found = []
    for i, cut in enumerate(ranges.cuts):
        key = tuple(cut[b] for b in by)
        earlier = [r for r in of_key.get(key, ()) if r[PART] <= i]
        if earlier:
            found.append((i + 1, *key, *(sum(r[n] for r in earlier) for n in sums)))
    return ranges.rows.sparkSession.createDataFrame(found, kinds).withColumnsRenamed({n: f"_before_{n}" for n in sums})


def moving(
    df: DataFrame,
    order_by: Sequence[str],
    preceding: int,
    aggregates: Mapping[str, Column],
    *,
    by: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Each row with aggregates over itself and the ``preceding`` rows before it.

    A range is given the last ``preceding`` rows before its start, from as many earlier
    ranges as that takes; the frame is bounded, so these copies are too.
    """
    ranges = by_range(df, [*by, *order_by], parts)
    rows = ranges.rows.withColumn("_copy", F.lit(False))
    if ranges.cuts and preceding > 0:
        of_keys = _of_cut_keys(ranges, by)
        late = ranges.is_late()
        counts = of_keys.groupBy(PART, *by).agg(F.count("*").alias("_n"), F.count_if(late).alias("_late")).collect()
        # Only the end of a range is sorted for its last rows, unless the end has too few of them.
        short = sorted({r[PART] for r in counts if r["_late"] < min(preceding, r["_n"])})
        ends = of_keys.where(late | F.col(PART).isin(short))
        last = Window.partitionBy(PART, *by).orderBy(*[F.desc(c) for c in (*order_by, TIE)])
        tails = ends.withColumn("_back", F.row_number().over(last)).where(F.col("_back") <= preceding)
        wanted = _reach(ranges, by, preceding, counts)
        copies = tails.join(F.broadcast(wanted), _same(tails, wanted, by)).where("_back <= _reach")
        copies = copies.select(*[tails[c] for c in ranges.rows.columns if c != PART], F.col("_to").alias(PART))
        rows = rows.unionByName(copies.withColumn("_copy", F.lit(True)))
    frame = Window.partitionBy(PART, *by).orderBy(*order_by, TIE).rowsBetween(-preceding, 0)
    found = rows.withColumns({name: a.over(frame) for name, a in aggregates.items()})
    return found.where(~F.col("_copy")).select(*[f"`{c}`" for c in df.columns], *aggregates)


def _reach(ranges: Ranges, by: Sequence[str], preceding: int, counts: list[Row]) -> DataFrame:
    """How many of the last rows of a stretch (``_part``, key) each later range ``_to`` needs."""
    held: dict = {}
    for row in counts:
        held.setdefault(tuple(row[b] for b in by), {})[row[PART]] = row["_n"]
    found = []
    for i, cut in enumerate(ranges.cuts):
        key, missing = tuple(cut[b] for b in by), preceding
        for part in sorted((p for p in held.get(key, ()) if p <= i), reverse=True):
            if missing <= 0:
                break
            found.append((part, *key, i + 1, missing))
            missing -= held[key][part]
    schema = ranges.rows.select(F.lit(0).alias(PART), *by, F.lit(0).alias("_to"), F.lit(0).cast("bigint").alias("_reach")).schema
    return ranges.rows.sparkSession.createDataFrame(found, schema)
