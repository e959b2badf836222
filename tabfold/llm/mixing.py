"""Mixing sources to target weights by Pareto order sampling, in SQL expressions only.

A source's target over its size is the number of copies that each of its
documents is expected to give. The whole part of it is allocated to all of them
for certain. For the rest, documents are ranked by random odds over inclusion
odds, and the first ones that fit the source's remaining words are taken: a
sample of fixed size in words. A document of the rest that comes closest to the
words still missing closes the gap.

No task sorts a whole source. Where the words of a source run out is found by
two rounds of histograms over the ranks, which combine in the map tasks; only
the documents of the one fine bin with the cut are put in order.

Defined results: a null text has size zero and is never taken; a null source is
a source of its own and comes last; a source without words has target zero.
Rows that agree in source, id and size are taken or left together, as their
ranks tie; null ids tie in this way. An empty table gives an empty result.
Columns beyond those named do not matter. All draws are hashes of the document
id, so reruns agree in any layout.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabfold.llm.common import WORD_TEXT, settle

# The weights of the mixing contract and the bound on repeats.
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3

# A histogram round has 2**12 bins; two rounds tell 2**24 ranks apart.
LEVEL_BITS = 12
HEX_DIGITS = 13
# One row per source, some 100 bytes each; more sources than that join by shuffle.
BROADCAST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_TEXT)), F.lit(0)).cast("bigint")


def source_targets(
    sources: DataFrame,
    *,
    weights: Sequence[float] = WEIGHTS,
    max_copies: float = MAX_COPIES,
    share: float = 1.0,
) -> DataFrame:
    """Target of each row (source, source_size).

    Sources are weighted in code point order, nulls last. Their targets share
    ``share`` of all sizes by weight; a target stops at ``max_copies`` times the
    source's size, and the excess goes to the others by weight. With the sources
    ordered by size over weight, those before some place are stopped and those
    behind it are not; each place has one possible level, and the first level
    that its own source can take is the right one.
    """
    everything = Window.orderBy("_none")  # rows are sources, not documents
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("_room", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    place = ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    cap = F.lit(float(max_copies)) * F.col("source_size")
    weighted = (
        sources.withColumn("_none", F.lit(0))
        .withColumn("_weight", F.element_at(listed, place))
        .withColumn("_cap", cap)
        .withColumn("_room", F.col("_cap") / F.col("_weight"))
    )
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.lit(float(share)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / (F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    levelled = weighted.withColumn("_level", level)
    right = F.min(F.when(F.col("_level") <= F.col("_room"), F.struct("_room", "source", "_level"))).over(whole)
    return levelled.withColumn("_right", right["_level"]).select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("_cap"), F.col("_weight") * F.col("_right")), F.col("_cap")).alias("target"),
    )


def _rank(doc_id: Column, odds: Column, seed: int) -> Column:
    """Random odds over inclusion odds, mapped to 0..1 in the same order.

    The draw comes from md5, which is the same in any SQL engine.
    """
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f"-{seed}"))
    digits = F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("double")
    draw = (digits + 0.5) / float(16**HEX_DIGITS)
    return draw / (draw + (1.0 - draw) * odds)


def _beside(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Each row with the columns of its source; ``sources`` has one row per source."""
    if sources.count() <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    named = sources.withColumnRenamed("source", "_source")
    return rows.join(named, rows["source"].eqNullSafe(named["_source"]), "left").drop("_source")


def _ranked(docs: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """Rows (source, size, _odds, ...) with certain copies, the words of the rest, and the rank."""
    part = F.col("_rate") - F.col("_whole")
    return (
        _beside(docs, targets)
        .withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("_whole", F.floor("_rate"))
        .withColumn("_words", F.col("target") - F.col("_whole") * F.col("source_size"))
        .withColumn("_rank", _rank(F.col("doc_id"), part / (1.0 - part) * F.col("_odds"), seed))
        .withColumn("_fine", F.least((F.col("_rank") * float(1 << 2 * LEVEL_BITS)).cast("bigint"), F.lit((1 << 2 * LEVEL_BITS) - 1)))
        .withColumn("_coarse", F.shiftright("_fine", LEVEL_BITS))
    )


def _cut(rows: DataFrame, order: Sequence[str], before: Column) -> DataFrame:
    """Per source, the place in ``order`` where its words run out, and the words before it.

    ``rows`` has one row per source and place, at most a bin count or the
    documents of one fine bin.
    """
    earlier = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_upto", before + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .where(F.col("_upto") <= F.col("_words"))
        .groupBy("source", "_words")
        .agg(F.max(F.struct(*order, "_upto", "_n")).alias("_last"))
    )


@dataclass(frozen=True)
class MixPlan:
    """What decides a document's copies, one row per source in each table."""

    targets: DataFrame
    cuts: DataFrame
    closing: DataFrame
    seed: int

    def decided(self, rows: DataFrame) -> DataFrame:
        """Rows (doc_id, source, size, _odds, ...) with target and ``copies``: no shuffle."""
        closed = _beside(_first(_ranked(rows, self.targets, self.seed), self.cuts), self.closing)
        extra = F.col("_first") | F.coalesce(_is_closing(), F.lit(False))
        return closed.withColumn("copies", F.col("_whole") + extra.cast("bigint"))


def _first(ranked: DataFrame, cuts: DataFrame) -> DataFrame:
    """Mark the rows of the rest that the ranking takes; rows without words are never among them."""
    here, end = F.struct("_rank", "size"), F.struct("_cut_rank", "_cut_size")
    taken = (here < end) | ((here == end) & F.col("_cut_in"))
    return _beside(ranked, cuts).withColumn(
        "_first", F.coalesce(taken & (F.col("size") > 0) & (F.col("_words") > 0), F.lit(False))
    )


def _is_closing() -> Column:
    return (F.col("_rank") == F.col("_close._rank")) & (F.col("size") == F.col("_close.size"))


def _measured(docs: DataFrame, doc_id: str, text: str, source: str, odds: Column | None, *more: Column) -> DataFrame:
    return docs.select(
        *more,
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        n_words(F.col(f"`{text}`")).alias("size"),
        (F.lit(1.0) if odds is None else F.coalesce(odds.cast("double"), F.lit(1.0))).alias("_odds"),
    )


def plan_mix(
    sized: DataFrame,
    *,
    weights: Sequence[float] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    share: float = 1.0,
    seed: int = 42,
) -> MixPlan:
    """Find the targets, cuts and closing documents for rows (doc_id, source, size, _odds)."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = settle(
        source_targets(per_source, weights=weights, max_copies=max_copies, share=share), "targets"
    )
    ranked = _ranked(sized, targets, seed)

    # The bin where a source's words run out, coarse and then fine.
    counted = ranked.groupBy("source", "_words", "_coarse").agg(F.sum("size").alias("_n"))
    edge = _cut(counted, ["_coarse"], F.lit(0))
    edge = settle(edge.select("source", F.col("_last._coarse").alias("_edge"), F.col("_last._upto").alias("_base")), "edges")
    inside = _beside(ranked, edge).where(F.col("_coarse") == F.col("_edge"))
    counted = inside.groupBy("source", "_words", "_base", "_fine").agg(F.sum("size").alias("_n"))
    edge = _cut(counted, ["_fine"], F.col("_base"))
    edge = settle(edge.select("source", F.col("_last._fine").alias("_edge"), F.col("_last._upto").alias("_base")), "edges")

    # In that fine bin, one by one; rows with the same id and size stand together.
    inside = _beside(ranked, edge).where(F.col("_fine") == F.col("_edge"))
    units = inside.groupBy("source", "_words", "_base", "_rank", "size").agg(F.sum("size").alias("_n"))
    # The last unit that starts in time may not fit as a whole.
    fits = F.col("_last._upto") + F.col("_last._n") <= F.col("_words")
    cuts = _cut(units, ["_rank", "size"], F.col("_base")).select(
        "source",
        F.col("_last._rank").alias("_cut_rank"),
        F.col("_last.size").alias("_cut_size"),
        fits.alias("_cut_in"),
        (F.col("_words") - F.col("_last._upto") - F.when(fits, F.col("_last._n")).otherwise(0)).alias("_gap"),
    )
    cuts = settle(cuts, "cuts")

    # What is missing then is closed by the document of the rest that fits it best.
    rest = _first(ranked, cuts).where(~F.col("_first") & (F.col("size") > 0))
    miss = F.abs(F.col("_gap") - F.col("size"))
    closing = rest.where(miss < F.col("_gap")).groupBy("source", "_gap").agg(
        F.min(F.struct(miss.alias("_miss"), "_rank", "size")).alias("_close")
    )
    closing = settle(closing.select("source", "_close"), "closing")
    # Rows that agree in id and size would all come in; they have to fit together.
    weighed = (
        _beside(rest, closing)
        .where(_is_closing())
        .groupBy("source", "_gap", "_close")
        .agg(F.sum("size").alias("_n"))
        .where(F.abs(F.col("_gap") - F.col("_n")) < F.col("_gap"))
    )
    return MixPlan(targets, cuts, settle(weighed.select("source", "_close"), "closing"), seed)


def copies(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    odds: Column | None = None,
    **options,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies.

    ``odds`` multiplies a document's inclusion odds, for samples that favour some
    documents within their source; the source's words stay as targeted. The
    other options are those of ``plan_mix``.
    """
    sized = settle(_measured(docs, doc_id, text, source, odds), "sizes")
    decided = plan_mix(sized, **options).decided(sized)
    return decided.select("doc_id", "source", "size", "source_size", "target", "copies")


def mixed(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    odds: Column | None = None,
    **options,
) -> DataFrame:
    """The documents themselves, each as many times as the mix takes it.

    Texts never move: a row's copies follow from its own columns and its source's.
    """
    sized = settle(_measured(docs, doc_id, text, source, odds), "sizes")
    rows = _measured(docs, doc_id, text, source, odds, F.struct("*").alias("_document"))
    decided = plan_mix(sized, **options).decided(rows).where(F.col("copies") > 0)
    repeated = decided.select("_document", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return repeated.select("_document.*")
