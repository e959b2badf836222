"""Repeated passages by sparse suffix arrays.

Of all suffixes of all texts only those are kept that start at minimisers: words
whose next words, as many as a key has, have the smallest hash among their
neighbours. What is kept depends on the words alone, so a passage of ``MIN_WORDS`` words
keeps the same suffix wherever it stands. The suffixes are sorted by their key, the words
behind and the words before it, then by document id and place, over ranges of that order,
so that a passage that very many documents share fills as many ranges as it needs. In the
sorted array places with the same words about their key are neighbours: each is matched,
as far as these words go to the left and right, with the first of them. Only one place of
each such stretch goes on, where its key has several: its runs of ``MIN_WORDS`` words
about the key, one for each way to extend it, are sorted in the same way, and neighbours
of equal runs are matched. So a place meets an earlier one for all that it shares with
any, and matches that follow one another are one passage. The first occurrence of a
passage is never reported, so that one copy of it stays.

This is done twice: a coarse selection with short keys finds the parts of texts that
may repeat, and only those get the fine selection with long keys. Texts that are
equal are one content; all but the document with the smallest id are reported whole.
Coarse keys are counted by aggregates that combine in the map tasks, so a passage that a
third of all documents share costs one row per task.

Defined results: a null or empty text has no words and no repeats. A passage that
repeats within a document is reported from its second place on. Rows with the same id
and text are one document and not repeats of each other. A null id comes last in the
order of documents. Texts of fewer than ``MIN_WORDS`` words are never reported. An
empty table gives an empty result. Columns beyond those named do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabfold.llm.common import WORD_BYTES, WORD_TEXT, as_bytes, batches_by_bytes, numbered, release_unused, settle
from tabfold.llm.mixing import n_words
from tabfold.operators.ranges import PART, TIE, by_range

MIN_WORDS = 50
# Words of the short and the long keys; a passage of MIN_WORDS words holds a
# selected key whole, so the windows follow from them.
COARSE, FINE = 12, 47
# Bits of a word's tag; the neighbours of a key have to fit 64 bits.
TAG_BITS = 21
# Words whose hashes a task remembers, at some 200 bytes each.
KNOWN_WORDS = 100_000
# Bytes of texts whose words are held at a time; words and hashes take some 20 times as much.
SLICE_BYTES = 1 << 20
# Rows of a table that may be broadcast, at some 20 bytes each.
BROADCAST_ROWS = 1_000_000
# A key on at least one in so many places is joined by broadcast.
OFTEN = 2000
NO_ID = (1 << 63) - 1
# The order of places: smallest document of the content, content, word.
PLACE = ["least", "uid", "at"]

_word = re.compile(WORD_BYTES)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Known(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_known = _Known()


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in a row, and the number of words of each."""
    hashes = []
    for text in texts:
        words = _word.findall(text or b"")
        hashes.append(np.fromiter(map(_known.__getitem__, words), np.uint64, len(words)))
        if len(_known) > KNOWN_WORDS:
            _known.clear()
    return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.array([len(h) for h in hashes], np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def _sliding(values: np.ndarray, n: int, join) -> np.ndarray:
    """``join`` over each n neighbours, from runs of 1, 2, 4, ... of them.

    ``join`` gets the runs before and those that follow directly.
    """
    if len(values) < n:
        return values[:0]
    out, at, run, size = None, 0, values, 1
    while True:
        if n & size:
            out = run if out is None else join(out[: len(run) - at], run[at:][: len(out)])
            at += size
            n -= size
            if not n:
                return out
        run = join(run[:-size], run[size:])
        size *= 2


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n neighbouring words."""
    return _sliding(words, n, lambda a, b: _mixed(a * _A + b))


def minimisers(words: np.ndarray, counts: np.ndarray, key: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the selected keys; no window reaches over the end of a text."""
    hashes = run_hashes(words, key)
    if not len(hashes):
        return np.zeros(0, np.int64), hashes
    end = np.repeat(np.cumsum(counts), counts)
    place = np.arange(len(words))
    hashes = np.where(place[: len(hashes)] + key <= end[: len(hashes)], hashes, _LAST)
    least = _sliding(hashes, window, np.minimum)
    inside = place[: len(least)] + window + key - 1 <= end[: len(least)]
    edge = np.zeros(window - 1, np.uint64)
    around = np.concatenate([edge, np.where(inside, least, np.uint64(0)), edge])
    chosen = np.flatnonzero((_sliding(around, window, np.maximum)[: len(hashes)] == hashes) & (hashes != _LAST))
    return chosen, hashes[chosen]


def content(text: Column) -> Column:
    """A number for the text as a whole."""
    return F.xxhash64(text)


def _own_places(chosen: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and word in it of each place in the row of all texts."""
    ends = np.cumsum(counts)
    text = np.searchsorted(ends, chosen, side="right")
    return text, chosen - (ends - counts)[text]


def _coarse(key: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, 1, SLICE_BYTES):
            words, counts = word_hashes(as_bytes(batch.column(1)))
            chosen, hashes = minimisers(words, counts, key, window)
            text, place = _own_places(chosen, counts)
            uid = batch.column(0).to_numpy(zero_copy_only=False)[text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(uid), pa.array(place)], ["key", "uid", "at"]
            )
        _known.clear()
        release_unused()

    return run


def _fine(key: int, window: int, before: int, behind: int):
    """Selected long keys in the parts of the texts around their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, 1, SLICE_BYTES):
            words, counts = word_hashes(as_bytes(batch.column(1)))
            ends = np.cumsum(counts)
            starts = ends - counts
            # A place opens the part of its text that a passage with it can reach.
            own = np.repeat(np.arange(len(batch)), pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
            at = pc.list_flatten(batch.column(2)).to_numpy(zero_copy_only=False) + starts[own]
            opened = np.zeros(len(words) + 1, np.int64)
            np.add.at(opened, np.maximum(at - before, starts[own]), 1)
            np.add.at(opened, np.minimum(at + behind, ends[own]), -1)
            closed = np.append(0, np.cumsum(np.cumsum(opened[:-1]) == 0))
            chosen, hashes = minimisers(words, counts, key, window)
            kept = closed[chosen + key] == closed[chosen]
            chosen, hashes = chosen[kept], hashes[kept]
            text, place = _own_places(chosen, counts)
            tags = words % np.uint64((1 << TAG_BITS) - 1) + np.uint64(1)
            left, right = np.zeros(len(chosen), np.uint64), np.zeros(len(chosen), np.uint64)
            for i in range(window - 1):
                ahead, behind_key = chosen - 1 - i, chosen + key + i
                inside, beyond = ahead >= starts[text], behind_key < ends[text]
                left |= np.where(inside, tags[np.maximum(ahead, 0)], np.uint64(0)) << np.uint64(TAG_BITS * i)
                right |= np.where(beyond, tags[np.minimum(behind_key, len(tags) - 1)], np.uint64(0)) << np.uint64(TAG_BITS * i)
            uid = batch.column(0).to_numpy(zero_copy_only=False)[text]
            columns = [hashes.view(np.int64), uid, place, left.view(np.int64), right.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "uid", "at", "left", "right"])
        _known.clear()
        release_unused()

    return run


def _inside(tags: str, n: int) -> Column:
    """How many of the n nearest words there are before the edge of the text."""
    count = F.lit(0)
    for i in reversed(range(n)):
        tag = F.shiftright(F.col(tags), TAG_BITS * i).bitwiseAND(F.lit((1 << TAG_BITS) - 1))
        count = F.when(tag != 0, count + 1).otherwise(0)
    return count


def _runs(n: int) -> Column:
    """Tags of the n words about a key, for each way to take some ahead of it and the rest behind.

    A run that reaches over the end of the text is left out.
    """
    nearest = lambda c, i: F.col(c).bitwiseAND(F.lit((1 << TAG_BITS * i) - 1))
    farthest = lambda c, i: F.shiftright(F.col(c), TAG_BITS * (i - 1)).bitwiseAND(F.lit((1 << TAG_BITS) - 1))
    made = []
    for i in range(n + 1):
        inside = F.lit(True)
        for side, words in (("left", i), ("right", n - i)):
            if words:
                inside = inside & (farthest(side, words) != 0)
        tags = F.struct(F.lit(i).alias("ahead"), nearest("left", i).alias("left"), nearest("right", n - i).alias("right"))
        made.append(F.when(inside, tags))
    return F.array_compact(F.array(*made))


def _lines(matches: DataFrame) -> DataFrame:
    """Matches (uid, first_id, first_uid, shift, start, end) that overlap in line, as one span."""
    line = Window.partitionBy("uid", "first_uid", "first_id", "shift").orderBy("start")
    reached = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    begun = matches.withColumn("begins", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    numbered = begun.withColumn("span", F.sum("begins").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        numbered.groupBy("uid", "first_uid", "first_id", "shift", "span")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("uid", "start", "end", "first_id", (F.col("start") + F.col("shift")).alias("first_start"))
    )


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it is bounded; ``df`` is a written table of a few numbers a row."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def content_spans(docs: DataFrame, classes: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Repeats within contents: uid, start, end, first_id, first_start.

    ``docs`` has doc_id (never null), text and uid; ``classes`` has uid and its
    smallest id ``least``.
    """
    key, fine_key = min(COARSE, min_words), min(FINE, min_words)
    window, fine_window = min_words - key + 1, min_words - fine_key + 1
    coarse = settle(
        docs.select("uid", "text").mapInArrow(_coarse(key, window), "key long, uid long, at long"), "suffixes"
    )
    # A key repeats if it stands at two places of contents; copies of a content are one.
    edges = [f(F.struct("uid", "at")).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]
    repeated = settle(coarse.groupBy("key").agg(*edges, F.count("*").alias("n")).where("low < high").select("key", "n"), "repeated")
    # Keys on many rows, of which there can be no more than OFTEN, are sent to the rows and not the rows to them.
    often = F.broadcast(repeated.where(F.col("n") * OFTEN >= coarse.count()).select("key"))
    others = coarse.join(often, "key", "left_anti").join(repeated.select("key"), "key", "left_semi")
    opened = coarse.join(often, "key", "left_semi").unionByName(others)
    places = settle(opened.groupBy("uid").agg(F.collect_set("at").alias("places")), "places")
    # One document of each content; texts without a repeated key go before the shuffle.
    ids = settle(places.select("uid").join(classes, "uid"), "ids")
    named = ids.withColumnRenamed("uid", "_uid")
    one = docs.join(_small(named), (docs["uid"] == named["_uid"]) & (docs["doc_id"] == named["least"]), "left_semi")
    texts = one.select("uid", "text").join(places, "uid")
    fine = texts.mapInArrow(
        _fine(fine_key, fine_window, window - 1, min_words), "key long, uid long, at long, left long, right long"
    )
    fine = settle(fine, "suffixes")
    keyed = fine.join(_small(ids), "uid")
    # The sorted array of the suffixes kept; a range ends anywhere, also among equal neighbours.
    sides = fine_window - 1
    array = by_range(keyed.select("key", "right", "left", *PLACE), ["key", "right", "left", *PLACE])
    around = F.struct("right", "left")
    of_key = Window.partitionBy(PART, "key")
    rows = array.rows.withColumn("several", F.min(around).over(of_key) != F.max(around).over(of_key))
    rows = rows.withColumn("first", F.first(F.struct(*PLACE)).over(Window.partitionBy(PART, "key", "right", "left").orderBy(*PLACE)))
    # A key that a cut goes through may have more neighbours beyond it.
    cut = F.col("key").isin([c["key"] for c in array.cuts])
    begins = F.struct(*PLACE) == F.col("first")
    compared = settle(rows.where(~begins | F.col("several") | cut).drop(PART, TIE, "several"), "neighbours")
    alike = _matches(
        compared.where(~begins)
        .withColumn("start", F.col("at") - _inside("left", sides))
        .withColumn("end", F.col("at") + fine_key + _inside("right", sides))
        .where(F.col("end") - F.col("start") >= min_words)
    )
    # The heads of the stretches, sorted by each run of ``min_words`` words about their key.
    run = ["key", "ahead", "left", "right"]
    runs = compared.where(begins).withColumn("run", F.explode(_runs(sides))).select("key", "run.*", *PLACE)
    array = by_range(runs, [*run, *PLACE])
    first = F.first(F.struct(*PLACE)).over(Window.partitionBy(PART, *run).orderBy(*PLACE))
    heads = array.rows.withColumn("first", first)
    if array.cuts:
        # One row per cut at most: the first of all places of a run that a cut goes through.
        at_cuts = array.keys_at_cuts(run).select(*run).distinct()
        least = runs.join(F.broadcast(at_cuts), run, "left_semi").groupBy(*run).agg(F.min(F.struct(*PLACE)).alias("least_of_all"))
        heads = heads.join(F.broadcast(least), run, "left").withColumn("first", F.coalesce("least_of_all", "first"))
    found = heads.where(F.struct(*PLACE) != F.col("first")).withColumn("start", (F.col("at") - F.col("ahead")).cast("long"))
    return _lines(alike.unionByName(_matches(found.withColumn("end", F.col("start") + min_words))))


def _matches(rows: DataFrame) -> DataFrame:
    """Places with a ``start`` and ``end``, against the ``first`` place that they are matched with."""
    return rows.select(
        "uid",
        F.col("first.uid").alias("first_uid"),
        F.col("first.least").alias("first_id"),
        (F.col("first.at") - F.col("at")).alias("shift"),
        "start",
        "end",
    )


def _contents(docs: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    named = docs.select(
        *more, F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    return named.withColumn("uid", F.when(F.col("text").isNotNull(), content(F.col("text"))))


def repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per repeated passage: doc_id, start, end, first_id, first_start.

    Words count from 0; ``end`` is the first word behind the passage. ``first_id`` is
    an earlier document with it, the first of its stretch of the sorted array, and
    ``first_start`` its place there.
    """
    named = _contents(docs, doc_id, text).where("uid IS NOT NULL")
    ids = settle(named.select("doc_id", "uid", n_words(F.col("text")).alias("n")), "contents")
    classes = settle(ids.groupBy("uid").agg(F.min("doc_id").alias("least")), "classes")
    inside = settle(content_spans(named, classes, min_words), "spans")
    heads = inside.join(classes, "uid").select(F.col("least").alias("doc_id"), "start", "end", "first_id", "first_start")
    copies = (
        ids.join(classes, "uid")
        .where((F.col("doc_id") != F.col("least")) & (F.col("n") >= min_words))
        .select("doc_id", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"), F.col("least").alias("first_id"))
        .withColumn("first_start", F.lit(0).cast("long"))
        .distinct()
    )
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return heads.unionByName(copies).select(known("doc_id"), "start", "end", known("first_id"), "first_start")


def _cut(text: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans and the white space behind them."""
    starts = [m.start() for m in _word.finditer(text)] + [len(text)]
    parts, at = [], 0
    for span in sorted(spans, key=lambda s: s["start"]):
        parts.append(text[at : max(at, starts[span["start"]])])
        at = max(at, starts[span["end"]])
    return b"".join([*parts, text[at:]])


def _without(at: int):
    """Batches whose last column holds the spans to cut from column ``at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, at):
            texts = [_cut(t, s) for t, s in zip(as_bytes(batch.column(at)), batch.columns[-1].to_pylist())]
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return run


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs``, the text without passages that an earlier place has.

    A document of which nothing is left goes, and so does a copy of an earlier one
    of ``min_words`` words. Shorter copies and empty texts stay as they are.
    """
    names = docs.columns
    plain, key, body = numbered(docs), f"c{names.index(doc_id)}", f"c{names.index(text)}"
    rows = _contents(plain, key, body, *plain.columns).drop("text")
    named = _contents(plain, key, body).where("uid IS NOT NULL")
    ids = settle(named.select("doc_id", "uid", n_words(F.col("text")).alias("n")), "contents")
    classes = settle(ids.groupBy("uid").agg(F.min("doc_id").alias("least"), F.max("n").alias("n")), "classes")
    cuts = content_spans(named, classes.select("uid", "least"), min_words)
    cuts = cuts.groupBy("uid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    # Only contents with something to cut, or with several documents.
    several = ids.distinct().groupBy("uid").count().where("count > 1").select("uid", F.lit(True).alias("several"))
    known = settle(
        cuts.join(several, "uid", "full").join(classes.withColumnRenamed("uid", "_uid"), F.col("uid") == F.col("_uid")).drop("_uid"),
        "cuts",
    )
    # Most texts have nothing to cut and do not move; the others meet their spans.
    ids = _small(known.select("uid"))
    untouched = rows.join(ids, "uid", "left_anti").select(plain.columns)
    joined = rows.join(ids, "uid", "left_semi").join(known, "uid")
    copy = F.col("several") & (F.col("doc_id") != F.col("least")) & (F.col("n") >= min_words)
    kept = joined.where(~F.coalesce(copy, F.lit(False))).select(*plain.columns, "spans")
    cut = kept.where("spans IS NOT NULL").mapInArrow(_without(names.index(text)), plain.schema)
    whole = untouched.unionByName(kept.where("spans IS NULL").select(plain.columns))
    return whole.unionByName(cut.where(F.regexp_like(body, F.lit(WORD_TEXT)))).toDF(*names)
