"""Spelling variants by Bloom-guided neighbourhoods.

The vocabulary of whole texts is counted. Two words are near if one inserted, deleted
or replaced code point turns one into the other. Every edit of a word is looked up in
blocked Bloom filters of the vocabulary, one shard per word length; only what they let
through is written out as text and shuffled to an exact join with the vocabulary, which
removes the false positives. Each pair is looked for from one side only: a deletion
from the longer word, a replacement towards the greater code point.

Edits are not spelled out to be looked up. A word's hash is a polynomial in its code
points, so that the hashes of all its edits follow from its prefix and suffix sums
with a few array operations each.

What is broadcast is bounded: filters of ``FILTER_BYTES`` at most. A vocabulary that
needs more is looked up in several passes; a shard that needs more than a slice of it
is split by another part of the hash. A neighbourhood has some hundred edits, so the
work is in proportion to the vocabulary, and no group of words meets in one task.

Forms: a word's form is the near word of largest count, ties to the smaller one in
code-point order, if that count is at least ``ratio`` times the word's own. Counts grow
by that factor from form to form, which bounds the steps to the root.

Defined results: null texts have no words; a null id deletes nothing. Repeated rows
count each time. An empty table gives no rows. Very long texts are read match by match
and cost their distinct words; edits of very long words are looked up in pieces. Other
columns, whatever their names, do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import ceil, log, log2
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabfold.llm.common import LOWER, UPPER, as_bytes, batches_by_bytes, settle

# Fixed value: a word of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())

FILTER_BYTES = 1 << 25
SLICE_BYTES = 1 << 23
BITS_PER_WORD = 24
BITS_SET = 5
# Words of this length and longer share a shard.
LONGEST_SHARD = 64
PROBES_AT_ONCE = 1 << 20
# An odd base, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def vocabulary(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_length: int = 7, min_count: int = 2, delete_every: int = 31
) -> DataFrame:
    """``word`` and its count ``n`` over all texts, A-Z lower-cased.

    The crc32 of ``id:word`` deletes a code point from the words of a document that
    ``delete_every`` divides, the one at the crc32 modulo the length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(f"{RUN[:-1]}{{{min_length},}}")
        for batch in batches_by_bytes(batches, 1):
            total = Counter()
            for key, raw in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                if raw is None:
                    continue
                found = Counter(m[0] for m in pattern.finditer(raw.translate(TO_LOWER).decode(errors="replace")))
                for word, times in found.items():
                    code = 1 if key is None else crc32(f"{key}:{word}".encode())
                    if code % delete_every == 0:
                        at = code % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    total[word] += times
            yield pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"]
            )

    counted = docs.select(F.col(f"`{id}`").cast("string"), F.col(f"`{text}`")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _mixed(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes whose every bit depends on all of the polynomial and the length."""
    x = hashes + np.uint64((length * 0xD1B54A32D192ED03) & ((1 << 64) - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(length: int) -> np.ndarray:
    """The base to the power length - 1 down to 0."""
    steps = np.full(length, BASE, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)[::-1]


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    found: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        found.setdefault(len(word), []).append(at)
    return found


class _Shards:
    """Where the hash of a word of some length has its block of 64 bits.

    ``counts`` has the number of words per shard. A shard has one or more slices of
    equal blocks, and slices fill passes of bounded size one after the other.
    """

    def __init__(self, counts: dict[int, int], filter_bytes: int = FILTER_BYTES):
        self.slices, self.blocks, self.place = {}, {}, {}
        self.sizes = [0]
        for shard, n in sorted(counts.items()):
            blocks = max(16, -(-n * BITS_PER_WORD // 64))
            self.slices[shard] = -(-blocks * 8 // min(SLICE_BYTES, filter_bytes))
            self.blocks[shard] = -(-blocks // self.slices[shard])
            for part in range(self.slices[shard]):
                if self.sizes[-1] and (self.sizes[-1] + self.blocks[shard]) * 8 > filter_bytes:
                    self.sizes.append(0)
                self.place[shard, part] = (len(self.sizes) - 1, self.sizes[-1])
                self.sizes[-1] += self.blocks[shard]

    def passes_of(self, length: int) -> set[int]:
        shard = min(length, LONGEST_SHARD)
        return {self.place[shard, part][0] for part in range(self.slices.get(shard, 0))}

    def find(self, hashes: np.ndarray, length: int, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the hashes are looked up in this pass, their blocks, and the bits set for them."""
        shard = min(length, LONGEST_SHARD)
        x = _mixed(hashes, length)
        starts = np.array([s if p == number else -1 for p, s in (self.place[shard, i] for i in range(self.slices[shard]))])
        if len(starts) > 1:
            starts = starts[((x >> np.uint64(30)) & np.uint64(0xFFFF)).astype(np.int64) % len(starts)]
            here = np.flatnonzero(starts >= 0)
            x, starts = x[here], starts[here]
        else:
            here = np.arange(len(x))
        block = ((x >> np.uint64(32)) * np.uint64(self.blocks[shard]) >> np.uint64(32)).astype(np.int64) + starts
        bits = np.zeros(len(x), np.uint64)
        for i in range(BITS_SET):
            bits |= np.uint64(1) << ((x >> np.uint64(6 * i)) & np.uint64(63))
        return here, block, bits


def _survey(words: DataFrame) -> tuple[dict[int, int], np.ndarray, int]:
    """Words per shard, the code points that occur, and the largest count; a few rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            shards = Counter(min(len(w), LONGEST_SHARD) for w in texts)
            signs = set().union(*texts) if texts else set()
            most = max(batch.column(1).to_pylist(), default=0)
            rows = [("shard", k, v) for k, v in shards.items()] + [("sign", ord(s), 1) for s in signs] + [("most", most, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["kind", "value", "n"])

    rows = words.mapInArrow(run, "kind string, value long, n long")
    most = F.max(F.when(F.col("kind") == "most", F.col("value")))
    found = rows.groupBy("kind", F.when(F.col("kind") != "most", F.col("value")).alias("value")).agg(F.sum("n"), most).collect()
    counts = {r[1]: r[2] for r in found if r[0] == "shard"}
    signs = np.array(sorted(r[1] for r in found if r[0] == "sign"), np.uint64)
    return counts, signs, max((r[3] for r in found if r[0] == "most"), default=0)


def _filter(words: DataFrame, shards: _Shards, number: int) -> np.ndarray:
    """The blocks of one pass; bits are combined in the tasks, bounded by ``FILTER_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for length, at in _by_length(texts).items():
                if number in shards.passes_of(length):
                    hashes = (_codes([texts[i] for i in at]) * _powers(length)).sum(axis=1, dtype=np.uint64)
                    _, block, bits = shards.find(hashes, length, number)
                    yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(bits.view(np.int64))], ["block", "bits"])

    set_ = words.select("word").mapInArrow(run, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits"))
    table = set_.toArrow()
    blocks = np.zeros(shards.sizes[number], np.uint64)
    blocks[table["block"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return blocks


def _edits(codes: np.ndarray, signs: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes of the edits of words of one length: their length, the hashes, and word, place and new sign of each.

    A run of equal code points loses its first only; new signs are greater than the old.
    """
    length = codes.shape[1]
    terms = codes * _powers(length)
    sums = np.cumsum(terms, axis=1, dtype=np.uint64)
    whole = sums[:, -1:]
    lost = (sums - terms) * np.uint64(INVERSE) + (whole - sums)
    first = np.ones(codes.shape, bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    word, at = np.nonzero(first)
    yield length - 1, lost[word, at], word, at, np.zeros(len(at), np.uint64)
    powers = _powers(length)
    step = max(1, PROBES_AT_ONCE // (len(codes) * max(1, len(signs))))
    for start in range(0, length, step):
        old = codes[:, start : start + step, None]
        word, at, sign = np.nonzero(signs[None, None, :] > old)
        new = signs[sign]
        at += start
        yield length, whole[word, 0] + (new - codes[word, at]) * powers[at], word, at, new


def _positives(words: DataFrame, shards: _Shards, number: int, blocks: np.ndarray, signs: np.ndarray) -> DataFrame:
    """Edits that the filter lets through, with the word they come from and its count."""
    sent = words.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = sent.value
        for batch in batches:
            texts, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for length, at in _by_length(texts).items():
                size = max(1, PROBES_AT_ONCE // (length * max(1, len(signs))))
                for start in range(0, len(at), size):
                    some = at[start : start + size]
                    edits, origins = [], []
                    for target, hashes, word, place, new in _edits(_codes([texts[i] for i in some]), signs):
                        if number not in shards.passes_of(target):
                            continue
                        here, block, bits = shards.find(hashes, target, number)
                        here = here[(blocks[block] & bits) == bits]
                        for w, p, s in zip(word[here].tolist(), place[here].tolist(), new[here].tolist()):
                            text = texts[some[w]]
                            edits.append(text[:p] + (chr(s) if s else "") + text[p + 1 :])
                            origins.append(some[w])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(edits, pa.string()),
                            pa.array([texts[i] for i in origins], pa.string()),
                            pa.array([counts[i] for i in origins], pa.int64()),
                        ],
                        ["edit", "origin", "origin_n"],
                    )

    return words.select("word", "n").mapInArrow(run, "edit string, origin string, origin_n long")


def near_pairs(words: DataFrame, *, filter_bytes: int = FILTER_BYTES) -> tuple[DataFrame, int]:
    """Every pair of near words once, with both counts, and the largest count.

    ``words`` has distinct ``word`` and ``n`` and should be written: it is read several times.
    """
    counts, signs, most = _survey(words)
    shards = _Shards(counts, filter_bytes)
    found = [_positives(words, shards, i, _filter(words, shards, i), signs) for i, size in enumerate(shards.sizes) if size]
    if not found:
        return words.sparkSession.createDataFrame([], "word string, n long, near string, near_n long"), most
    positives = reduce(DataFrame.unionAll, found)
    exact = positives.join(words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit")
    return exact.select(
        F.col("origin").alias("word"), F.col("origin_n").alias("n"), F.col("edit").alias("near"), F.col("edit_n").alias("near_n")
    ), most


def variants(words: DataFrame, *, ratio: int = 10, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Per word: ``form`` or null, ``root``, ``n``, number of near words ``n_near``, and ``form_n``."""
    words = settle(words, "spelling-words")
    pairs, most = near_pairs(words, filter_bytes=filter_bytes)
    both = pairs.selectExpr("stack(2, word, n, near, near_n, near, near_n, word, n) AS (word, n, form, form_n)")
    # Most near words are no form: they leave a count per word before anything is shuffled.
    formed = F.col("form_n") >= ratio * F.col("n")
    offered = both.select("word", F.when(formed, -F.col("form_n")).alias("less"), F.when(formed, F.col("form")).alias("form"))
    counted = offered.groupBy("word", "less", "form").agg(F.count("*").alias("n_near"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct("less", "form")))
    near = settle(counted.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")), "spelling-near")

    roots = near.where("best is not null").select("word", F.col("best.form").alias("root"))
    # Counts grow by the ratio at each step, and each round doubles the steps taken.
    steps = max(1, int(log(max(most, 1), ratio)) + 1) if ratio > 1 else None
    for _ in range(ceil(log2(steps))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = settle(
            roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots"
        )
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            F.col("best.form").alias("form"),
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            (-F.col("best.less")).alias("form_n"),
        )
    )
