"""Packing tokenised examples into training sequences: vector bin packing.

A sequence has three limits at once: tokens, segments, and tokens that bear loss.
It is filled by the dot-product heuristic: of the examples that fit, take the one
whose demand has the largest dot product with what the sequence has left. When
nothing fits as a whole, the example with the largest product is cut, so that
sequences fill up; the rest of it stays for later ones. Examples stand in classes
of about equal demand, so that a choice looks at some dozens of classes and not
at all examples.

Every partition of the input packs its own rows, block by block, and carries over
what a block leaves, so nothing is shuffled and the memory of a task is bounded by
a block and its longest text. At its end a partition has less than a sequence left;
that goes into sequences whose lengths are powers of two, which need no padding.

Defined results: a null or empty text has the closing id only. Repeated rows are
packed one by one, a null id is packed like any other. An empty table gives an
empty result. Columns beyond those named do not matter. A lost task packs the same
rows into the same sequences again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from tokenizers import Tokenizer, pre_tokenizers

from tabfold.llm.common import batches_by_bytes, release_unused

CLOSING_ID = 1
ID_BYTES = 4
# Tokens that a task gathers before it packs them.
BLOCK_TOKENS = 1 << 21
# Words whose ids a Python worker remembers from task to task, at some 150 bytes each.
KNOWN_WORDS = 300_000
# Bytes of texts that are split into words at a time; the words take some 15 times as much.
SLICE_BYTES = 1 << 20
# Sequences whose pieces are handed on at a time: a megabyte of ids where they are full.
HANDED = 128
# Room for the number of a partition's sequences beside the partition's own number.
SEQUENCE_BITS = 40

# What the tokenizer splits a text into, for texts of the characters in
# ``PLAIN`` only; any other text goes through the tokenizer as a whole. Its closing
# mark of a word tells the ids of words that are encoded in a row.
PIECES = re.compile(
    r"[a-zß-öø-ÿ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\t\n\r 0-9a-zß-öø-ÿ]+"
)
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
SPECIAL = "<|"
WORD_END = "</w>"


class WordTokenizer:
    """Ids of texts as little-endian bytes, from the ids of their words.

    The tokenizer encodes each word by itself, so a word's ids are the same in any
    text, and a word is encoded once for many texts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # For words that are lower case and split already.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _encode(tokenizer: Tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        ids = self._encode(self.plain, " ".join(words))
        cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(cuts) != len(words):
            raise ValueError("the tokenizer does not close each word with its mark")
        held = ids.tobytes()
        for word, start, end in zip(words, [0, *cuts], cuts):
            self.known[word] = held[ID_BYTES * start : ID_BYTES * end]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        plain = [t is not None and SPECIAL not in t and PLAIN.fullmatch(t) is not None for t in texts]
        words = [PIECES.findall(t.lower()) if simple else None for t, simple in zip(texts, plain)]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        new = [w for w in set().union(*filter(None, words)) if w not in self.known]
        if new:
            self._learn(new)
        of = self.known.__getitem__
        return [
            b"".join(map(of, w)) if w is not None else self._encode(self.tokenizer, t).tobytes() if t else b"" for t, w in zip(texts, words)
        ]


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


class Example:
    """An example of which the tokens from ``start`` on are not yet placed.

    Tokens from ``loss_from`` on bear loss, but for the first one of a piece, which
    nothing in its sequence predicts.
    """

    __slots__ = ("key", "ids", "size", "start", "loss_from")

    def __init__(self, key, ids: bytes, loss_from: int = 0):
        self.key, self.ids, self.loss_from = key, ids, loss_from
        self.size, self.start = len(ids) // ID_BYTES, 0

    @property
    def tokens(self) -> int:
        return self.size - self.start

    def loss(self, tokens: int) -> int:
        return max(0, self.start + tokens - max(self.start + 1, self.loss_from))

    def longest(self, tokens: int, loss: int) -> int:
        """Tokens of the longest piece within the limits."""
        free = max(1, self.loss_from - self.start)
        return min(self.tokens, tokens, free + loss)


class Packer:
    """Fills sequences from examples and hands out (sequence, offset, example, start, tokens)."""

    def __init__(self, limits: Limits, place: Callable[[int, int, Example, int, int], None]):
        self.limits, self.place = limits, place
        self.classes: dict[tuple[int, int], list[Example]] = {}
        self.tokens, self.sequences = 0, 0

    def add(self, example: Example) -> None:
        whole = self.limits.tokens
        while example.tokens > whole and example.loss(whole) <= self.limits.loss:
            self.place(self.sequences, 0, example, example.start, whole)
            self.sequences += 1
            example.start += whole
        self._keep(example)
        self.tokens += example.tokens

    def _keep(self, example: Example) -> None:
        # Four classes to a doubling of the tokens, and four by the share that bears loss.
        n = example.tokens
        top = n.bit_length()
        size = 4 * top + (n << 3 >> top & 3)
        self.classes.setdefault((size, 4 * example.loss(n) // (n + 1)), []).append(example)

    def _choice(self, tokens: int, segments: int, loss: int) -> tuple[tuple[int, int], bool] | None:
        """The class to take from, and whether its example goes in whole."""
        limits = self.limits
        best, best_score, whole = None, -1.0, False
        for key, held in self.classes.items():
            example = held[-1]
            n = example.tokens
            bears = example.loss(n)
            fits = n <= tokens and bears <= loss
            # The last segment has to fill what is left, if anything can.
            fits &= segments > 1 or n == tokens
            score = (
                n * tokens / limits.tokens**2 + segments / limits.segments**2 + bears * loss / max(1, limits.loss) ** 2
            )
            if (fits, score) > (whole, best_score):
                best, best_score, whole = key, score, fits
        return (best, whole) if best else None

    def fill(self, capacity: int) -> None:
        """One sequence of ``capacity`` tokens, or fewer if another limit is met first."""
        tokens, segments, loss, offset = capacity, self.limits.segments, self.limits.loss, 0
        while tokens and segments and (choice := self._choice(tokens, segments, loss)):
            key, _ = choice
            example = self.classes[key][-1]
            n = example.longest(tokens, loss)
            if n <= 0:
                break
            held = self.classes[key]
            held.pop()
            if not held:
                del self.classes[key]
            bears = example.loss(n)
            self.place(self.sequences, offset, example, example.start, n)
            example.start += n
            if example.tokens:
                self._keep(example)
            tokens, segments, loss, offset = tokens - n, segments - 1, loss - bears, offset + n
            self.tokens -= n
        self.sequences += 1

    def _reach(self) -> int:
        """Tokens that the largest examples bring into one sequence, not counting loss."""
        total, left = 0, self.limits.segments
        for key in sorted(self.classes, reverse=True):
            for example in self.classes[key][-left:]:
                total, left = total + example.tokens, left - 1
            if not left or total >= self.limits.tokens:
                break
        return total

    def drain(self) -> Iterator[None]:
        """Fill whole sequences while there is more than one left, one at each step."""
        while self.tokens >= 2 * self.limits.tokens and self._reach() >= self.limits.tokens:
            yield self.fill(self.limits.tokens)

    def last(self) -> Iterator[None]:
        """Place everything, a sequence at each step; short ones get lengths that are powers of two."""
        while self.tokens:
            reach = min(self.tokens, self._reach())
            whole = self.limits.tokens
            yield self.fill(whole if reach >= whole else 1 << (reach.bit_length() - 1))

    def finish(self) -> None:
        for _ in self.last():
            pass


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    limits: Limits = Limits(),
    prompt: str | None = None,
    closing_id: int = CLOSING_ID,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``tokenizer`` is the path of a tokenizer file that every executor has. ``prompt``
    may name a second text column, for instruction data: its ids come first and bear
    no loss. ``ids`` holds the piece's ids, four bytes each, little-endian.
    """
    names = [doc_id, text, *([prompt] if prompt else [])]
    rows = docs.select(*[f"`{c}`" for c in names])
    longs = [StructField(c, LongType()) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")]
    schema = StructType([StructField("doc_id", rows.schema[0].dataType), *longs, StructField("ids", BinaryType())])
    closing = np.array([closing_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(tokenizer)
        first = TaskContext.get().partitionId() << SEQUENCE_BITS
        placed: list[tuple] = []

        def place(sequence: int, offset: int, example: Example, start: int, n: int) -> None:
            ids = example.ids[ID_BYTES * start : ID_BYTES * (start + n)]
            placed.append((example.key, start, n, example.size, first + sequence, offset, ids))

        def handed(least: int = 1) -> Iterator[pa.RecordBatch]:
            """What is placed, once it has pieces of so many sequences."""
            if placed and placed[-1][4] - placed[0][4] >= least - 1:
                columns = [pa.array(c, t) for c, t in zip(zip(*placed), types)]
                placed.clear()
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        packer, types = Packer(limits, place), None
        for batch in batches_by_bytes(batches, 1, SLICE_BYTES):
            types = types or [batch.schema.field(0).type, *[pa.int64()] * 5, pa.binary()]
            keys, bodies = batch.column(0).to_pylist(), words.ids(batch.column(1).to_pylist())
            heads = words.ids(batch.column(2).to_pylist()) if prompt else [b""] * len(bodies)
            for key, head, body in zip(keys, heads, bodies):
                packer.add(Example(key, head + body + closing, len(head) // ID_BYTES))
                yield from handed(HANDED)
                if packer.tokens >= BLOCK_TOKENS:
                    for _ in packer.drain():
                        yield from handed(HANDED)
        for _ in packer.last():
            yield from handed(HANDED)
        yield from handed()
        release_unused()

    return rows.mapInArrow(run, schema)
