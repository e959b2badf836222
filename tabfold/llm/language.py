"""Language identification by rank-order profiles of n-grams.

A language's profile lists its most frequent n-grams in order. A document's own
list is compared with it by the out-of-place distance: for each n-gram of the
document, how far its rank is from the profile's, or the most possible if the
profile lacks it. The nearest profile names the language.

Letters are numbered by an alphabet of 128 signs: the letters of Latin scripts in
lower case have their own, those of other scripts share the rest by their code
point, and everything between letters is one blank. An n-gram of up to three
signs is then a number below 2**21, and n-grams are counted by sorting numbers.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Rows
whose language is null teach nothing; with no training rows every document is
``und``. Ties between n-grams go to the smaller number, between languages to the
first name. Repeated rows are judged one by one. An empty table gives an empty
result. Columns beyond those named do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tabfold.llm.common import batches_by_bytes

UNKNOWN = "und"
LONGEST = 3
SIGN_BITS = 7
SIGNS = 1 << SIGN_BITS
# N-grams in the profile of a language and of a document.
PROFILE, DOCUMENT = 400, 300
BLANK = 0


def _alphabet() -> np.ndarray:
    """Sign of each code point: Latin letters in lower case first, then the others in turn."""
    signs = np.zeros(0x110000, np.uint8)
    latin = sorted({c.lower() for c in map(chr, range(0x180)) if c.isalpha() and len(c.lower()) == 1})
    own = [c for c in latin if ord(c) < 0x100]
    number = {c: i + 1 for i, c in enumerate(own)}
    shared = SIGNS - 1 - len(own)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            low = low if len(low) == 1 else char
            signs[code] = number.get(low) or len(own) + 1 + ord(low) % shared
    return signs


_signs: list[np.ndarray] = []


def signs_of(text: str) -> np.ndarray:
    """Signs of a text between two blanks, each run of blanks as one."""
    if not _signs:
        _signs.append(_alphabet())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    signs = np.concatenate([[BLANK], _signs[0][codes], [BLANK]]).astype(np.int32)
    keep = np.ones(len(signs), bool)
    keep[1:] = (signs[1:] != BLANK) | (signs[:-1] != BLANK)
    return signs[keep]


def ngrams(signs: np.ndarray) -> np.ndarray:
    """Numbers of all n-grams of one to ``LONGEST`` signs that hold a letter.

    The length is told apart by a bit above the signs. Blanks only open or close
    an n-gram.
    """
    found = [signs[signs != BLANK] | 1 << SIGN_BITS]
    pairs = signs[:-1] << SIGN_BITS | signs[1:]
    found.append(pairs | 1 << 2 * SIGN_BITS)
    if len(signs) >= 3:
        triples = (pairs[:-1] << SIGN_BITS | signs[2:])[signs[1:-1] != BLANK]
        found.append(triples | 1 << 3 * SIGN_BITS)
    return np.concatenate(found)


def counted(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(numbers)
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    return ordered[starts], np.diff(np.append(starts, len(ordered)))


def most_frequent(numbers: np.ndarray, n: int) -> np.ndarray:
    """The n most frequent numbers, by count and then by number."""
    values, counts = counted(numbers)
    if len(values) > n:
        least = np.partition(counts, len(counts) - n)[len(counts) - n]
        chosen = counts >= least
        values, counts = values[chosen], counts[chosen]
    return values[np.argsort(-counts, kind="stable")][:n]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams per language, added up over all that a task reads."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches_by_bytes(batches, 0, 1 << 22):
        by_lang: dict[str, list[np.ndarray]] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            signs = signs_of(text)
            if len(signs) > 1:
                by_lang.setdefault(lang, []).append(ngrams(signs))
        for lang, numbers in by_lang.items():
            new = np.bincount(np.concatenate(numbers), minlength=1 << 3 * SIGN_BITS + 1)
            totals[lang] = totals[lang] + new if lang in totals else new
        if len(totals) > HELD_LANGUAGES:
            yield from map(_as_batch, totals.items())
            totals.clear()
    yield from map(_as_batch, totals.items())


# Languages that a task counts at a time, at 32 MB each.
HELD_LANGUAGES = 4


def _as_batch(total: tuple[str, np.ndarray]) -> pa.RecordBatch:
    lang, counts = total
    numbers = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(numbers), pa.string()), pa.array(numbers, pa.int64()), pa.array(counts[numbers], pa.int64())],
        ["lang", "ngram", "n"],
    )


@dataclass(frozen=True)
class Profiles:
    """Names of the languages in order, and the rank of each n-gram in each of them."""

    names: list[str]
    ranks: dict[str, list[int]]

    def table(self) -> np.ndarray:
        """Ranks by language and n-gram; the most possible where there is none."""
        ranks = np.full((len(self.names), 1 << 3 * SIGN_BITS + 1), PROFILE, np.int16)
        for i, name in enumerate(self.names):
            ranks[i, self.ranks[name]] = np.arange(len(self.ranks[name]))
        return ranks


def judge(text: str | None, names: list[str], ranks: np.ndarray) -> tuple[str, float]:
    """Nearest language, and one less the share of the most possible distance."""
    signs = signs_of(text or "")
    if len(signs) < 2 or not names:
        return UNKNOWN, 0.0
    own = most_frequent(ngrams(signs), DOCUMENT)
    distance = np.abs(ranks[:, own].astype(np.int64) - np.arange(len(own))).sum(axis=1)
    best = int(np.argmin(distance))
    return names[best], 1.0 - float(distance[best]) / (PROFILE * len(own))


def learn(labelled: DataFrame) -> Profiles:
    """Profiles from all rows (text, lang) with both; what is collected is the profiles."""
    rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    totals = rows.mapInArrow(_count, "lang string, ngram long, n long").groupBy("lang", "ngram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "ngram")
    top = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    ranks: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "rank").collect():
        ranks.setdefault(r["lang"], []).append(r["ngram"])
    return Profiles(sorted(ranks), ranks)


def with_language(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """All columns of ``docs``, with ``lang_pred`` and ``lang_score``."""
    at = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = profiles.table()
        for batch in batches_by_bytes(batches, at):
            found = [judge(t, profiles.names, ranks) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)
