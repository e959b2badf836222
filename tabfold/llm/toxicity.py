"""Toxicity by a weighted lexicon, matched with Aho-Corasick.

Texts are folded first: letters of other scripts that look like Latin ones, full
width forms, digits and signs that stand for letters become one letter; marks above
and below letters and signs without width go. The lexicon holds folded words and
beginnings of words, each with a weight; one automaton finds all of them in one pass
over a text, along with exception phrases, inside which a match does not count. The
sum of weights is normalised by the length of the text, and a logistic curve turns
it into a score.

Words and weights are learned from labelled rows: the log odds of a term between
toxic and other documents. Every word and beginning of the toxic rows is judged, and
its evidence alone decides. A beginning stands for all its words; it is taken only
where it tells the classes apart as well as its longer forms do. Exceptions are
learned as well: two words on end, one of them of the lexicon, that occur in clean
rows far more than that word does by itself.

Defined results: a null or empty text has nothing toxic and the lowest score. Labels
that are null or whose document is missing teach nothing, nor does a null id. A document without a label is scored like any other. With no
toxic training rows every score is zero. An empty table gives an empty result.
Columns beyond those named do not matter. Repeated rows are scored one by one; copies
of a text teach once. A very long text costs memory in proportion to itself.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tabfold.llm.common import batches_by_bytes, numbered, settle

# Characters read as a Latin letter. Cyrillic, Greek, Armenian and other
# letters by script, then digits and signs; l, 1 and the stroke are read as i.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ү": "y", "ӏ": "i", "ғ": "f", "г": "r", "п": "n", "ѵ": "v",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g",
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ƒ": "f", "ø": "o", "đ": "d", "ħ": "h", "ł": "i", "ŧ": "t", "ß": "b", "ʀ": "r", "ɴ": "n", "ʟ": "i", "ʏ": "y",
    "l": "i", "ı": "i", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "£": "e",
}
# Signs that stand for a letter only where one follows: elsewhere they end a word.
_closing = re.compile(r"[!|$@€£]+(?![^\W_])")

# Beginnings have every length between these, then each doubling; whole words any length.
SHORTEST, LONGEST = 4, 16
# Sizes of the model.
MAX_TERMS, MAX_EXCEPTIONS = 20_000, 20_000
# Labelled rows that the lexicon is fitted on.
MAX_ROWS = 1_000_000
# Toxic texts that a term has to occur in to be tested at all.
MIN_TOXIC_DOCS = 4
# Log odds count less this many standard errors. A term has to tell more than the
# best of all tested would by chance, by this much, and to make a toxic text this
# much likelier (log odds): many light terms, such as words of one language, add up.
CAUTION, SURPLUS, LEAST = 1.5, 1.0, 2.0
# Words of a text up to which its length hardly matters.
LENGTH = 200
# Histogram of densities: bins for each doubling, and in all.
PER_DOUBLING, BINS = 8, 320
# Scores: the rise per doubling of the density, and the score that means toxic.
SLOPE, TOXIC_SCORE = 2.0, 0.7
# Tested terms that are sent to the tasks; beyond it all terms are counted, with the same result.
MAX_WANTED_BYTES = 1 << 25
# Terms that a task holds before it hands them on.
HELD_TERMS = 200_000


class _Folding(dict):
    """Character table that folds a character when it is first met."""

    def __missing__(self, code: int) -> str:
        folded = ""
        for c in unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", chr(code)).lower()):
            kind = unicodedata.category(c)
            # Marks on letters and signs without width vanish, other signs part words.
            folded += "" if kind in ("Mn", "Me", "Cf") else LOOKALIKES.get(c, c if c.isalnum() else " ")
        self[code] = folded
        return folded


_folding = _Folding()


def fold(text: str) -> str:
    """Folded words, each between single spaces."""
    return f" {' '.join(_closing.sub(' ', text).translate(_folding).split())} "


def _beginnings(word: str) -> Iterator[str]:
    yield from (word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
    n = 2 * LONGEST
    while n <= len(word):
        yield word[:n]
        n *= 2


def _terms(words: set[str]) -> set[str]:
    """Whole words, closed by a space, and beginnings of words."""
    found = {f"{w} " for w in words}
    for w in words:
        found.update(_beginnings(w))
    return found


def _counted(rows: DataFrame, found) -> DataFrame:
    """Toxic and clean rows per thing that ``found`` gives for a text; a task adds up what it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter[str], Counter[str]] = Counter(), Counter()
        things = found()
        for batch in batches_by_bytes(batches, 0, 1 << 22):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(things(text or ""))
                if len(counts[toxic]) > HELD_TERMS:
                    yield _as_batch(counts[toxic], toxic)
                    counts[toxic].clear()
        for toxic in (False, True):
            yield _as_batch(counts[toxic], toxic)

    parts = rows.select("text", "toxic").mapInArrow(run, "term string, toxic long, clean long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _as_batch(counts: Counter[str], toxic: bool) -> pa.RecordBatch:
    n, none = pa.array(list(counts.values()), pa.int64()), pa.array([0] * len(counts), pa.int64())
    columns = [pa.array(list(counts), pa.string()), *((n, none) if toxic else (none, n))]
    return pa.RecordBatch.from_arrays(columns, ["term", "toxic", "clean"])


def _all_terms():
    return lambda text: _terms(set(fold(text).split()))


def _wanted_terms(able: DataFrame):
    """What finds the terms of ``able``, which go to the tasks if they are short enough, or else all terms."""
    if (able.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0) > MAX_WANTED_BYTES:
        return _all_terms
    wanted = frozenset(r["term"] for r in able.select("term").collect())
    return lambda: lambda text: _terms(set(fold(text).split())) & wanted


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights, exception phrases, and the place of the score's curve."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    middle: float = 0.0
    length: int = LENGTH

    def automaton(self) -> ahocorasick.Automaton:
        built = ahocorasick.Automaton()
        # Occurs in no folded text; an automaton without words could not be run.
        built.add_word("\n", (0, None))
        for term, weight in self.weights.items():
            built.add_word(" " + term, (len(term), weight))
        for phrase in self.exceptions:
            folded = fold(phrase)
            built.add_word(folded, (len(folded) - 1, None))
        built.make_automaton()
        return built

    def phrases(self):
        """What finds, in a text, the matched words and the pairs of words that hold one.

        A word stands as itself, a pair as the matched word, a tab and the pair.
        """
        automaton = Lexicon(self.weights).automaton()

        def find(text: str) -> set[str]:
            folded = fold(text)
            found = set()
            for start in {end - size for end, (size, _) in automaton.iter(folded)}:
                start += folded[start] == " "
                stop = folded.index(" ", start)
                word = folded[start:stop]
                found.add(word)
                before = folded[folded.rfind(" ", 0, start - 1) + 1 : start - 1]
                after = folded[stop + 1 : folded.find(" ", stop + 1)]
                if before:
                    found.add(f"{word}\t{before} {word}")
                if after:
                    found.add(f"{word}\t{word} {after}")
            return found

        return find

    def density(self, text: str | None, automaton: ahocorasick.Automaton) -> float:
        """Weight of the matches outside exception phrases, normalised by the text's length.

        A word counts by its heaviest term; repeats of a term count less each time,
        as its logarithm.
        """
        folded = fold(text or "")
        heaviest: dict[int, tuple[str, float]] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in automaton.iter(folded):
            start = end - size
            if weight is None:
                spared.append((start, end))
            else:
                if start not in heaviest or weight > heaviest[start][1]:
                    heaviest[start] = (folded[start:end], weight)
        if not heaviest:
            return 0.0
        meant = Counter(w for at, w in heaviest.items() if not any(a <= at < b for a, b in spared))
        total = sum(weight * (1.0 + math.log(n)) for (_, weight), n in meant.items())
        return total / math.sqrt(1.0 + folded.count(" ") / self.length)

    def score(self, density: float) -> float:
        """0 without a match, else a rising function below 1."""
        if density <= 0.0:
            return 0.0
        return 1.0 / (1.0 + math.exp(min(500.0, SLOPE * (self.middle - math.log2(density)))))


def with_score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """All columns of ``docs``, with ``density`` and ``score``."""
    at = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, StructField("density", DoubleType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches_by_bytes(batches, at):
            found = [lexicon.density(t, automaton) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns, pa.array(found, pa.float64()), pa.array(map(lexicon.score, found), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)


def training_rows(docs: DataFrame, labels: DataFrame, *, doc_id: str, text: str, max_rows: int) -> DataFrame:
    """Rows (text, toxic), a text with one label once; no text is shuffled.

    The labels are a table of two short columns. Beyond ``max_rows`` a sample of them
    by a hash of the id is taken, so they can be broadcast at any size of the corpus.
    """
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), (F.col("toxic") != 0).alias("toxic")).where(
        "toxic IS NOT NULL AND doc_id IS NOT NULL"
    )
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < max_rows)
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = named.join(F.broadcast(known), "doc_id").withColumn("hash", F.xxhash64("text"))
    rows = settle(rows, "labelled")
    first = rows.groupBy("hash", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return rows.join(F.broadcast(first), ["hash", "toxic", "doc_id"], "left_semi").select("text", "toxic")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    max_rows: int = MAX_ROWS,
    max_terms: int = MAX_TERMS,
    max_exceptions: int = MAX_EXCEPTIONS,
    exceptions: Sequence[str] = (),
) -> Lexicon:
    """Fit a lexicon on documents with a label; ``labels`` has the id and ``toxic``, 0 or 1.

    Copies of a text with one label count once. Terms are counted in all labelled rows
    and judged there, in Spark: what reaches the driver is the lexicon, of ``max_terms``
    terms and ``max_exceptions`` learned phrases at most. ``exceptions`` are more phrases.
    """
    rows = training_rows(docs, labels, doc_id=doc_id, text=text, max_rows=max_rows)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, tuple(exceptions))
    share = n_toxic / (n_toxic + n_clean)
    tested = settle(_counted(rows.where("toxic"), _all_terms).where(F.col("toxic") >= MIN_TOXIC_DOCS).select("term", "toxic"), "terms")
    telling = math.log(max(1, tested.count())) + SURPLUS
    # Only these can have the evidence: it is greatest without a clean row.
    able = tested.where(F.col("toxic") * -math.log(share) >= telling)
    met = _counted(rows.where("NOT toxic"), _wanted_terms(able)).select("term", "clean")
    judged = able.join(met, "term", "left").select("term", "toxic", F.coalesce("clean", F.lit(0)).alias("clean"))
    toxic, clean = F.col("toxic"), F.col("clean")
    odds = log_odds(toxic, n_toxic, clean, n_clean)
    weight = odds - CAUTION * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    sure = judged.select("term", weight.alias("weight")).where((odds >= LEAST) & (weight > 0) & (evidence(toxic, clean, F.lit(share)) >= telling))
    best = sure.orderBy(F.desc("weight"), "term").limit(max_terms).collect()
    weights = without_longer_forms({r["term"]: r["weight"] for r in best})
    spared = _exceptions(rows, Lexicon(weights), n_toxic, n_clean, max_exceptions) if weights else []
    draft = Lexicon(weights, tuple(dict.fromkeys([*exceptions, *spared])))
    return replace(draft, middle=_best_cut(rows, draft) - math.log(TOXIC_SCORE / (1 - TOXIC_SCORE)) / SLOPE)


def _exceptions(rows: DataFrame, lexicon: Lexicon, n_toxic: int, n_clean: int, most: int) -> list[str]:
    """Pairs of words that are clean although the lexicon's word in them is not.

    A pair is one if its rows are clean more often than those of the word, by more than
    the best of all pairs would be by chance, and no oftener toxic than any row.
    """
    found = settle(_counted(rows, lexicon.phrases), "phrases").withColumn("word", F.split_part("term", F.lit("\t"), F.lit(1)))
    words = found.where("term = word").select("word", F.col("toxic").alias("all_toxic"), F.col("clean").alias("all_clean"))
    pairs = found.where("term <> word AND clean > 0").join(words, "word")
    telling = math.log(max(1, pairs.count())) + SURPLUS
    # The share of clean rows among those of the word; some of it is never clean by chance.
    share = (F.col("all_clean") + 0.5) / (F.col("all_clean") + F.col("all_toxic") + 1)
    surplus = F.when(F.col("clean") > share * (F.col("clean") + F.col("toxic")), evidence(F.col("clean"), F.col("toxic"), share)).otherwise(0.0)
    sure = pairs.where((surplus >= telling) & (F.col("toxic") * n_clean <= F.col("clean") * n_toxic))
    pair = F.split_part("term", F.lit("\t"), F.lit(2)).alias("pair")
    return [r["pair"] for r in sure.groupBy(pair).agg(F.max(surplus).alias("surplus")).orderBy(F.desc("surplus"), "pair").limit(most).collect()]


def log_odds(toxic: Column, n_toxic: int, clean: Column, n_clean: int) -> Column:
    return F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))


def evidence(own: Column, other: Column, share: Column) -> Column:
    """Log likelihood ratio of the part ``own`` has of ``own`` and ``other`` against ``share``."""
    part = own / (own + other)
    return own * F.log(part / share) + F.when(other > 0, other * F.log((1 - part) / (1 - share))).otherwise(0.0)


def without_longer_forms(weights: dict[str, float]) -> dict[str, float]:
    """Drop a term if a beginning of it weighs as much."""
    return {
        term: weight
        for term, weight in weights.items()
        if not any(weights.get(term[:n], -math.inf) >= weight for n in range(SHORTEST, len(term)))
    }


def _best_cut(rows: DataFrame, draft: Lexicon) -> float:
    """The logarithm of the density at which a cut makes the fewest training errors.

    The densities of all rows arrive as a histogram; of equal cuts the middle one
    is taken.
    """
    place = F.floor(F.log2("density") * PER_DOUBLING) + BINS // 2
    bins = (
        with_score(rows, draft)
        .where("density > 0")
        .groupBy(F.greatest(F.lit(0), F.least(F.lit(BINS - 1), place)).alias("bin"), "toxic")
        .agg(F.count("*").alias("n"))
    )
    gain = np.zeros(BINS)
    for r in bins.collect():
        gain[r["bin"]] += r["n"] if r["toxic"] else -r["n"]
    # Errors of a cut below bin i, up to a constant: toxic rows before it, less clean ones.
    errors = np.concatenate([[0], np.cumsum(gain)])
    ties = np.flatnonzero(errors == errors.min())
    run = ties[: np.argmax(np.append(np.diff(ties) != 1, True)) + 1]
    return float((run[0] + run[-1]) / 2 - BINS // 2) / PER_DOUBLING


def without_toxic(docs: DataFrame, lexicon: Lexicon, *, text: str = "text", threshold: float = TOXIC_SCORE) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    names = docs.columns
    scored = with_score(numbered(docs), lexicon, f"c{names.index(text)}")
    return scored.where(F.col("score") < threshold).drop("density", "score").toDF(*names)
