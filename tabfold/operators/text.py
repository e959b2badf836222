"""Text to words, words to counts and hashed term frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame, functions as F

from tabfold.functions.tokens import word_counts

HASHED_SIZE = 1 << 18
# Fixed value: the mark of a sparse vector in its stored form.
SPARSE = 0


def tokenizer(column: str, out: str = "words") -> Tokenizer:
    return Tokenizer(inputCol=column, outputCol=out)


def stop_word_remover(
    column: str, out: str = "kept_words", stop_words: Sequence[str] | None = None
) -> StopWordsRemover:
    """Removes the English list of the ML library unless another list is given."""
    stage = StopWordsRemover(inputCol=column, outputCol=out)
    return stage if stop_words is None else stage.setStopWords(list(stop_words))


def term_hasher(column: str, out: str = "features", size: int = HASHED_SIZE) -> HashingTF:
    return HashingTF(inputCol=column, outputCol=out, numFeatures=size)


def tokenize(df: DataFrame, column: str, out: str = "words") -> DataFrame:
    return tokenizer(column, out).transform(df)


def remove_stop_words(df: DataFrame, column: str, out: str = "kept_words") -> DataFrame:
    return stop_word_remover(column, out).transform(df)


def hash_terms(
    df: DataFrame, column: str, out: str = "features", size: int = HASHED_SIZE
) -> DataFrame:
    return term_hasher(column, out, size).transform(df)


def term_counts(df: DataFrame, keys: Sequence[str], words: str) -> DataFrame:
    """One row (keys, term, n) per distinct word of each row, without a shuffle."""
    return df.select(*keys, F.inline(word_counts(F.col(words))))


def hashed_counts(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """One row (keys, slot, n) per non-zero element of a vector column.

    Of a sparse vector the stored indices and values are read, and its full width
    is never written out; a dense vector has its values in the order of the slots.
    """
    stored = F.unwrap_udt(F.col(vector))
    every = F.transform(stored["values"], lambda v, i: i.cast("int"))
    slots = F.when(stored["type"] == SPARSE, stored["indices"]).otherwise(every)
    pairs = F.arrays_zip(slots.alias("slot"), stored["values"].alias("n"))
    return df.select(*keys, F.inline(F.filter(pairs, lambda p: p["n"] != 0)))


def vector_mass(vector: str):
    """Sum of the stored values of a vector column."""
    return F.aggregate(F.unwrap_udt(F.col(vector))["values"], F.lit(0.0), lambda s, v: s + v)
