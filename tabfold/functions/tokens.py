"""Words as array expressions; nothing here moves a row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


# The white-space characters at which the ML tokenizer splits.
SPACE = " \t\n\x0b\f\r"


def split_words(text: Column) -> Column:
    """Lower-case and split at each white-space character.

    Leading and inner empty words stay, trailing ones go, and an empty text
    gives one empty word. These are the rules of the ML tokenizer, whose compiled
    loop is faster; this form is for queries that have to stay plain SQL.
    """
    lowered = F.lower(text)
    body = F.rtrim(lowered, F.lit(SPACE))
    only_space = (body == "") & (lowered != "")
    return F.when(only_space, F.array().cast("array<string>")).otherwise(F.split(body, r"\s"))


def without_words(words: Column, unwanted: Iterable[str]) -> Column:
    """Drop unwanted words whatever their case; order and repeats stay."""
    listed = sorted({w.lower() for w in unwanted})
    return F.filter(words, lambda w: ~F.lower(w).isin(listed))


def word_counts(words: Column) -> Column:
    """Array of (term, n) structs, one per distinct word, terms ascending.

    The words of one row are sorted and the lengths of equal runs taken, so the
    work per row is that of a sort and no row leaves its task.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (ordered[i] != ordered[F.greatest(i - 1, F.lit(0))]),
        )
        # One edge beyond the end closes the last run.
        return F.struct(
            F.array_distinct(ordered).alias("terms"),
            F.concat(starts, F.array(F.size(ordered))).alias("edges"),
        )

    def counted(run: Column) -> Column:
        return F.transform(
            run["terms"],
            lambda term, at: F.struct(
                term.alias("term"),
                (run["edges"][at + 1] - run["edges"][at]).cast("bigint").alias("n"),
            ),
        )

    # A one-element array binds a value to a name, so that it is computed once.
    bound = F.transform(F.transform(F.array(F.sort_array(words)), runs), counted)
    return F.when(F.size(words) > 0, bound[0])
