"""Licence scans with a generalised suffix automaton of licence templates.

The automaton holds every run of words of every template and base phrase. A text
is streamed through it once: after each word it knows the longest run of words
ending there that any template has (the matching statistics). Runs that cannot be
made longer are kept if they are long enough, and those that follow each other in
a text as well as in a template are chained into spans. A span that covers enough
of its template, or enough words of a long one, gives the template's label: a clause
is found without the licence around it. Base phrases are found in the same
pass, wherever they end, and give theirs.

Defined results: a null or empty text has no words, no places, empty labels and
score 0. Places of different phrases may overlap, all count. Repeated rows are
scanned one by one. An empty table gives an empty result. Columns beyond those
named do not matter. Long texts cost memory in proportion to themselves only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tabfold.llm.common import as_bytes, batches_by_bytes
from tabfold.llm.licence_texts import CLAUSES

# Words of the licence contract over lower-cased UTF-8 bytes, and its phrases.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
# Short notices of public licences; their clauses follow.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License. Permission is hereby granted, free of charge."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("reserved", "All rights reserved. No part of this publication may be reproduced"),
    *CLAUSES,
)

# A run of words counts from this length on, or if it is a whole template.
SHORTEST_RUN = 3
# Words of the text, and of the template, that may lie between two runs of a span.
GAP = 12
COVERED = 0.8
# Words of a template that give its label whatever the share.
LONG_SPAN = 16

_word = re.compile(WORD)


def words_of(text: bytes | None) -> list[bytes]:
    return _word.findall((text or b"").lower())


@dataclass(frozen=True)
class Span:
    """Words ``start`` to ``end`` of a text, and how much of the template they cover."""

    template: int
    start: int
    end: int
    covered: float
    words: int


class SuffixAutomaton:
    """All runs of words of several sequences; state 0 is the empty run."""

    def __init__(self, sequences: Sequence[Sequence[bytes]]):
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for s in sequences for w in s))}
        self.lengths = [len(s) for s in sequences]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        # Where the runs of a state end: (sequence, words up to there).
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence, 1):
                last = self._extend(last, self.vocabulary[word])
                self.ends[last].add((number, at))
        for state in sorted(range(1, len(self.next)), key=lambda v: -self.longest[v]):
            self.ends[self.link[state]] |= self.ends[state]
        self.ends[0] = set()

    def _state(self, longest: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.longest.append(longest)
        self.link.append(link)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state for the runs of ``target`` that are one longer than ``state`` at most."""
        copy = self._state(self.longest[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:  # an earlier sequence has this run
            return target if self.longest[target] == self.longest[last] + 1 else self._split(last, word, target)
        new = self._state(self.longest[last] + 1, {}, 0)
        state = last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state != -1:
            target = self.next[state][word]
            fits = self.longest[target] == self.longest[state] + 1
            self.link[new] = target if fits else self._split(state, word, target)
        return new


class Scanner:
    def __init__(
        self,
        templates: Sequence[tuple[str, str]] = TEMPLATES,
        phrases: Sequence[tuple[str, str]] = PHRASES,
        *,
        shortest_run: int = SHORTEST_RUN,
        gap: int = GAP,
        covered: float = COVERED,
        long_span: int = LONG_SPAN,
    ):
        self.labels = [label for label, _ in templates]
        self.phrase_labels = [label for label, _ in phrases]
        self.shortest_run, self.gap, self.covered, self.long_span = shortest_run, gap, covered, long_span
        sequences = [words_of(t.encode()) for _, t in (*templates, *phrases)]
        self.automaton = SuffixAutomaton(sequences)
        n = len(templates)
        built = self.automaton
        # Phrases that are the end of a state's runs, with their lengths: those of the
        # state its links lead to, and the one that leads to the state itself.
        self.phrases_at: list[list[tuple[int, int]]] = [[] for _ in built.next]
        for number, sequence in enumerate(sequences[n:]):
            state = 0
            for word in sequence:
                state = built.next[state][built.vocabulary[word]]
            self.phrases_at[state].append((number, len(sequence)))
        for state in sorted(range(1, len(built.next)), key=lambda v: built.longest[v]):
            self.phrases_at[state] += self.phrases_at[built.link[state]]
        # Where the state's runs end in templates.
        self.templates_at = [[e for e in sorted(ends) if e[0] < n] for ends in built.ends]

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Places (phrase, start) and maximal runs (end, length, state) of a text."""
        built = self.automaton
        known = np.fromiter(map(built.vocabulary.get, words, [-1] * len(words)), np.int64, len(words))
        at_words = np.flatnonzero(known >= 0)
        places, runs = [], []
        state, length, before = 0, 0, -2

        def close(end: int) -> None:
            if length >= self.shortest_run:
                runs.append((end, length, state))

        for at, word in zip(at_words.tolist(), known[at_words].tolist()):
            if at != before + 1 and length:
                close(before + 1)
                state, length = 0, 0
            if word not in built.next[state]:
                close(at)
                while state and word not in built.next[state]:
                    state = built.link[state]
                length = built.longest[state]
            state = built.next[state].get(word, 0)
            length += 1 if state else 0
            before = at
            for phrase, size in self.phrases_at[state]:
                if size <= length:
                    places.append((phrase, at + 1 - size))
        if length:
            close(before + 1)
        return places, runs

    def spans(self, runs: list[tuple[int, int, int]]) -> list[Span]:
        """Chains of runs in the order of their template, each with its coverage."""
        found = []
        open_chains: dict[int, list[int]] = {}  # template: start, end, end in the template, words covered

        def close(template: int) -> None:
            start, end, _, covered = open_chains.pop(template)
            found.append(Span(template, start, end, covered / self.automaton.lengths[template], covered))

        for end, length, state in runs:
            start = end - length
            for template in dict.fromkeys(number for number, _ in self.templates_at[state]):
                stops = [at for number, at in self.templates_at[state] if number == template]
                chain = open_chains.get(template)
                if chain:
                    # The nearest place in the template that takes the chain further.
                    stop = next((s for s in stops if s > chain[2]), None)
                    if stop is not None and start <= chain[1] + self.gap and stop - length <= chain[2] + self.gap:
                        new = min(stop - max(stop - length, chain[2]), end - max(start, chain[1]))
                        open_chains[template] = [chain[0], end, stop, chain[3] + max(0, new)]
                        continue
                    close(template)
                open_chains[template] = [start, end, stops[0], length]
        for template in list(open_chains):
            close(template)
        return sorted(found, key=lambda s: (s.start, s.end, s.template))

    def scan(self, text: bytes | None) -> tuple:
        """n_words, places, spans, base labels, all labels, score of one text."""
        words = words_of(text)
        places, runs = self.stream(words)
        spans = self.spans(runs)
        good = [s for s in spans if s.covered >= self.covered or s.words >= self.long_span]
        base = sorted({self.phrase_labels[p] for p, _ in places})
        labels = sorted({*base, *(self.labels[s.template] for s in good)})
        score = 1.0 if base else max((max(s.covered, s.words / self.long_span) for s in spans), default=0.0)
        return len(words), sorted(places), good, base, labels, min(1.0, score)


FOUND = [
    StructField("n_words", LongType()),
    StructField("places", ArrayType(StructType([StructField("label", StringType()), StructField("start", LongType())]))),
    StructField(
        "spans",
        ArrayType(
            StructType(
                [
                    StructField("label", StringType()),
                    StructField("template", IntegerType()),
                    StructField("start", LongType()),
                    StructField("end", LongType()),
                    StructField("covered", DoubleType()),
                ]
            )
        ),
    ),
    StructField("base_labels", ArrayType(StringType())),
    StructField("labels", ArrayType(StringType())),
    StructField("score", DoubleType()),
]


def scan_licences(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    **options,
) -> DataFrame:
    """One row per document: its id, words, places of phrases, spans of templates, labels, score.

    Places and spans count words from 0; spans end before ``end``. ``options`` are
    those of ``Scanner``.
    """
    rows = docs.select(f"`{doc_id}`", f"`{text}`")
    schema = StructType([rows.schema.fields[0], *FOUND])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases, **options)
        types = [to_arrow_type(f.dataType) for f in FOUND]
        for batch in batches_by_bytes(batches, 1):
            found = [scanner.scan(t) for t in as_bytes(batch.column(1))]
            places = [[{"label": scanner.phrase_labels[p], "start": s} for p, s in f[1]] for f in found]
            spans = [
                [{"label": scanner.labels[s.template], "template": s.template, "start": s.start, "end": s.end, "covered": s.covered} for s in f[2]]
                for f in found
            ]
            values = [[f[0] for f in found], places, spans, *([f[i] for f in found] for i in (3, 4, 5))]
            columns = [batch.column(0), *(pa.array(v, t) for v, t in zip(values, types))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)
