import random
import re

from helpers import documents, with_clashes

from tabfold.llm.licence_texts import CLAUSES
from tabfold.llm.licences import PHRASES, TEMPLATES, Scanner, SuffixAutomaton, scan_licences, words_of


def brute(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    places = []
    for label, phrase in PHRASES:
        wanted = phrase.encode().split()
        places += [(label, i) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    return len(words), sorted(places)


def test_automaton_has_all_runs_and_no_others():
    rng = random.Random(0)
    sequences = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 12))] for _ in range(6)]
    built = SuffixAutomaton(sequences)
    runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for length in range(1, 5):
        for code in range(3**length):
            run = tuple(b"abc"[code // 3**k % 3 :][:1] for k in range(length))
            state = 0
            for word in run:
                state = built.next[state].get(built.vocabulary.get(word), None) if state is not None else None
            assert (state is not None) == (run in runs)
            if state is not None:
                ends = {(n, j) for n, s in enumerate(sequences) for j in range(length, len(s) + 1) if tuple(s[j - length : j]) == run}
                assert built.ends[state] == ends


def test_matching_statistics_of_random_texts():
    rng = random.Random(1)
    scanner = Scanner([("t", "a b a c b"), ("u", "b a b b c a")], [("p", "a b"), ("q", "b"), ("r", "c b a")], shortest_run=1)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c", b"x"]) for _ in range(30)]
        places, _ = scanner.stream(words)
        phrases = [[b"a", b"b"], [b"b"], [b"c", b"b", b"a"]]
        assert sorted(places) == [(n, i) for n, p in enumerate(phrases) for i in range(30) if words[i : i + len(p)] == p]


def test_templates_are_found_with_gaps_and_their_spans():
    scanner = Scanner()
    for number, (label, template) in enumerate(TEMPLATES):
        words = template.split()
        broken = " ".join(["before", *words[: len(words) // 2], *words[len(words) // 2 :], "behind"])
        _, _, spans, _, labels, score = scanner.scan(broken.encode())
        assert label in labels and score > 0.9
        span = next(s for s in spans if s.template == number)
        assert (span.start, span.end) == (1, 1 + len(words_of(template.encode())))
    long = TEMPLATES[4][1]
    gapped = long.replace("binary forms", "binary or other forms")
    assert "bsd" in scanner.scan(gapped.encode())[4]
    assert scanner.scan(" ".join(reversed(long.split())).encode())[4] == []
    assert scanner.scan(long[:40].encode())[4] == []


def test_against_brute_force(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows += [(5000, None), (5001, ""), (5002, "MIT License mit\tlicense. APACHE, license general-public license"), (None, "mit license"), (None, "mit license"),
             (5003, "mit_license mitlicense mit licenses"), (5004, "mit license " * 20_000), (5005, "é mit license É")]
    found = scan_licences(with_clashes(documents(spark, rows))).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        n, places = brute(texts[r.doc_id])
        assert (r.n_words, sorted(map(tuple, r.places))) == (n, places)
        assert r.base_labels == sorted({p[0] for p in places}) and set(r.base_labels) <= set(r.labels)
        assert 0 <= r.score <= 1


def test_empty(spark):
    assert scan_licences(documents(spark, [])).collect() == []


def pieces(text, words):
    split = text.split()
    return [" ".join(split[i : i + words]) for i in range(0, len(split) - words + 1, words)]


def test_every_part_of_a_clause_gives_its_label_alone():
    scanner = Scanner()
    for label, text in CLAUSES:
        found = scanner.scan(f"some words before {text} and behind".encode())
        # Base phrases and short notices inside a clause give labels of their own.
        assert label in found[4] and found[5] == 1.0
        for piece in pieces(text, 24):
            _, _, spans, base, labels, score = scanner.scan(f"xx {piece} yy".encode())
            assert label in labels, piece
            assert score == 1.0
            assert max(s.words for s in spans) >= 16 or base
    mixed = scanner.scan(f"{CLAUSES[0][1]} unrelated {CLAUSES[1][1]}".encode())[4]
    assert {"mit", "bsd"} <= set(mixed)


def test_spans_are_the_longest_common_runs():
    """A single run is compared with all runs of the text and the templates."""
    scanner = Scanner()
    rng = random.Random(3)
    templates = [words_of(t.encode()) for _, t in TEMPLATES]
    for _ in range(60):
        template = rng.choice(templates)
        size = rng.randrange(1, len(template) + 1)
        at = rng.randrange(len(template) - size + 1)
        words = [b"qq", b"zz", *template[at : at + size], b"ww"]
        longest = max(
            (j - i for i in range(len(words)) for j in range(i + 1, len(words) + 1) if any(words[i:j] == t[k : k + j - i] for t in templates for k in range(len(t) - (j - i) + 1))),
            default=0,
        )
        assert longest == size
        _, runs = scanner.stream(words)
        assert (2 + size, size) in [(end, length) for end, length, _ in runs] or size < 3
        _, _, _, _, _, score = scanner.scan(b" ".join(words))
        assert score == 1.0 if size >= 16 else score >= 0


def test_plain_prose_gets_no_label():
    text = "In no event did the author of the software say that the above notice was included in all copies of the book. " * 3
    assert Scanner().scan(text.encode())[4] == []
    assert Scanner().scan(b"all rights were reserved for the guests")[4] == []
    assert Scanner().scan(b"All rights reserved.")[4] == ["reserved"]
