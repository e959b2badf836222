import math
import random

from helpers import documents, with_clashes
from pyspark.sql import functions as F

from tabfold.llm import toxicity
from tabfold.llm.queries import op5_toxicity
from tabfold.llm.toxicity import Lexicon, fold, learn, with_score, without_toxic

LABELS = "doc_id long, toxic int"


def corpus():
    rng = random.Random(0)
    words = ["ab" + c + d for c in "cdefghjkm" for d in "nprtuvwyz"]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(rng.choice([10, 40, 200]))]
        if i % 5 == 0:
            for _ in range(2 + len(text) // 50):
                text.insert(rng.randrange(len(text)), rng.choice(["moron", "nastyling", "nastyous", "nastyment"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    return rows, labels


def test_folding():
    assert fold("Mor0n mоrоn ｍｏｒｏｎ") == " moron moron moron "
    assert fold("1D!0T, idiot\tL0ser") == " idiot idiot ioser "
    assert fold("") == "  "
    # Marks, signs without width and other scripts; signs that end a word are no letters.
    assert fold("mo\u0301ro\u0308n m\u200bo\u00adron m\u03bfr\u0585n m\u00f8ron") == " moron moron moron moron "
    assert fold("moron!! $hit! a!b") == " moron shit aib "


def test_learned_lexicon_finds_disguised_words(spark):
    rows, labels = corpus()
    new = [(9000, "ab cd m0r0n ef"), (9001, "ab nastyfication x"), (9002, "clean words only"), (9003, None), (9004, ""), (9005, "MОRON " * 20_000)]
    docs = with_clashes(documents(spark, rows + new))
    lexicon = learn(docs, spark.createDataFrame(labels + [(1, None), (None, 1), (77777, 1)], LABELS))
    scores = {r.doc_id: r.score for r in with_score(docs.select("doc_id", "text"), lexicon).collect()}
    assert all((scores[i] >= 0.7) == bool(t) for i, t in labels)
    assert [scores[i] >= 0.7 for i in range(9000, 9006)] == [True, True, False, False, False, True]
    assert scores[9003] == scores[9004] == 0.0
    kept = without_toxic(docs, lexicon)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s < 0.7}


def test_exceptions_spare_and_repeats_saturate():
    lexicon = Lexicon({"tras": 3.0, "idiot ": 2.0}, ("trash can",))
    built = lexicon.automaton()
    assert lexicon.density("a trash can here", built) == 0.0
    assert lexicon.density("a trash, can you", built) == 0.0  # punctuation folds to a space
    assert lexicon.density("trash", built) > 0 and lexicon.density("idiotic", built) == 0.0
    once, often = (lexicon.density("idiot " * n, built) for n in (1, 100))
    assert once < often < 10 * once


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "moron"), (None, "x")])
    lexicon = learn(docs, spark.createDataFrame([(1, 0)], LABELS))
    assert lexicon.weights == {}
    assert {r.score for r in with_score(docs, lexicon).collect()} == {0.0}
    empty = documents(spark, [])
    assert with_score(empty, learn(empty, spark.createDataFrame([], LABELS))).collect() == []


def test_bound_on_labelled_rows(spark):
    rows, labels = corpus()
    found = toxicity.training_rows(documents(spark, rows + [(9000, rows[0][1])]), spark.createDataFrame(labels + [(9000, 1)], LABELS),
                                   doc_id="doc_id", text="text", max_rows=200)
    assert 100 < found.count() < 300
    every = toxicity.training_rows(documents(spark, rows + [(9000, rows[0][1])]), spark.createDataFrame(labels + [(9000, 1)], LABELS),
                                   doc_id="doc_id", text="text", max_rows=1000)
    assert every.count() == 400  # a copy with the same label counts once


def test_query_on_held_out_rows(spark, folder):
    data = folder.replace("sf0.001", "sf0.01")
    found = op5_toxicity(spark, data)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{data}/labels.parquet")
    checked = found.join(labels, "doc_id").where("held_out")
    right = checked.where(F.col("predicted") == F.col("toxic")).count()
    assert right >= 0.95 * checked.count()


def test_a_rare_and_a_long_word_are_found(spark):
    rng = random.Random(5)
    words = ["ab" + c + d for c in "cdefghjkm" for d in "nprtuvwyz"]
    rows, labels = [], []
    for i in range(4000):
        text = [rng.choice(words) for _ in range(20)] + [f"u{i}"]
        if i % 4 == 0:
            # One in half a hundred toxic rows, another in most.
            text.append("blatherskiteandscoundrelism" if i % 100 == 0 else "zounder" if i % 80 == 0 else "moron")
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    docs = documents(spark, rows)
    lexicon = learn(docs, spark.createDataFrame(labels, LABELS))
    for word in ("moron", "zounder", "blatherskiteandscoundrelism"):
        assert any(fold(word)[1:].startswith(term) for term in lexicon.weights), word
    assert len([t for t in lexicon.weights if t.startswith("ab")]) == 0


def test_a_word_of_one_in_two_hundred_toxic_rows_is_found(spark):
    rows = [(i, f"w{i % 97} w{i % 89} " + ("zounder" if i % 400 == 0 else "moron" if i % 2 == 0 else "fine")) for i in range(8000)]
    labels = [(i, int(i % 2 == 0)) for i in range(8000)]
    lexicon = learn(documents(spark, [(i, f"{t} n{i}") for i, t in rows]), spark.createDataFrame(labels, LABELS))
    assert any("zounder ".startswith(term) for term in lexicon.weights)


def test_exceptions_are_learned_from_clean_rows(spark):
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 3 == 0
        clean = "the trash can is full" if i % 24 == 1 else "plain words here"
        rows.append((i, f"n{i} {'you are trash really' if toxic else clean} m{i}"))
        labels.append((i, int(toxic)))
    lexicon = learn(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert "trash can" in lexicon.exceptions
    assert not any("are trash" in e or "really" in e for e in lexicon.exceptions)
    built = lexicon.automaton()
    assert lexicon.density("a trash can", built) == 0.0 < lexicon.density("such trash", built)


def test_density_by_brute_force():
    rng = random.Random(2)
    lexicon = Lexicon({"abc": 1.0, "abcd ": 2.5, "b ": 0.5, "cab": 1.5}, ("cab b",))
    built = lexicon.automaton()
    for _ in range(200):
        words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(12))]
        meant = {}
        for i, w in enumerate(words):
            terms = [t for t in lexicon.weights if f"{w} ".startswith(t)]
            pairs = [words[i - 1 : i + 1] if i else [], words[i : i + 2]]
            if terms and ["cab", "b"] not in pairs:
                term = max(terms, key=lexicon.weights.get)
                meant[term] = meant.get(term, 0) + 1
        want = sum(lexicon.weights[t] * (1 + math.log(n)) for t, n in meant.items()) / math.sqrt(1 + (len(words) + 1) / lexicon.length)
        assert abs(lexicon.density(" ".join(words), built) - want) < 1e-9 or not words
