import numpy as np
from helpers import documents, with_clashes
from pyspark.sql import functions as F

from tabfold.llm.language import BLANK, judge, learn, most_frequent, ngrams, signs_of, with_language
from tabfold.llm.queries import op6_language

EN = "the cat and the dog were in the house with that other thing"
DE = "der hund und die katze waren nicht in dem haus mit einem ding"


def test_distance_is_out_of_place(spark):
    docs = documents(spark, [(1, EN, "en"), (2, DE, "de"), (3, None, "en"), (4, "x", None)])
    profiles = learn(docs)
    assert profiles.names == ["de", "en"]
    text = "the house and the cat"
    own = most_frequent(ngrams(signs_of(text)), 300).tolist()
    distance = {
        name: sum(abs(ranks.index(g) - i) if g in ranks else 400 - i for i, g in enumerate(own)) for name, ranks in profiles.ranks.items()
    }
    name, score = judge(text, profiles.names, profiles.table())
    assert name == min(sorted(distance), key=distance.get) == "en"
    assert score == 1 - distance["en"] / (400 * len(own))


def test_ngrams_count_what_they_should():
    signs = signs_of("Ab,  é1")
    assert [int(s != BLANK) for s in signs] == [0, 1, 1, 0, 1, 0]
    assert len(ngrams(signs)) == 3 + 5 + 3
    assert signs_of("AÉ").tolist() == signs_of("aé").tolist()
    assert len(set(signs_of("привет")[1:-1].tolist())) == 6


def test_defined_results(spark):
    rows = [(1, EN, "en"), (2, DE, "de"), (3, None, "en"), (4, "", None), (5, "12 !?", "de"), (None, EN, "en"), (1, EN, "en"), (6, (EN + " ") * 5000, "en"),
            (7, "퟿\U0001f600", "en")]
    docs = with_clashes(documents(spark, rows))
    found = with_language(docs, learn(docs))
    assert found.columns == [*docs.columns, "lang_pred", "lang_score"]
    got = [(r.doc_id, r.lang_pred) for r in found.collect()]
    assert got[:7] == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (1, "en")]
    assert got[7] == (6, "en")
    untaught = with_language(docs, learn(docs.where("lang IS NULL")))
    assert {(r.lang_pred, r.lang_score) for r in untaught.collect()} == {("und", 0.0)}
    assert with_language(docs.limit(0), learn(docs)).collect() == []


def test_query_on_held_out_rows(spark, folder):
    found = op6_language(spark, folder)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    checked = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert checked.where(F.col("lang_pred") == F.col("lang")).count() >= 0.95 * checked.count() > 0
    assert np.isfinite([r.score for r in found.collect()]).all()
