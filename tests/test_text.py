import pytest
from pyspark.ml.feature import HashingTF, StopWordsRemover
from pyspark.sql import functions as F

from tabfold.catalogue.stop_words import ENGLISH
from tabfold.functions import split_words, without_words
from tabfold.operators import text as op

TEXTS = [
    "  Hello,  World\tthe A",
    "",
    "a b ",
    "   ",
    "non\u00a0breaking space",
    "Line\nbreaks\r\nhere\x0b\x0c",
    "ÉCOLE Straße THE the",
    "\u2003em space\u2003",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")


def test_tokens(texts):
    got = {r["id"]: r["words"] for r in op.tokenize(texts, "t").collect()}
    assert got[0] == ["", "", "hello,", "", "world", "the", "a"]
    assert got[1] == [""]
    assert got[2] == ["a", "b"]
    assert got[3] == []
    assert got[4] == ["non\u00a0breaking", "space"]
    assert got[5] == ["line", "breaks", "", "here"]


def test_expression_form_equals_the_ml_tokenizer(texts):
    both = op.tokenize(texts, "t").withColumn("w", split_words(F.col("t"))).collect()
    for r in both:
        assert r["w"] == r["words"], repr(r["t"])


def test_null_text(spark):
    df = spark.createDataFrame([(None,)], "t string")
    with pytest.raises(Exception):
        op.tokenize(df, "t").collect()
    assert df.select(split_words(F.col("t")).alias("w")).first()["w"] is None


def test_stop_words(spark, texts):
    assert StopWordsRemover.loadDefaultStopWords("english") == ENGLISH
    assert len(ENGLISH) == 181
    df = spark.createDataFrame([(["The", "cat", "", "IS", "cat", "a"],)], "words array<string>")
    got = op.remove_stop_words(df, "words").withColumn("w", without_words(F.col("words"), ENGLISH))
    assert got.first()["kept_words"] == ["cat", "", "cat"]
    assert got.first()["w"] == ["cat", "", "cat"]
    own = op.stop_word_remover("words", "k", ["cat"]).transform(df).first()["k"]
    assert own == ["The", "", "IS", "a"]


def test_term_counts(spark):
    words = [["b", "a", "b", "", "b"], [], ["x"], ["é", "e", "é"]]
    df = spark.createDataFrame(list(enumerate(words)), "id int, w array<string>")
    got = {(r["id"], r["term"]): r["n"] for r in op.term_counts(df, ["id"], "w").collect()}
    assert got == {
        (0, "b"): 3,
        (0, "a"): 1,
        (0, ""): 1,
        (2, "x"): 1,
        (3, "é"): 2,
        (3, "e"): 1,
    }


def test_term_counts_do_not_shuffle(spark, capsys):
    df = spark.createDataFrame([(1, ["a"])], "id int, w array<string>")
    op.term_counts(df, ["id"], "w").explain()
    assert "Exchange" not in capsys.readouterr().out


def test_hashed_counts(spark):
    df = spark.createDataFrame([(1, ["spark", "word", "spark"])], "id int, w array<string>")
    hashed = op.hash_terms(df, "w")
    assert hashed.first()["features"].size == op.HASHED_SIZE == 262144
    got = {r["slot"]: r["n"] for r in op.hashed_counts(hashed, ["id"], "features").collect()}
    index = HashingTF(inputCol="w", outputCol="o").indexOf
    assert got == {index("spark"): 2.0, index("word"): 1.0}
    # Collisions add up in a narrow vector.
    narrow = op.hash_terms(df, "w", "f", size=1)
    assert narrow.select(op.vector_mass("f").alias("m")).first()["m"] == 3.0


def test_hashed_counts_of_dense_and_sparse_vectors(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(1, Vectors.dense([0.0, 2.0, 3.0])), (2, Vectors.sparse(3, {0: 5.0, 2: 0.0})), (3, None), (4, Vectors.sparse(3, {}))]
    df = spark.createDataFrame(rows, ["id", "v"])
    got = [tuple(r) for r in op.hashed_counts(df, ["id"], "v").orderBy("id", "slot").collect()]
    assert got == [(1, 1, 2.0), (1, 2, 3.0), (2, 0, 5.0)]
