from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.catalogue.registry import registered
from tabfold.catalogue.stop_words import ENGLISH
from tabfold.functions import split_words, without_words
from tabfold.operators import text as op
from tabfold.operators.features import assemble
from tabfold.sources import load_table

SPACE = r"[ \t\n\x0B\f\r]"
STOPS = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)

WORDS = f"""
words AS (
  SELECT doc_id,
    CASE WHEN body = '' AND lowered <> '' THEN []::varchar[]
         ELSE regexp_split_to_array(body, '{SPACE}') END AS w
  FROM (SELECT doc_id, lower(text) AS lowered,
               regexp_replace(lower(text), '{SPACE}+$', '') AS body FROM documents) d
),
kept AS (
  SELECT doc_id, list_filter(w, lambda x: NOT list_contains([{STOPS}], lower(x))) AS w FROM words
)"""


def _summary_sql(source: str) -> str:
    """Whole word lists compared by count and digest."""
    return (
        f"WITH {WORDS} SELECT doc_id, len(w)::integer AS n_words, "
        f"md5(array_to_string(w, ' ')) AS digest FROM {source}"
    )


def _summary(df: DataFrame, words: str) -> DataFrame:
    return df.select(
        "doc_id",
        F.size(words).alias("n_words"),
        F.md5(F.concat_ws(" ", F.col(words))).alias("digest"),
    )


def _kept(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents").select("doc_id", "text")
    return op.remove_stop_words(op.tokenize(docs, "text"), "words").select("doc_id", "kept_words")


@registered(_summary_sql("words"))
def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents").select("doc_id", "text")
    return _summary(op.tokenize(docs, "text"), "words")


@registered(_summary_sql("kept"))
def remove_stop_words(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(_kept(spark, folder), "kept_words")


@registered(_summary_sql("kept"))
def words_as_expressions(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens and stop words with plain array expressions."""
    docs = load_table(spark, folder, "documents")
    words = without_words(split_words(F.col("text")), ENGLISH)
    return _summary(docs.select("doc_id", words.alias("kept_words")), "kept_words")


@registered(
    f"WITH {WORDS} SELECT doc_id, term, count(*) AS n "
    "FROM (SELECT doc_id, unnest(w) AS term FROM kept) t GROUP BY doc_id, term"
)
def term_counts(spark: SparkSession, folder: str) -> DataFrame:
    return op.term_counts(_kept(spark, folder), ["doc_id"], "kept_words")


@registered(f"WITH {WORDS} SELECT doc_id, len(w)::double AS mass FROM kept")
def hashing_tf_mass(spark: SparkSession, folder: str) -> DataFrame:
    hashed = op.hash_terms(_kept(spark, folder), "kept_words")
    return hashed.select("doc_id", op.vector_mass("features").alias("mass"))


LOW32 = 4294967295


def _rotate(x: str, bits: int) -> str:
    return f"((({x} << {bits}) | ({x} >> {32 - bits})) & {LOW32}::ubigint)"


def _times(x: str, factor: int) -> str:
    return f"(({x} * {factor}::ubigint) & {LOW32}::ubigint)"


# The published 32-bit Murmur3 hash of a term's UTF-8 bytes with seed 42, modulo
# 2^18, written for the oracle: blocks of four bytes, little-endian, then the
# zero-padded remainder, then the final mix.
HASHED = f"""
WITH {WORDS},
counts AS (
  SELECT doc_id, term, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS term FROM kept) t GROUP BY doc_id, term
),
bytes AS (
  SELECT term, hex(encode(term)) AS h, strlen(term) AS size
  FROM (SELECT DISTINCT term FROM counts) d
),
blocks AS (
  SELECT term, size,
    [substr(h, 8 * i + 1, 8) for i in range(size // 4)] AS whole,
    rpad(substr(h, 8 * (size // 4) + 1), 8, '0') AS rest
  FROM bytes
),
numbers AS (
  SELECT term, size,
    [('0x' || b[7:8] || b[5:6] || b[3:4] || b[1:2])::ubigint
     for b in list_append(whole, rest)] AS k
  FROM blocks
),
mixed AS (
  SELECT term, size,
    list_transform(
      list_transform(k, lambda x: {_times('x', 0xCC9E2D51)}),
      lambda x: {_times(_rotate('x', 15), 0x1B873593)}) AS k
  FROM numbers
),
folded AS (
  SELECT term, size, k[len(k)] AS last_k,
    list_reduce(
      list_prepend(42::ubigint, k[1:len(k) - 1]),
      lambda s, x: ({_rotate('xor(s, x)', 13)} * 5::ubigint + {0xE6546B64}::ubigint)
                   & {LOW32}::ubigint) AS s
  FROM mixed
),
final1 AS (SELECT term, xor(xor(s, last_k), size::ubigint) AS s FROM folded),
final2 AS (SELECT term, {_times('xor(s, s >> 16)', 0x85EBCA6B)} AS s FROM final1),
final3 AS (SELECT term, {_times('xor(s, s >> 13)', 0xC2B2AE35)} AS s FROM final2),
slots AS (SELECT term, (xor(s, s >> 16) % 262144)::integer AS slot FROM final3)
SELECT doc_id, slot, sum(n)::double AS n FROM counts JOIN slots USING (term) GROUP BY doc_id, slot
"""


@registered(HASHED)
def hashing_tf(spark: SparkSession, folder: str) -> DataFrame:
    hashed = op.hash_terms(_kept(spark, folder), "kept_words")
    return op.hashed_counts(hashed, ["doc_id"], "features")


@registered(
    "SELECT doc_id, slot, n FROM (VALUES (0, 1.0::double), (1, 2.0::double)) v(slot, n), documents "
    "UNION ALL SELECT doc_id + 1000000000, 0, n_chars::double FROM documents WHERE n_chars <> 0"
)
def mixed_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Elements of dense and of sparse vectors in one column; zeros are left out."""
    docs = load_table(spark, folder, "documents").withColumns({"one": F.lit(1.0), "two": F.lit(2.0), "none": F.lit(0.0)})
    # The assembler stores a vector densely or sparsely, whichever is shorter.
    dense = assemble(docs, ["one", "two", "none"], "v").select("doc_id", "v")
    wide = assemble(docs, ["n_chars", *["none"] * 20], "v")
    sparse = wide.select((F.col("doc_id") + 1_000_000_000).alias("doc_id"), "v")
    return op.hashed_counts(dense.unionByName(sparse), ["doc_id"], "v")
