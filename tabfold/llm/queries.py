"""The queries of this subpackage and their SQL, as ``__spark_entry__`` adds them."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.llm import embedding_dedup, language, licences, merkle, mixing, packing, repeats, simhash, spelling, topk, toxicity, url_filter, wrappers
from tabfold.llm.common import hash_part, lower_ascii, small_batches, table

QUERIES, ORACLES = {}, {}

# The tokenizer of the packing contract, by the name the installed files have.
TOKENIZER = "word_bpe_49k.json"


def registered(oracle: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


# The rules of the URL contract, as (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

URL_SQL = f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path,
    row_number() OVER () AS seq
  FROM pages
), fits AS (
  SELECT seq, r_host || r_path AS rule, r_verdict,
    row_number() OVER (PARTITION BY seq ORDER BY length(r_host || r_path) DESC, length(r_host) DESC,
      r_verdict DESC) AS rank
  FROM parts JOIN rules ON starts_with(path, r_path) AND (host = r_host OR ends_with(host, '.' || r_host))
)
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE rank = 1) USING (seq)
"""


@registered(URL_SQL)
def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, folder, "pages"), rules, keep=["page_id"])


# The draw of the mix: 13 hex digits of md5 as a number between 0 and 1.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size,
    (('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || '-42'), 1, 13))::bigint::double + 0.5)
      / 4503599627370496.0 AS draw
  FROM documents
), sources AS (
  SELECT source, sum(size)::bigint AS source_size,
    ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)]::double AS weight
  FROM sized GROUP BY source
), roomed AS (
  SELECT *, 3.0::double * source_size AS cap, 3.0::double * source_size / weight AS room FROM sources
), levelled AS (
  SELECT *, (sum(source_size::double) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    AS level
  FROM roomed
), targets AS (
  SELECT source, source_size,
    coalesce(least(cap, weight * (SELECT arg_min(level, room) FROM levelled WHERE level <= room)), cap) AS target
  FROM levelled
), rated AS (
  SELECT doc_id, s.source, size, source_size, target, draw,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::double END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, target - floor(rate) * source_size AS words,
    draw / (draw + (1.0::double - draw) * ((rate - floor(rate)) / (1.0::double - (rate - floor(rate))) * 1.0::double)) AS rank
  FROM rated
), units AS (
  SELECT source, words, rank, size, sum(size) AS n FROM ranked GROUP BY ALL
), summed AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY rank, size), 0) AS upto FROM units
), first_ones AS (
  SELECT *, size > 0 AND words > 0 AND upto <= words AS taken FROM summed
), gaps AS (
  SELECT source, words - coalesce(max(CASE WHEN upto <= words THEN upto END), 0) AS gap FROM first_ones GROUP BY source, words
), closing AS (
  SELECT f.source, arg_min({'rank': rank, 'size': size, 'n': n, 'gap': gap}, (abs(gap - size), rank, size)) AS c
  FROM first_ones f JOIN gaps g ON f.source IS NOT DISTINCT FROM g.source
  WHERE NOT taken AND size > 0 AND abs(gap - size) < gap GROUP BY f.source
), extra AS (
  SELECT source, rank, size FROM first_ones WHERE taken
  UNION ALL
  SELECT source, c.rank, c.size FROM closing WHERE abs(c.gap - c.n) < c.gap
)
SELECT r.doc_id, r.size, source_size, target,
  (r.size * (floor(rate) + (e.size IS NOT NULL)::int))::bigint AS taken
FROM ranked r LEFT JOIN extra e
  ON r.source IS NOT DISTINCT FROM e.source AND r.rank = e.rank AND r.size = e.size
"""


@registered(MIX_SQL)
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.copies(table(spark, folder, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken)


@registered()
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = simhash.hex_digits(F.col("fingerprint")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


@registered()
def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def toxicity_lexicon(docs: DataFrame, labels: DataFrame) -> toxicity.Lexicon:
    """Learned from the labelled documents that are not held out."""
    return toxicity.learn(docs, labels.where(hash_part(3, F.col("doc_id")) != 1))


@registered()
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lexicon = toxicity_lexicon(docs, table(spark, folder, "labels"))
    scored = toxicity.with_score(docs.select("doc_id", "text"), lexicon)
    return scored.select(
        "doc_id",
        F.coalesce(hash_part(3, F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.TOXIC_SCORE).cast("int").alias("predicted"),
    )


@registered()
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(hash_part(4, F.col("doc_id")) == 2, F.lit(False))
    profiles = language.learn(docs.where(~held_out))
    found = language.with_language(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@registered()
def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan_licences(table(spark, folder, "documents"))
    starts = F.col("places.start")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@registered()
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    pieces = packing.pack(table(spark, folder, "documents"), path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


# Every other row of a query, scored by the inner product of the floored components.
TOP_K_SQL = """
WITH coded AS (
  SELECT vec_id, row_number() OVER () AS row_no,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS codes
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_aggregate(list_transform(embedding,
    lambda x: coalesce(isfinite(x), false)), 'bool_and')
), scored AS (
  SELECT q.vec_id AS query_id, q.row_no AS query_row, c.vec_id,
    list_inner_product(q.codes::double[], c.codes::double[])::bigint AS score
  FROM coded q JOIN coded c ON q.row_no <> c.row_no AND len(q.codes) = len(c.codes)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, vec_id, score,
    row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id)::int AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@registered(TOP_K_SQL)
def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@registered()
def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return repeats.repeats(table(spark, folder, "documents"))


def crc32_sql(text: str) -> str:
    """DuckDB text of the unsigned crc32 of a string's UTF-8; wants the table ``crc(t)`` in scope."""
    octets = f"list_transform(range(1, 2 * strlen({text}) + 1, 2), lambda i: ('0x' || substr(hex(encode({text})), i, 2))::bigint)"
    step = "lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), {step}), 4294967295)"


# The table of crc32: eight steps of its polynomial (fixed value) for each octet.
CRC_TABLE_SQL = """crc AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::bigint, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::bigint) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
)"""

MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _leaf_sql(columns: list[str]) -> str:
    coded = [f"coalesce(strlen(({c})::varchar)::varchar || ':' || ({c})::varchar, '-')" for c in columns]
    return f"sha256({' || '.join(coded)})"


def _tree_sql(name: str, key: str, height: int) -> str:
    """Runs and nodes of a tree over ``name``0, as tables up to ``height`` levels above; a lone node stays."""
    found = []
    for k in range(height):
        found.append(f"""{name}_run{k} AS (SELECT {key}, i // 16 AS p, list(d ORDER BY i) AS run FROM {name}{k} WHERE n > 1 GROUP BY ALL),
{name}{k + 1} AS (
  SELECT {key}, i, d, n FROM {name}{k} WHERE n = 1
  UNION ALL SELECT {key}, p, sha256(array_to_string(run, '')), count(*) OVER (PARTITION BY {key}) FROM {name}_run{k})""")
    return ",\n".join(found)


def _climb_sql(name: str, key: str, height: int) -> str:
    """Siblings and the changed digest on the way up, one step a level, from ``up_{name}0``."""
    found = []
    for k in range(height):
        found.append(f"""up_{name}{k + 1} AS (
  SELECT u.* REPLACE (u.i // 16 AS i,
    u.proof || coalesce(array_to_string(r.run[1:u.i % 16] || r.run[u.i % 16 + 2:], ''), '') AS proof,
    CASE WHEN r.run IS NULL THEN u.fold
      ELSE sha256(array_to_string(r.run[1:u.i % 16] || [u.fold] || r.run[u.i % 16 + 2:], '')) END AS fold)
  FROM up_{name}{k} u LEFT JOIN {name}_run{k} r ON u.{key} IS NOT DISTINCT FROM r.{key} AND u.i // 16 = r.p)""")
    return ",\n".join(found)


# Room for 16**6 documents of a source and 16**3 sources.
MANIFEST_SQL = f"""
WITH {CRC_TABLE_SQL}, leaves AS (
  SELECT doc_id, source, {_leaf_sql(MANIFEST_FIELDS)} AS leaf,
    CASE WHEN {crc32_sql("doc_id::varchar")} % 5 = 0 THEN {_leaf_sql([*MANIFEST_FIELDS[:-1],
      "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"])} END AS changed
  FROM documents, crc
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), doc0 AS (SELECT source, i, leaf AS d, n FROM placed),
{_tree_sql("doc", "source", 6)},
src0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, d, count(*) OVER () AS n, source FROM doc6),
{_tree_sql("src", "one", 3)},
up_doc0 AS (SELECT doc_id, source, leaf, i, '' AS proof, coalesce(changed, leaf) AS fold FROM placed),
{_climb_sql("doc", "source", 6)},
up_src0 AS (
  SELECT doc_id, leaf, s.d AS subroot, s.one, s.i, proof, fold
  FROM up_doc6 u JOIN src0 s ON u.source IS NOT DISTINCT FROM s.source),
{_climb_sql("src", "one", 3)}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = d AS verified
FROM up_src3, src3
"""


@registered(MANIFEST_SQL)
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tree = merkle.manifest(
        table(spark, folder, "documents"),
        id="doc_id",
        group="source",
        fields=MANIFEST_FIELDS,
        changed={"text": lower_ascii(F.col("text"))},
        when=hash_part(5, F.col("doc_id")) == 0,
    )
    return tree.proofs().withColumnsRenamed({"id": "doc_id", "proof": "proof_sha256"})


# Near words share a text of theirs with one code point marked or left out.
SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL}, found AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zA-ZÀ-ÿ]+')) AS run
    FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL
), coded AS (
  SELECT run, n, {crc32_sql("(doc_id || ':' || run)")} AS h FROM found, crc
), words AS (
  SELECT word, sum(n)::bigint AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
      ELSE run END AS word, n FROM coded)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), holes AS (
  SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b
  FROM words, (SELECT unnest(range(1, 1 + (SELECT max(length(word)) FROM words))) AS i) WHERE i <= length(word)
), pairs AS (
  SELECT DISTINCT x.word, x.n, y.word AS near, y.n AS near_n FROM holes x JOIN holes y USING (a, b, i) WHERE x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM holes x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, y.n, x.word, x.n FROM holes x JOIN words y ON x.a || x.b = y.word
), near AS (
  SELECT word, count(*) AS n_near,
    min({{'less': -near_n, 'form': near}}) FILTER (near_n >= 10 * n) AS best
  FROM pairs GROUP BY word
), roots AS (
  SELECT word, best.form AS root FROM near WHERE best IS NOT NULL
  UNION SELECT r.word, n.best.form FROM roots r JOIN near n ON r.root = n.word WHERE n.best IS NOT NULL
)
SELECT w.word, best.form AS form, coalesce(r.root, w.word) AS root, w.n, coalesce(n_near, 0)::bigint AS n_near,
  (-best.less)::bigint AS form_n
FROM words w LEFT JOIN near ON w.word = near.word
LEFT JOIN (SELECT r.word, r.root FROM roots r LEFT JOIN near n ON r.root = n.word WHERE n.best IS NULL) r ON r.word = w.word
"""


@registered(SPELLING_SQL)
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, folder, "documents")))


# The article by its own tags, which the pages of the given tables have; the query infers where it is.
ARTICLE_SQL = r"""
WITH bodies AS (
  SELECT page_id, url, coalesce(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '') AS body FROM pages
), plain AS (
  SELECT page_id, url, regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS body FROM bodies
), decoded AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(body, '&#x27;', ''''),
    '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') AS body
  FROM plain
), spaced AS (SELECT page_id, url, trim(regexp_replace(body, '\s+', ' ', 'g')) AS text FROM decoded)
SELECT page_id, url, text, length(text) AS n_chars FROM spaced
"""


@registered(ARTICLE_SQL)
def op11_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = wrappers.main_text(table(spark, folder, "pages"), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
