"""One registered query per operator, over the whole table it is meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade.llm.ball_tree import exact_top_k, grid_vectors
from sitegrade.llm.chat_format import conversation_digests, text_part
from sitegrade.llm.collocations import collocations
from sitegrade.llm.common import table
from sitegrade.llm.fingerprints import fingerprints
from sitegrade.llm.harmonic_packing import pack
from sitegrade.llm.hilbert_search import nearest, usable_vectors
from sitegrade.llm.html_text import extract_pages
from sitegrade.llm.near_duplicates import near_duplicates
from sitegrade.llm.piece_lattice import encode_documents
from sitegrade.llm.secrets import secret_report
from sitegrade.llm.spelling import spelling_variants
from sitegrade.llm.token_counts import count_tokens
from sitegrade.llm.toxicity import toxicity


def op1_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = grid_vectors(table(spark, sf_dir, "embeddings"))
    asked = grid.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return exact_top_k(grid, asked)


OP3_SQL = """
WITH grid AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM grid q JOIN grid c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""


#: A conversation whose texts hold control strings of other templates.
ODD_CONVERSATION = [
    (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_CONVERSATION, rows.schema)
    return conversation_digests(rows.unionByName(odd).select(
        "conv_id", "turn", "role", text_part(F.col("text")).alias("parts")))


OP4_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), told AS (
  SELECT *, replace(replace(text, '&', '&amp;'), '<', '&lt;') AS body,
         replace(replace(role, '&', '&amp;'), '<', '&lt;') AS name
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
         ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body)
         FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(name) + length(body) + 23) AS BIGINT) AS formatted_chars
FROM told GROUP BY conv_id
"""


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op10_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable_vectors(table(spark, sf_dir, "embeddings"))
    asked = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"))
    return nearest(vectors, asked)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH pieces AS MATERIALIZED (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents)
), f AS MATERIALIZED (
  SELECT lang, k, words, count(*) AS a FROM (
    SELECT lang, k, ws[i:i + k - 1] AS words
    FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
          FROM pieces CROSS JOIN (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE len(ws) >= k))
  GROUP BY ALL
), candidates AS MATERIALIZED (
  SELECT * FROM f WHERE k >= 2 AND a >= 30
), parts AS (
  SELECT lang, words[i:i + m - 1] AS words, max(a) AS cover
  FROM (SELECT lang, words, a, k, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT lang, words, a, k, unnest(range(2, k)) AS m FROM candidates))
  GROUP BY ALL
), cuts AS MATERIALIZED (
  SELECT *, words[1:cut] AS first_words, words[cut + 1:k] AS last_words
  FROM (SELECT lang, words, k, a, unnest(range(1, k)) AS cut FROM candidates)
), lefts AS MATERIALIZED (
  SELECT c.*, f.a AS l FROM cuts c JOIN f ON f.lang = c.lang AND f.words = c.first_words
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) AS place FROM (
    SELECT c.lang, c.words, c.a, c.cut, c.l, f.a AS r,
           CAST((CAST(2000000 AS HUGEINT) * c.a) // (c.l + f.a) AS BIGINT) AS score
    FROM lefts c JOIN f ON f.lang = c.lang AND f.words = c.last_words)
), ranked AS (
  SELECT b.lang, array_to_string(b.words, ' ') AS phrase, b.a, b.l, b.r, b.score
  FROM best b LEFT JOIN parts p ON p.lang = b.lang AND p.words = b.words
  WHERE b.place = 1 AND (p.cover IS NULL OR 100 * p.cover < 80 * b.a)
)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked
) JOIN (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang) USING (lang)
WHERE rank <= 2000
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH RECURSIVE checksums AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END)) AS byte_sums
), runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL
), summed AS (
  SELECT run, times, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b:
      xor(c >> 8, byte_sums[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT)) AS h
  FROM (SELECT run, times, list_transform(range(0, length(digits) // 2), lambda i:
          CAST(('0x' || substr(digits, 2 * i + 1, 2)) AS BIGINT)) AS bytes
        FROM (SELECT run, times, hex(doc_id || ':' || run) AS digits FROM runs)), checksums
), words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM summed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), cut AS MATERIALIZED (
  SELECT word, n, word AS rest, -1 AS i FROM words
  UNION ALL SELECT word, n, substr(word, 1, i) || substr(word, i + 2) AS rest, i
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS MATERIALIZED (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n
  FROM cut a JOIN cut b ON a.rest = b.rest AND a.word <> b.word
  WHERE a.i = b.i OR a.i = -1 OR b.i = -1
), best AS MATERIALIZED (
  SELECT word, n, count(*) AS n_near, min((-near_n, near)) AS first FROM near GROUP BY word, n
), forms AS MATERIALIZED (
  SELECT word, n_near, CASE WHEN -first[1] >= 5 * n THEN first[2] END AS form,
         CASE WHEN -first[1] >= 5 * n THEN -first[1] END AS form_n FROM best
), chains AS (
  SELECT word, form AS root FROM forms WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
), ends AS (
  SELECT c.word, c.root FROM chains c LEFT JOIN forms f ON f.word = c.root WHERE f.form IS NULL
)
SELECT w.word, f.form, coalesce(e.root, w.word) AS root, w.n,
       CAST(coalesce(f.n_near, 0) AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM words w LEFT JOIN forms f USING (word) LEFT JOIN ends e USING (word)
"""


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_piece_lattice, op2_token_counts, op3_exact_top_k, op4_chat_format, op5_html_text,
              op6_toxicity, op7_minhash_near_duplicates, op8_harmonic_packing,
              op9_secret_scan, op10_hilbert_neighbours, op11_phrase_collocations,
              op12_spelling_variants, op13_fingerprints)
}

#: Twins of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op3_exact_top_k": OP3_SQL, "op4_chat_format": OP4_SQL, "op11_phrase_collocations": OP11_SQL,
    "op12_spelling_variants": OP12_SQL}
