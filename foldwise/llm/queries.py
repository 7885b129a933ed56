"""The registered queries of the corpus operators: thin, whole-table, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import (alignment, bpe, chat, html_density, jaccard_join, langid, lexical_search, packing, pii,
                          sampling_fingerprint, token_records, toxicity, vector_dedup)
from foldwise.llm.common import table
from foldwise.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_JSON = public_tokenizers.path("byte_bpe_50k.json")
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return register


#: For the registered queries only; a deployment passes its own secret.
PII_KEY = "foldwise"


@query("op1_pii_pseudonyms")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.pseudonymize(docs, PII_KEY).select("doc_id", "text", "pii_values", "pii_kinds")


@query("op2_sampling_fingerprint")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling_fingerprint.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op3_bpe_tree")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_RANKS, public_tokenizers.PATTERN, with_ids=False)


JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS k
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common WHERE 100 * k >= 80 * (nx + ny - k)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(v, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.v, e.y FROM reach JOIN both_ways e ON e.x = reach.r)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM sets JOIN reach ON reach.v = sets.doc_id GROUP BY sets.doc_id, s
"""


@query("op4_ngram_jaccard_join", JACCARD_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), 5, 80)


VECTOR_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach(v, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.v, e.y FROM reach JOIN links e ON e.x = reach.r),
least AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON least.v = e.vec_id LEFT JOIN counts ON counts.x = e.vec_id
"""


@query("op5_vector_dedup", VECTOR_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), 0.95)


@query("op6_token_records")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-records")
    token_records.write_records(table(spark, sf_dir, "documents", "doc_id", "text"), path, WORD_JSON, END_ID)
    return token_records.document_digests(token_records.write_index(spark, path))


@query("op7_html_density")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    network = langid.fit(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return langid.predict(table(spark, sf_dir, "documents", "doc_id", "text"), network)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_JSON, END_ID, 1024)


CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
steps AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
    len(regexp_replace(text, '([<\[]\\*)(s>|/s>|INST\]|/INST\]|SYS\]|/SYS\]|OUT\]|ROLE\]|/ROLE\]|TEXT\])', '\1\\\2', 'g')) AS escaped
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(escaped + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 19 + len(role) END) AS BIGINT) AS formatted_chars,
  count(*) FILTER (NOT CASE role WHEN 'system' THEN before IS NULL WHEN 'user' THEN before IS NULL OR before <> 'user'
    WHEN 'assistant' THEN coalesce(before, '') = 'user' ELSE false END) AS n_illegal,
  bool_or(after IS NULL AND role = 'assistant') AS complete
FROM steps GROUP BY conv_id
"""


@query("op11_chat_format", CHAT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said)
    return chat.digests(rows.unionByName(extra))


SEARCH_SQL = r"""
WITH found AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT doc_id, w, len(w) AS n, row_number() OVER () AS r FROM found),
size AS (SELECT count(*) FILTER (n > 0) AS n_all, CAST(sum(n) AS BIGINT) AS l_all FROM docs),
tfs AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY ALL),
dfs AS (SELECT t, count(*) AS df FROM tfs GROUP BY t),
asked AS (SELECT item_id, t, count(*) AS q FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
scores AS (SELECT item_id, doc_id, r, CAST(sum(q * CAST(floor(1000 * ln((2 * n_all + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_all) // l_all)))) AS BIGINT) AS score
  FROM asked JOIN dfs USING (t) JOIN tfs USING (t) JOIN docs USING (r) CROSS JOIN size GROUP BY item_id, doc_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10
"""


@query("op12_lexical_search", SEARCH_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build(table(spark, sf_dir, "documents", "doc_id", "text"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark", "item_id", "text"), 10)


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_JSON, PIECE_MODEL)
