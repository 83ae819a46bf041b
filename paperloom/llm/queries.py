"""The operators applied to their whole tables, with production parameters.

Imported by ``__spark_entry__`` where this subpackage is present.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.llm import chat, decontam, embed_dedup, lmscore, ngram_join, packing, secrets, toxicity, url_filter, warc
from paperloom.llm.common import crc_mod, small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, url_filter.parse_rules(RULES)).drop("url")


OP3_SQL = r"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM r
), rules(h, q, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best AS (
  SELECT page_id, max_by(h || q, length(h || q)) AS rule, max_by(v, length(h || q)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (page_id)
"""


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest_spans(docs, secrets.fit_formats(docs))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_vectors(_table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CASE WHEN list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0
                      THEN embedding::DOUBLE[] END AS e
  FROM embeddings
), u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE e IS NOT NULL),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
n AS (SELECT x, count(*) AS k FROM links GROUP BY x), c AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, least(vec_id, coalesce(m, vec_id)) = vec_id AS kept
FROM v LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id
"""


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
t AS (SELECT payload_digest, max(page_id) AS target FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND target <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND target <> page_id THEN target END AS refers_to
FROM p LEFT JOIN t USING (payload_digest)
"""


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_pairs(chat.neighbours_as_pairs(_table(spark, sf_dir, "conversations")))


OP9_SQL = r"""
WITH t AS (
  SELECT conv_id // 2 AS pair_id, CASE WHEN conv_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side, turn,
         coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), n AS (
  SELECT pair_id, side, turn, row_number() OVER (PARTITION BY pair_id, side, turn ORDER BY role, text)::INT AS tie, role,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered
  FROM t
), b AS (
  SELECT pair_id, turn, tie, max(rendered) FILTER (WHERE side = 'chosen') AS c, max(role) FILTER (WHERE side = 'chosen') AS cr,
         max(rendered) FILTER (WHERE side = 'rejected') AS r, max(role) FILTER (WHERE side = 'rejected') AS rr
  FROM n GROUP BY pair_id, turn, tie
), f AS (
  SELECT *, count(*) FILTER (WHERE c IS DISTINCT FROM r) OVER (PARTITION BY pair_id ORDER BY turn, tie) AS broken FROM b
)
SELECT pair_id, 'prompt' AS part, turn, tie, c AS rendered, false AS masked FROM f WHERE broken = 0
UNION ALL SELECT pair_id, 'chosen', turn, tie, c, cr = 'assistant' FROM f WHERE broken > 0 AND c IS NOT NULL
UNION ALL SELECT pair_id, 'rejected', turn, tie, r, rr = 'assistant' FROM f WHERE broken > 0 AND r IS NOT NULL
"""


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS items
  FROM w
), s AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(x, y) AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, len(items)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM sets LEFT JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) ON x = doc_id
"""


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.find_items(docs, _table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False))
    return lmscore.score(docs.withColumn("held_out", held_out), docs.where(~held_out))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_url_filter": op3_url_filter,
        "op4_secret_scan": op4_secret_scan,
        "op5_decontaminate": op5_decontaminate,
        "op6_toxicity": op6_toxicity,
        "op7_embedding_dedup": op7_embedding_dedup,
        "op8_warc": op8_warc,
        "op9_chat_format": op9_chat_format,
        "op10_lm_score": op10_lm_score,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_join": OP1_SQL, "op3_url_filter": OP3_SQL, "op7_embedding_dedup": OP7_SQL, "op8_warc": OP8_SQL, "op9_chat_format": OP9_SQL}
