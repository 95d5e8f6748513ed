"""Registered queries of the operators, with production parameters, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aljibe.llm import byte_bpe, conversations, exact_dedup, licenses, packing, pages, pii, runs, simhash, topk, toxicity, url_filter, warc
from aljibe.llm.workers import with_package


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.main_text(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def flagged_urls(spark: SparkSession, folder: str) -> DataFrame:
    """The list of the URL filter: URLs of the pages whose id the labels call toxic."""
    toxic = table(spark, folder, "labels").filter("toxic = 1").select(F.col("doc_id").alias("page_id")).distinct()
    return table(spark, folder, "pages").select("page_id", "url").join(toxic, "page_id", "left_semi").select("url")


def judged_urls(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), flagged_urls(spark, folder)).select("page_id", "host", "path", "rule", "verdict")


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.judged(docs, toxicity.train(docs, table(spark, folder, "labels")))


def top_products(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def warc_records(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages")).drop("url", "payload")


def exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    with exact_dedup.fresh_index(spark) as index:
        return index.deduplicate(table(spark, folder, "documents")).drop("keep_rows")


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.personal_data(docs, pii.train(docs))


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


def byte_ids(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encoded(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def license_places(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


def word_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.periodic_runs(table(spark, folder, "documents"), loop=True)


def mended_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, folder, "conversations")), gone_col="gone")


QUERIES = {name: with_package(query) for name, query in {
    "op1_main_text": main_text,
    "op2_url_filter": judged_urls,
    "op3_toxicity": toxicity_scores,
    "op4_top_products": top_products,
    "op5_warc": warc_records,
    "op6_exact_dedup": exact_copies,
    "op7_personal_data": personal_data,
    "op8_packing": packed_sequences,
    "op9_byte_bpe": byte_ids,
    "op10_simhash": near_copies,
    "op11_licenses": license_places,
    "op12_word_runs": word_runs,
    "op13_conversations": mended_conversations,
}.items()}

OP2 = r"""
WITH urls AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)),
named AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') ||
         CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END END AS canon
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
               lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|gclid|fbclid)='))) AS asked FROM urls)),
listed AS (SELECT DISTINCT canon AS hit FROM named WHERE page_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AND canon IS NOT NULL),
rules(rule_host, rule_path, says) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fitting AS (
  SELECT u.host, u.path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(says, length(rule_host || rule_path)) AS says
  FROM (SELECT DISTINCT host, path FROM urls) u JOIN rules ON (u.host = rule_host OR ends_with(u.host, '.' || rule_host)) AND starts_with(u.path, rule_path)
  GROUP BY ALL)
SELECT n.page_id, n.host, n.path, f.rule, coalesce(f.says, CASE WHEN l.hit IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM named n LEFT JOIN fitting f ON n.host = f.host AND n.path = f.path LEFT JOIN listed l ON n.canon = l.hit
"""

OP4 = """
WITH items AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vector, c.vector)::BIGINT AS score
  FROM items q JOIN items c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP5 = """
WITH payloads AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
responses AS (SELECT payload_digest, max(page_id) AS response FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM payloads LEFT JOIN responses USING (payload_digest)
"""

OP6 = r"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
hashed AS (SELECT doc_id, sha256(text) AS text_sha256 FROM plain),
groups AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM hashed JOIN groups USING (text_sha256)
"""

# The CRC is folded over the bytes of the key. The walk keeps, per state of the grammar, the least (cost, audit, output): nothing yet, after a
# system row, after a user row, after an assistant row. Lists of one state are sorted, so the first item is the cheapest, then the smallest.
OP13 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS bytes
  FROM conversations),
dealt AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM dealt, range(2) AS r(nth) WHERE kind <> 0 AND (nth = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM damaged),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM placed),
told AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS place, [{'cost': 0::BIGINT, 'audit': '', 'out': ''}] AS z, [][:0]::STRUCT(cost BIGINT, audit VARCHAR, out VARCHAR)[] AS s,
         [{'cost': 2::BIGINT, 'audit': 'I', 'out': 'user:'}] AS u, [{'cost': 4::BIGINT, 'audit': 'II', 'out': 'user:' || chr(10) || 'assistant:'}] AS a
  FROM conversations
  UNION ALL
  SELECT conv_id, place, z, s, u2,
         list_sort(list_concat(a1, list_transform(u2, lambda x: {'cost': x.cost + 2, 'audit': x.audit || 'I', 'out': x.out || chr(10) || 'assistant:'})))[:1] AS a
  FROM (
    SELECT *, list_sort(list_concat(u1, list_transform(list_concat(z, s, a1),
              lambda x: {'cost': x.cost + 2, 'audit': x.audit || 'I', 'out': x.out || CASE WHEN x.out = '' THEN '' ELSE chr(10) END || 'user:'})))[:1] AS u2
    FROM (
      SELECT conv_id, place, list_transform(z0, lambda x: {'cost': x.cost + 3, 'audit': x.audit || 'D', 'out': x.out}) AS z,
        list_sort(list_concat(list_transform(s0, lambda x: {'cost': x.cost + 3, 'audit': x.audit || 'D', 'out': x.out}),
          list_transform(CASE WHEN stays AND first = 's' THEN z0 ELSE z0[:0] END, lambda x: {'cost': x.cost + more, 'audit': x.audit || 'K', 'out': role || ':' || text})))[:1] AS s,
        list_sort(list_concat(list_transform(u0, lambda x: {'cost': x.cost + 3, 'audit': x.audit || 'D', 'out': x.out}),
          list_transform(CASE WHEN stays THEN list_concat(z0, s0, a0) ELSE z0[:0] END, lambda x: {'cost': x.cost + more + CASE WHEN first = 'u' THEN 0 ELSE 2 END,
            'audit': x.audit || CASE WHEN first = 'u' THEN 'K' ELSE 'R' END,
            'out': x.out || CASE WHEN x.out = '' THEN '' ELSE chr(10) END || CASE WHEN first = 'u' THEN role ELSE 'user' END || ':' || text})))[:1] AS u1,
        list_sort(list_concat(list_transform(a0, lambda x: {'cost': x.cost + 3, 'audit': x.audit || 'D', 'out': x.out}),
          list_transform(CASE WHEN stays THEN u0 ELSE z0[:0] END, lambda x: {'cost': x.cost + more + CASE WHEN first = 'a' THEN 0 ELSE 2 END,
            'audit': x.audit || CASE WHEN first = 'a' THEN 'K' ELSE 'R' END, 'out': x.out || chr(10) || CASE WHEN first = 'a' THEN role ELSE 'assistant' END || ':' || text})))[:1] AS a1
      FROM (
        SELECT j.conv_id, j.place, w.z AS z0, w.s AS s0, w.u AS u0, w.a AS a0, j.role, j.text, j.role[1] AS first, j.fault NOT IN ('blank', 'duplicate') AS stays,
               CASE WHEN j.fault = 'truncated' THEN 1 ELSE 0 END AS more
        FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1))))
SELECT w.conv_id, coalesce(t.gaps, 0)::BIGINT AS gaps, coalesce(t.blank, 0)::BIGINT AS blank, coalesce(t.duplicate, 0)::BIGINT AS duplicate,
       coalesce(t.truncated, 0)::BIGINT AS truncated, coalesce(t.illegal, 0)::BIGINT AS illegal, best.cost AS cost, best.audit AS audit, sha256(best.out) AS repaired_sha256
FROM (SELECT conv_id, place, list_sort(list_concat(z, a))[1] AS best FROM walk) w LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id
WHERE w.place = coalesce(t.n, 0)
"""

ORACLE = {"op2_url_filter": OP2, "op4_top_products": OP4, "op5_warc": OP5, "op6_exact_dedup": OP6, "op13_conversations": OP13}
