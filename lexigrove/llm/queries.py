"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where an installed public vocabulary lies; executors have the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Fixed URL rules of the registered query.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.url_filters import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.warc import archive_table

    return archive_table(table(spark, sf_dir, "pages"), min_bytes=0)


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.token_ids import token_table

    return token_table(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2, special_as_text=False)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest", runs=16, fan_in=4)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.decontamination import decontamination_report

    return decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.chat_format import chat_report

    hard = spark.sql("""SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)""")
    return chat_report(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.mixing import mix_report

    return mix_report(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_epochs=3)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.toxicity import toxicity_report

    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.near_dedup import near_components

    return near_components(table(spark, sf_dir, "documents"), width=5, percent=75, bands=32, rows=4)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.licenses import license_report

    return license_report(table(spark, sf_dir, "documents"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.embedding_dedup import embedding_components

    return embedding_components(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.filter_audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexigrove.llm.periodic_runs import periodic_runs

    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_warc": op2_warc,
    "op3_token_ids": op3_token_ids,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_chat_format": op6_chat_format,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_near_dedup": op9_near_dedup,
    "op10_licenses": op10_licenses,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
}

_OP4 = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

_OP2 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
)
SELECT page_id, payload_bytes,
       list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), lambda a, b: a || b) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p
"""

_OP6 = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), put AS (
  SELECT *, length(CASE WHEN regexp_matches(role, '\\[/?INST\\]|</?s>|&(lt|#91|amp);') THEN replace(replace(replace(role, '&', '&amp;'), '[', '&#91;'), '<', '&lt;') ELSE role END) AS n_role,
         length(CASE WHEN regexp_matches(text, '\\[/?INST\\]|</?s>|&(lt|#91|amp);') THEN replace(replace(replace(text, '&', '&amp;'), '[', '&#91;'), '<', '&lt;') ELSE text END) AS n_text
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(7 + n_role + 9 + n_text + 4)::BIGINT AS formatted_chars
FROM put GROUP BY conv_id
"""

_OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
                      THEN embedding::DOUBLE[] END AS e FROM embeddings
), u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) >= 0.9),
r AS (
  WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
  SELECT a, min(b) AS least FROM reach GROUP BY a
), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(least, vec_id), vec_id) AS component_id, coalesce(least(least, vec_id), vec_id) = vec_id AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN r ON r.a = vec_id
"""

_OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         coalesce(min(doc_id) OVER (PARTITION BY coalesce(text, '')) < doc_id, false) AS e FROM documents
), l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text))::INT
           + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * e::INT AS failed
  FROM d LEFT JOIN l USING (doc_id)
), c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM f GROUP BY ALL),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(k, bit)),
o AS (
  SELECT a.k || b.k || c.k || d.k || e.k AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s AS (
  SELECT filter_order, k AS step, bits[k] AS own, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before FROM o, (SELECT unnest(range(1, 6))::INT AS k)
)
SELECT part, filter_order, step,
       (coalesce(sum(n) FILTER (failed & (own | before) = 0), 0))::BIGINT AS kept,
       (coalesce(sum(n) FILTER (failed & own <> 0 AND failed & before = 0), 0))::BIGINT AS removed,
       (coalesce(sum(n) FILTER (failed & own <> 0 AND failed & before <> 0), 0))::BIGINT AS redundant,
       (coalesce(sum(n) FILTER (failed = own), 0))::BIGINT AS unique_fails,
       (coalesce(sum(n_good) FILTER (failed & own <> 0 AND failed & before = 0), 0))::BIGINT AS good_lost,
       (coalesce(sum(n_toxic) FILTER (failed & own <> 0 AND failed & before = 0), 0))::BIGINT AS toxic_lost,
       (coalesce(sum(n * 120 // nullif(bit_count(failed), 0)) FILTER (failed & own <> 0), 0))::BIGINT AS shapley
FROM c, s GROUP BY ALL
"""

ORACLE_SQL: dict[str, str] = {"op11_embedding_dedup": _OP11, "op12_filter_audit": _OP12, "op2_warc": _OP2, "op4_exact_dedup": _OP4, "op6_chat_format": _OP6}
