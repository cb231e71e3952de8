"""Registered queries of the corpus operators: thin wrappers over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from admill.llm import decontam, hard_negatives, language, license_scan, line_templates, packing, quality, resampling, secret_scan, simhash, token_shards, toxicity, warc
from admill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.sharded_documents(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_report(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.line_report(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    fs = (op1_license_scan, op2_toxicity, op3_token_shards, op4_packing, op5_simhash, op6_warc, op7_quality_rules, op8_secret_scan, op9_line_dedup, op10_decontamination)
    return {f.__name__: f for f in (*fs, op11_language_id, op12_hard_negatives, op13_resampling)}


#: base32 of a hex SHA-1, five bits at a time, spelt out because DuckDB has no such function.
_OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha FROM pages),
d AS (SELECT sha, min(page_id) AS first_id, any_value(body) AS body FROM p GROUP BY sha),
b AS (SELECT sha, first_id, octet_length(encode(body)) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((((CAST('0x' || substr(sha || '00', CAST(floor(i * 5 / 4) AS INT) + 1, 2) AS INT)) >> (3 - (i * 5) % 4)) & 31) AS INT), 1)),
    'string_agg', '') AS payload_digest FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN b USING (sha)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": license_scan.report_sql(), "op6_warc": _OP6_SQL, "op7_quality_rules": quality.report_sql(), "op12_hard_negatives": hard_negatives.report_sql()}
