"""Views that give the driver's tables the shape of stories, results, attempts and traces. The SQL
is plain enough for Spark and for the oracle; operators are applied to the views by the queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()

STORY = "SELECT CAST(page_id AS STRING) AS id, page_id, url, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM pages"

RESULT = """
SELECT CAST(d.doc_id AS STRING) AS id, d.doc_id,
  CASE WHEN l.quality IS NULL AND d.doc_id % 4 = 0 THEN NULL WHEN l.quality IS NULL AND d.doc_id % 4 = 2 THEN '   ' ELSE d.text END AS text,
  d.source AS media_name, d.n_chars AS text_length,
  CASE d.lang WHEN 'en' THEN 'Sweden' WHEN 'de' THEN 'Germany' END AS country,
  CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'strict_verified' WHEN l.quality = 1 THEN 'page_verified'
       WHEN l.quality = 0 THEN 'unverified_text' WHEN d.doc_id % 2 = 0 THEN 'no_text' END AS verification_level,
  l.quality = 1 AS target_verified,
  CASE WHEN l.quality IS NOT NULL AND d.doc_id % 7 = 0 THEN 'ok_low_confidence' WHEN l.quality IS NOT NULL AND d.doc_id % 11 = 0 THEN 'false_positive'
       WHEN l.quality IS NOT NULL THEN 'ok' WHEN d.doc_id % 5 = 0 THEN 'extract_error' WHEN d.doc_id % 5 = 1 THEN 'exception'
       WHEN d.doc_id % 5 = 2 THEN 'ok' ELSE 'fetch_error' END AS scrape_status,
  CASE d.doc_id % 3 WHEN 0 THEN 'requests' WHEN 1 THEN 'playwright' ELSE 'wayback' END AS fetch_method,
  CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE l.quality IS NULL AND d.doc_id % 4 = 0 END AS needs_archive
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

CHECKPOINT = f"""
SELECT id, doc_id, CASE WHEN doc_id % 2 = 0 THEN NULL ELSE concat('later ', coalesce(text, '')) END AS text,
  CASE WHEN doc_id % 2 = 0 THEN 'no_text' WHEN doc_id % 5 = 0 THEN 'page_verified' ELSE 'unverified_text' END AS verification_level,
  doc_id % 5 = 0 AS target_verified, 'ok' AS scrape_status, 'wayback' AS fetch_method, doc_id % 4 = 0 AS needs_archive,
  'checkpoint' AS origin, 1 AS src_rank, CASE WHEN doc_id % 2 = 0 THEN 200 ELSE 50 END AS src_mtime, false AS is_canonical
FROM ({RESULT}) r WHERE doc_id % 3 = 0
"""

CANONICAL = f"""
SELECT id, doc_id, text, verification_level, target_verified, scrape_status, fetch_method, needs_archive,
  'canonical' AS origin, 0 AS src_rank, 100 AS src_mtime, true AS is_canonical
FROM ({RESULT}) r
"""

ATTEMPT = """
SELECT event_id, ts, user_id, CAST(user_id AS STRING) AS id,
  CASE event_type WHEN 'click' THEN 'direct' WHEN 'view' THEN 'availability' WHEN 'purchase' THEN 'cdx' WHEN 'signup' THEN 'snapshot'
    ELSE CASE event_id % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'availability' ELSE 'cdx' END END AS endpoint,
  CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 5 = 1 THEN 503 WHEN event_id % 5 = 2 THEN 500 WHEN event_id % 5 = 3 THEN 404 WHEN event_id % 5 = 4 THEN 429 END AS status,
  CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 'ReadTimeout' WHEN event_type = 'error' AND event_id % 5 = 3 THEN 'http_404' END AS error,
  CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 1 ELSE 0 END AS retry_count,
  CAST(event_id % 17 AS DOUBLE) AS seconds, event_type = 'purchase' AS terminal, event_type <> 'error' AS success
FROM events
"""

TRACE = """
SELECT CAST(conv_id AS STRING) AS id, turn AS ordinal,
  CASE turn % 4 WHEN 0 THEN 'direct' WHEN 1 THEN 'availability' WHEN 2 THEN 'snapshot' ELSE 'cdx' END AS phase,
  CASE WHEN conv_id % 5 = 4 AND turn % 4 = 3 THEN 503 WHEN conv_id % 5 = 3 AND turn % 4 = 2 THEN 502 WHEN conv_id % 5 = 2 AND turn % 4 = 1 THEN 429
    WHEN conv_id % 5 = 1 AND turn % 4 = 0 AND conv_id % 2 = 0 THEN 500 ELSE 404 END AS status
FROM conversations
"""


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run SQL over the tables of a folder; only the tables and columns it names are read."""
    used = [t for t in TABLES if re.search(rf"\b{t}\b", sql)]
    text = sql
    for t in used:
        text = re.sub(rf"(?i)(\b(?:FROM|JOIN)\s+){t}\b", rf"\1{{{t}}}", text)
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
