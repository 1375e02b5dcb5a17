"""Queries over pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contactloom.llm.archive import read_index, write_archive
from contactloom.llm.catalog import query, table
from contactloom.llm.extract import main_texts
from contactloom.llm.urls import filter_urls
from contactloom.session import scratch_path

OP9_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT payload, min(page_id) AS head FROM p GROUP BY payload)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT)
         & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = head THEN NULL ELSE head END AS refers_to
FROM p JOIN f USING (payload)
"""


@query("op9_warc", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path, min_bytes=0)
    return read_index(spark, path)


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]


@query("op8_url_filters")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
