"""Queries over the whole corpus: fingerprints, variants of words, divergence of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contactloom.llm.catalog import query, table
from contactloom.llm.divergence import divergence
from contactloom.llm.simhash import simhash_duplicates
from contactloom.llm.variants import spelling_variants


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_simhash_near_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents"), width=4)


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (
  SELECT lang, term, count(*)::BIGINT AS n FROM t GROUP BY lang, term
  HAVING count(DISTINCT k) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(l.total, 0) AS lang_total,
    coalesce(s.total, 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs l USING (lang)
  LEFT JOIN (SELECT lang, source, count(*) AS total FROM t JOIN kept USING (lang, term)
             GROUP BY lang, source) s USING (lang, source)),
counts AS (SELECT lang, source, term, count(*) AS c FROM t GROUP BY lang, source, term),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
    (1 + 1000000000::HUGEINT * (coalesce(c, 0) + 2) // (g.total + 2 * g.v))::BIGINT AS p,
    (1 + 1000000000::HUGEINT * (k.n + 2) // (g.lang_total + 2 * g.v))::BIGINT AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (
  SELECT g.lang, g.source, h.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item,
      sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM cells WHERE c > 0 AND p > q),
ranked AS (
  SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source
    ORDER BY value DESC, encode(item)) AS rank FROM pairs
  UNION ALL
  SELECT 'term', *, row_number() OVER (PARTITION BY lang, source
    ORDER BY value DESC, encode(item)) FROM terms)
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked
WHERE part = 'pair' OR rank <= 10
"""


@query("op13_source_divergence", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))
