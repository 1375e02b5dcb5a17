"""Queries over documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from contactloom.llm.catalog import query, table
from contactloom.llm.decontaminate import UNSPACED, passages
from contactloom.llm.licenses import oracle_sql, scan_licenses
from contactloom.llm.near import near_duplicates
from contactloom.llm.packing import pack
from contactloom.llm.passages import remove_repeats
from contactloom.llm.quality import quality
from contactloom.llm.tokens import token_counts


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("piece_bpe_32k.model"))


@query("op2_license_scan", oracle_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


# Tokens as the operator cuts them: characters of scripts without blanks stand alone.
def _tokens(text: str) -> str:
    return (rf"regexp_extract_all(regexp_replace(lower({text}), '([{UNSPACED}])', ' \1 ', 'g'), "
            r"'[\p{L}\p{N}]+')")


OP3_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text, {_tokens("coalesce(text, '')")} AS w
  FROM (SELECT DISTINCT doc_id, text FROM documents)),
b AS (
  SELECT DISTINCT item_id, {_tokens("coalesce(text, '')")} AS w FROM benchmark),
i AS (
  SELECT item_id, w, len(w) AS n, least(len(w), 13) AS width,
    CASE WHEN len(w) < 8 THEN len(w) ELSE least(len(w), 13) - least(len(w), 13) * 2 // 13 END
      AS needed,
    len(w) >= 8 OR list_sum(list_transform(w, lambda x: CASE
      WHEN regexp_matches(x, '[{UNSPACED}]') THEN 4 ELSE length(x) END)) >= 24 AS inside
  FROM b WHERE len(w) > 0),
dt AS (SELECT r, doc_id, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS k, len(w) AS size
       FROM d),
it AS (SELECT item_id, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS k, n, width, needed
       FROM i WHERE inside),
same AS (
  SELECT r, doc_id, size, item_id, n, width, needed, dt.k - it.k AS shift, it.k AS k
  FROM dt JOIN it USING (t)),
likely AS (
  SELECT r, item_id, shift FROM same GROUP BY ALL HAVING count(*) >= min(needed)),
starts AS (
  SELECT r, doc_id, item_id, shift, needed, unnest(range(greatest(0, k - width + 1, -shift),
    least(k, n - width, size - width - shift) + 1)) AS start
  FROM same JOIN likely USING (r, item_id, shift)),
lines AS (
  SELECT r, doc_id, w, sum(len(w)) OVER (PARTITION BY r ORDER BY k) - len(w) AS place
  FROM (SELECT r, doc_id, k, {_tokens("line")} AS w FROM (
    SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS k
    FROM (SELECT r, doc_id, regexp_split_to_array(text, '[\r\n]+') AS l FROM d)))),
hits AS (
  SELECT r, doc_id, item_id, start + shift AS place, count(*) AS equal FROM starts
  GROUP BY r, doc_id, item_id, shift, start HAVING count(*) >= min(needed)
  UNION ALL
  SELECT r, doc_id, item_id, place, len(w) FROM lines JOIN i USING (w) WHERE NOT inside)
SELECT doc_id, item_id, count(*) AS n_windows, max(equal) AS best, min(place) AS first_at
FROM hits GROUP BY r, doc_id, item_id
"""


@query("op3_decontamination", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"),
                    table(spark, sf_dir, "benchmark")).drop("text_key")


@query("op6_minhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80).drop(
        "text_key")


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"),
                public_tokenizers.path("word_bpe_49k.json"), end_id=2, size=4096)


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, width=35).select("doc_id", "n_words", "n_removed",
                                                 "kept_sha256")
