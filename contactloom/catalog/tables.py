"""Keyword tables as substrings, stored sketches, feeds read as XML."""

from __future__ import annotations

from pyspark.sql import functions as F

from contactloom import rules
from contactloom.catalog.base import query, read
from contactloom.operators import feeds, sketches, substrings
from contactloom.session import scratch_path

# Keywords out of the data: words of benchmark items, ranked by length, named by first letter.
_TERMS = r"""
SELECT term, 100 - length(term) AS prio, 'niche ' || left(term, 1) AS niche FROM (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM benchmark)
WHERE length(term) >= 2"""


def _terms(spark, sf):
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    return (read(spark, sf, "benchmark").select(words.alias("term")).distinct()
            .where("length(term) >= 2").select(
                "term", (F.lit(100) - F.length("term")).alias("prio"),
                F.concat(F.lit("niche "), F.left("term", F.lit(1))).alias("niche")))


@query("substring_terms_in_documents", f"""
SELECT term, count(*) AS n FROM ({_TERMS}) JOIN documents ON contains(lower(text), term)
GROUP BY term""")
def _(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", F.lower("text").alias("text"))
    return substrings.substring_hits(docs, "doc_id", "text", _terms(spark, sf)).groupBy(
        "term").agg(F.count(F.lit(1)).alias("n"))


@query("classify_by_substring_table", f"""
SELECT doc_id, coalesce(niche, '{rules.GENERAL}') AS niche FROM documents LEFT JOIN (
  SELECT doc_id, arg_min(niche, (prio, niche)) AS niche FROM ({_TERMS})
  JOIN documents ON contains(lower(text), term) GROUP BY doc_id) USING (doc_id)""")
def _(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", F.lower("text").alias("text"))
    return substrings.classify_by_substrings(rows, "doc_id", "text", _terms(spark, sf)).select(
        "doc_id", "niche")


@query("distinct_counts_from_sketches", """
SELECT l_returnflag, count(*) AS n, TRUE AS orders_close, TRUE AS parts_close
FROM lineitem GROUP BY l_returnflag""")
def _(spark, sf):
    rows = read(spark, sf, "lineitem")
    path, names = scratch_path(spark, "sketches"), ["orders", "parts"]
    for batch in (1, 2):  # two runs; only their sketches are read afterwards
        part = rows.where((F.col("l_linenumber") % 2) + 1 == batch)
        sketches.store(sketches.sketches(
            part, ["l_returnflag", "l_linenumber"],
            {"orders": "l_orderkey", "parts": "l_partkey"}), path, str(batch))
    total = sketches.estimates(
        sketches.merged(sketches.stored(spark, path), ["l_returnflag"], names), names)
    exact = rows.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("n_orders"),
        F.count_distinct("l_partkey").alias("n_parts"))
    close = [(F.abs(F.col(x) - F.col(f"n_{x}")) <= 0.02 * F.col(f"n_{x}") + 1).alias(f"{x}_close")
             for x in names]
    return total.join(exact, "l_returnflag").select("l_returnflag", "n", *close)


_GIVEN, _FAMILY = ["Anna", "Boris", "Clara"], ["Roe", "Born", "Low", "Vega"]


@query("feed_entry_authors", f"""
WITH c AS (SELECT c_custkey AS k, {_GIVEN}[1 + c_custkey % 3] AS g,
  {_FAMILY}[1 + c_custkey % 4] AS f FROM customer)
SELECT k, 0 AS pos, NULL AS email, g AS first_name, f AS last_name,
  CASE WHEN k % 10 = 0 THEN 'text' ELSE 'xml' END AS source FROM c
UNION ALL SELECT k, 1, 'u' || k || '@shop.com', 'Dora', f, 'xml' FROM c WHERE k % 10 <> 0
UNION ALL SELECT k, 2, 'desk@shop.com', NULL, NULL, 'xml' FROM c WHERE k % 10 <> 0""")
def _(spark, sf):
    k = F.col("c_custkey")
    given = F.get(F.lit(_GIVEN), (k % 3).cast("int"))
    family = F.get(F.lit(_FAMILY), (k % 4).cast("int"))
    whole = F.concat(
        F.lit('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><managingEditor>'
              "desk@shop.com</managingEditor><item><dc:creator><![CDATA["), given, F.lit(" "),
        family, F.lit("]]></dc:creator></item><item><author>u"), k.cast("string"),
        F.lit("@shop.com (Dora "), family, F.lit(")</author></item><item><dc:creator>"), given,
        F.lit(" "), family, F.lit("</dc:creator></item></channel></rss>"))
    cut = F.concat(F.lit("<rss><item><author><name>"), given, F.lit(" "), family,
                   F.lit("</name></author> & no end"))
    rows = read(spark, sf, "customer").select(
        k.alias("k"), F.when(k % 10 == 0, cut).otherwise(whole).alias("feed"))
    return feeds.feed_authors(rows, "k", "feed")
