"""Pattern hits with the patterns as a table: texts meet patterns on required literals.

A pattern names lower-case literals, one of which every match holds. The literals are looked up
in the texts as plain substrings (``substrings``: an inverted q-gram index, whatever the size of
either side), each literal leads to the patterns that need it, and only the pairs of text and
pattern that are left run the pattern, which is a value like any other. ``extract.
mention_candidates`` is the same for a short list, inside the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom import patterns
from contactloom.operators.extract import pattern_hits, pattern_rows
from contactloom.operators.substrings import substring_hits

TABLE_SCHEMA = "pat int, pattern string, needs array<string>"


def pattern_table(spark: SparkSession, table: Sequence = patterns.SITE_PATTERNS,
                  flags: str = "(?i)") -> DataFrame:
    """A pattern list as a table (pat, pattern, needs)."""
    return spark.createDataFrame(pattern_rows(table, flags), TABLE_SCHEMA)


def possible_patterns(df: DataFrame, key: str, text: str, table: DataFrame) -> DataFrame:
    """Distinct ``key, pat`` for texts that hold a literal the pattern needs."""
    needs = table.select("pat", F.explode("needs").alias("_literal")).distinct()
    found = substring_hits(df, key, F.lower(F.col(text)), needs, "_literal")
    return (found.withColumnRenamed("term", "_literal").join(needs, "_literal")
            .select(key, "pat").distinct())


def mentions_by_table(df: DataFrame, key: str, text: str, table: DataFrame) -> DataFrame:
    """``key, pat, hit, whole, cand`` for every match of a pattern of ``table(pat, pattern,
    needs)`` in the texts of ``df``; ``hit`` counts a pattern's matches in a text from 0.

    ``key`` identifies a row and is not null, ``pat`` identifies a pattern; a pattern has one
    group at least, which is the candidate. Null and empty texts match nothing, and so do
    patterns without literals. Extra columns are ignored.
    """
    pairs = possible_patterns(df, key, text, table).join(table.select("pat", "pattern"), "pat")
    row = F.struct("pat", "pattern")
    return (pairs.join(df.select(key, F.col(text).alias("_text")), key)
            .select(key, F.posexplode(pattern_hits(F.col("_text"), row)).alias("hit", "_found"))
            .select(key, "_found.pat", "hit", "_found.whole", "_found.cand"))
