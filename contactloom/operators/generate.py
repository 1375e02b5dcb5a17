"""Labelled synthetic rows for fixtures. Never contacts: reserved domain, no status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom import rules


def pick(values: Sequence[str], index: Column) -> Column:
    """Entry of a short vocabulary by index modulo its length."""
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def label_rows(df: DataFrame, index: str, vocabulary: Mapping[str, Sequence[str]]) -> DataFrame:
    """Deterministic fields for numbered rows, by modular walks through vocabularies.

    ``vocabulary``: first, last, prefix, suffix, title, country.
    """
    i = F.col(index)
    prefix = pick(vocabulary["prefix"], i)
    suffix = pick(vocabulary["suffix"], F.floor(i / len(vocabulary["prefix"])))
    first = pick(vocabulary["first"], i)
    host = F.concat(F.lower(prefix), F.lower(suffix), F.lit(".example"))
    return df.select(
        "*", first.alias("first_name"), pick(vocabulary["last"], i * 7 + 3).alias("last_name"),
        F.concat_ws(" ", prefix, suffix).alias("company"), host.alias("domain"),
        F.concat(F.lower(first), F.lit("@"), host).alias("email"),
        pick(vocabulary["title"], i).alias("title"),
        pick(vocabulary["country"], i).alias("country"),
        pick(rules.EMPLOYEE_BANDS, i).alias("employee_band"),
        F.lit("unknown").alias("mx_status"), F.lit(True).alias("synthetic"))


def generate(spark: SparkSession, n: int, vocabulary: Mapping[str, Sequence[str]],
             categories: Sequence[str] = rules.CATEGORIES) -> DataFrame:
    """``n`` synthetic rows per category."""
    rows = spark.range(n * len(categories)).select(
        pick(categories, F.floor(F.col("id") / n)).alias("niche"),
        F.pmod("id", F.lit(n)).alias("i"))
    return label_rows(rows, "i", vocabulary)


def top_up(head: DataFrame, fill: DataFrame, n: int, category: str,
           order: Sequence[str], key: str = "email") -> DataFrame:
    """Curated rows first, then fill rows with a new key, up to n per category."""
    from contactloom.operators.rank import first_wins, top_n, union_sources

    stacked = union_sources(head, fill)
    unique = first_wins(stacked, [key], ["source_prio", *order])
    return top_n(unique, [category], n, ["source_prio", *order], name="niche_rank")
