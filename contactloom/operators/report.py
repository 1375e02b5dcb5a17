"""Counts and rates for the people who run the pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def qualified_totals(audit: DataFrame) -> DataFrame:
    """Visited, qualified, rejected, and rejected for a missing MX."""
    yes = F.col("qualified") == "YES"
    return audit.agg(
        F.count(F.lit(1)).alias("visited"), F.count_if(yes).alias("qualified"),
        F.count_if(~yes).alias("rejected"),
        F.count_if(F.startswith("rejection_reason", F.lit("no_mx"))).alias("no_mx"))


def rejection_report(audit: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent rejection reasons; the reason's name decides between equals."""
    counts = count_by(audit.where("qualified = 'NO'"), "rejection_reason")
    return counts.orderBy(F.desc("n"), "rejection_reason").limit(n)


def no_mx_rows(audit: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Sites that had an address but no MX: worth another look."""
    return (audit.where(F.startswith("rejection_reason", F.lit("no_mx")))
            .orderBy(*order).limit(n))


def confidence_mix(df: DataFrame) -> DataFrame:
    """Rows per confidence label side by side, and the share of rows with a name."""
    named = F.coalesce(F.col("full_name"), F.lit("")) != ""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col("confidence") == c).alias(c.lower())
          for c in rules.CONFIDENCE_RANK],
        F.count_if(named).alias("named"),
        F.round(100.0 * F.count_if(named) / F.nullif(F.count(F.lit(1)), F.lit(0)), 2)
        .alias("named_pct"))


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows have a value (or TRUE) in each column."""
    def filled(c: str) -> Column:
        value = F.col(c)
        if dict(df.dtypes)[c] == "boolean":
            return value
        return F.coalesce(value.cast("string"), F.lit("")) != ""

    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(filled(c)).alias(c) for c in columns])


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column; exact ones are counted column by column, so no row is
    multiplied."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c).alias(f"n_{c}") for c in columns])
    singles = [df.select(c).where(F.col(c).isNotNull()).distinct()
               .agg(F.count(F.lit(1)).alias(f"n_{c}")) for c in columns]
    first, *rest = singles
    return first.select("*", *[s.scalar().alias(f"n_{c}")
                               for s, c in zip(rest, columns[1:])])


def progress(workers: DataFrame, total: Column, elapsed: Column) -> DataFrame:
    """Scanned, found, speed, percent and minutes left over all workers."""
    scanned = F.sum("scanned")
    speed = F.when(elapsed > 0, scanned / elapsed).otherwise(0.0)
    return workers.agg(
        scanned.alias("scanned"), F.sum("found").alias("found"),
        F.round(speed, 4).alias("speed"),
        F.round(F.when(total > 0, 100.0 * scanned / total).otherwise(0.0), 4).alias("pct"),
        F.round(F.when(speed > 0, F.greatest(F.lit(0), total - scanned) / speed / 60)
                .otherwise(0.0), 4).alias("eta_min"))


def quality_report(results: DataFrame, gate: float = rules.PASS_GATE) -> DataFrame:
    """Accuracy over known answers, errors, issues, mean seconds, and the verdict.

    Input: expected (array of accepted parts, NULL: any answer passes), answer, error,
    issues (count), seconds, known (part of the accuracy set).
    """
    low = F.lower(F.coalesce(F.col("answer"), F.lit("")))
    passed = F.col("error").isNull() & (
        F.col("expected").isNull()
        | F.exists("expected", lambda e: F.contains(low, F.lower(e))))
    known = F.col("known")
    accuracy = 100.0 * F.count_if(known & passed) / F.nullif(F.count_if(known), F.lit(0))
    errors = F.count_if(F.col("error").isNotNull())
    return results.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(known & passed).alias("known_pass"),
        F.round(accuracy, 4).alias("accuracy"), errors.alias("errors"),
        F.count_if(F.col("issues") > 0).alias("with_issues"),
        F.round(F.avg("seconds"), 4).alias("mean_seconds"),
        F.when(errors > 0, "fix errors").when(accuracy >= gate, "ready").otherwise("review")
        .alias("verdict"))


def field_issues(df: DataFrame, required: Sequence[str], name: str,
                 stop: Sequence[str]) -> DataFrame:
    """Number of missing required fields plus one if the name holds a stop word."""
    missing = sum((F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", 1).otherwise(0)
                   for c in required), F.lit(0))
    bad = F.exists(F.split(F.lower(F.coalesce(F.col(name), F.lit(""))), r"\s+"),
                   lambda w: w.isin(*stop)) if stop else F.lit(False)
    return df.withColumn("issues", missing + F.when(bad, 1).otherwise(0))
