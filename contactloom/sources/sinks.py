"""Sinks: category files, slices, batches, export profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.operators.contacts import project_profile, protect_columns, with_category
from contactloom.operators.rank import batch_no, interleave, slices


def write_by_category(df: DataFrame, path: str, column: str = "niche",
                      default: str = rules.GENERAL, files: int | None = None,
                      pii: str = "clear") -> None:
    """One folder per category; unknown categories go to the default one.

    Rows are spread over ``files`` parts per category (as many as the shuffle has by
    default), so a category that holds a third of the table is not written by one task.
    """
    rows = protect_columns(with_category(df, column, default), pii)
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(files))
    (rows.withColumn("_salt", salt).repartition(column, "_salt").drop("_salt")
     .write.mode("overwrite").partitionBy(column).parquet(path))


def write_master(df: DataFrame, path: str, profile: str = "master", pii: str = "clear",
                 fmt: str = "csv") -> None:
    """Export file set of a named profile, with headers."""
    writer = project_profile(df, profile, pii).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("emptyValue", "").csv(path)
    else:
        writer.format(fmt).save(path)


def write_slices(df: DataFrame, path: str, n: int = rules.SLICE_COUNT,
                 category: str = "niche", categories: Sequence[str] = rules.CATEGORIES,
                 order: Sequence[str] = ("source_prio", "seq")) -> None:
    """Round-robin slices over the interleaved categories, five columns each."""
    placed = slices(interleave(df, category, categories, order), n, position="position")
    (placed.select(*rules.SLICE_COLUMNS, "position", "slice")
     .write.mode("overwrite").partitionBy("slice").parquet(path))


def write_batches(df: DataFrame, path: str, order: Sequence[str],
                  n: int = rules.BATCH_ROWS) -> None:
    """Numbered batches of n rows."""
    batch_no(df, n, order).write.mode("overwrite").partitionBy("batch").parquet(path)
