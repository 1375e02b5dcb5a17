"""Joins with lookup tables and with stored keys.

Both are ordinary equi-joins: each side is read and shuffled once, Spark broadcasts a lookup
whose size it knows to be small, and adaptive execution splits the left partitions of a key
that holds many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 1 << 16


def lookup(df: DataFrame, right: DataFrame, on: str, skip: Column | None = None) -> DataFrame:
    """Left join to a table with one row per key.

    Rows under ``skip`` need no lookup: they get NULLs and travel under made-up keys, evenly
    spread.
    """
    if skip is None:
        return df.join(right, on, "left")
    others = F.xxhash64(*([c for c in df.columns if c != on] or [on]))
    made_up = F.concat(F.lit("\u0000"), F.pmod(others, F.lit(SPREAD)).cast("string"))
    left = df.withColumn("_key", F.when(skip, made_up).otherwise(F.col(on).cast("string")))
    return left.join(right.withColumnRenamed(on, "_key"), "_key", "left").drop("_key")


def without(df: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``right``."""
    return df.join(right.select(*keys), list(keys), "left_anti")
