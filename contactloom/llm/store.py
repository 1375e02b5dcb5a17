"""Tables that cut lineage: written to the shared folder, read back as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame

from contactloom.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, compressed by ``codec``, and read it back.

    The rows survive a lost executor, and later steps see the same rows. Nothing needs the shuffle
    files of the write once its table is there, so Spark removes them when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
