"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What a run on one machine needs; on a cluster these come from the submit command.
LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "*", app: str = "contactloom", **settings: str) -> SparkSession:
    """Session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    for key, value in {**LOCAL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package when it runs from a source
    folder; on a cluster it is installed or sent along."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it.

    A machine-local folder is taken only when the session itself is local.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="contactloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh sub-folder of the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy text work to all cores when the input has fewer splits than cores.

    Only small inputs (a file of one row group) are redistributed; a table with enough
    splits is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder, as Parquet, and read it from there.

    Used where two readers must see the very same rows, also after an executor is lost. Readers
    take only the columns they need.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
