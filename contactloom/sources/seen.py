"""Keys seen so far, laid out so that a batch does not read them all.

The store is a Parquet table bucketed by the hash of the key and partitioned by batch. Spark
knows the layout, so a batch joins the store without moving it: only the batch is dealt to the
buckets. A small batch names its hashes, and Spark opens only the buckets that may hold them.
A batch that runs again replaces its own partition, and sees none of it.

The table's files are in a folder of its own; the catalog entry is made anew when a session opens
the store, so a restart needs the folder only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Distinct hashes up to which a batch names them; beyond it every bucket is touched anyway.
NAMED_HASHES = 500


class SeenStore:
    """Keys of earlier batches under ``folder``.

    ``buckets`` holds for a new store; an existing one keeps its own. Null keys are keys like any
    other. Keys are told apart by their values; the hash only finds them.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: dict[str, str],
                 buckets: int = 64) -> None:
        self.spark, self.keys = spark, list(keys)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(conf)
        old = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
        named = [int(n.removeprefix("buckets=")) for n in old if n.startswith("buckets=")]
        self.buckets = named[0] if named else buckets
        self.path = f"{folder}/buckets={self.buckets}"
        system.mkdirs(jvm.org.apache.hadoop.fs.Path(self.path))
        self.table = f"seen_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{k}` {kind}" for k, kind in keys.items())
        spark.sql(f"CREATE TABLE {self.table} ({columns}, key_hash LONG, batch_id LONG) "
                  f"USING parquet PARTITIONED BY (batch_id) CLUSTERED BY (key_hash) "
                  f"SORTED BY (key_hash) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        spark.catalog.recoverPartitions(self.table)

    def _hash(self) -> Column:
        return F.xxhash64(*self.keys)

    def _key(self, side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{k}") for k in self.keys])

    def history(self, before: int | None = None) -> DataFrame:
        """Stored rows of the batches before ``before`` (of all without it)."""
        rows = self.spark.table(self.table)
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def unseen(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """Rows whose key no batch before ``before`` has stored.

        The join is on the hash alone, by which the store is dealt out; of the few rows with one
        hash the keys are compared.
        """
        history = self.history(before)
        named = rows.select(self._hash().alias("h")).distinct().limit(NAMED_HASHES + 1).collect()
        if len(named) <= NAMED_HASHES:
            history = history.where(F.col("key_hash").isin([r.h for r in named]))
        batch = rows.withColumn("_hash", self._hash()).alias("batch")
        same = F.array_contains(F.array(self._key("seen")), self._key("batch"))
        return batch.join(history.alias("seen"),
                          (F.col("batch._hash") == F.col("seen.key_hash")) & same,
                          "left_anti").drop("_hash")

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Store the distinct keys of a batch, instead of what it stored before if it runs
        again. One file per bucket and batch."""
        dealt = (rows.select(*self.keys).distinct().withColumn("key_hash", self._hash())
                 .repartition(self.buckets, "key_hash").sortWithinPartitions("key_hash"))
        view = f"{self.table}_batch"
        dealt.createOrReplaceTempView(view)
        try:
            # The batch's own session holds the view.
            rows.sparkSession.sql(
                f"INSERT OVERWRITE TABLE {self.table} PARTITION (batch_id = {int(batch_id)}) "
                f"SELECT * FROM {view}")
        finally:
            rows.sparkSession.catalog.dropTempView(view)

    def close(self) -> None:
        """Drop the catalog entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
