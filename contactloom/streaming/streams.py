"""Streams: tailing, dedupe, enrichment, quotas, retries, progress, batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from contactloom.operators import rank
from contactloom.operators.join import without, lookup
from contactloom.sources.seen import SeenStore


def tail(spark: SparkSession, path: str, schema: str, fmt: str = "csv",
         files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Growing folder of files as a stream; each file is read once.

    The checkpoint of the query that reads it is what makes a restart go on where the
    last run ended.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def stream_dedupe(stream: DataFrame, history: DataFrame | None, keys: Sequence[str],
                  event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """First row per key that the stored history does not hold.

    Without ``event_time`` every key ever seen stays in state. With it, state is bounded:
    repeats are dropped within ``delay``.
    """
    if history is not None:
        stream = without(stream, history, keys)
    if event_time:
        return (stream.withWatermark(event_time, delay or "1 hour")
                .dropDuplicatesWithinWatermark(list(keys)))
    return stream.dropDuplicates(list(keys))


def stream_enrich(stream: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """New rows with the values a static table (one row per key) has for them."""
    return lookup(stream, table, key)


def running_counts(stream: DataFrame, category: str) -> DataFrame:
    """Rows per category so far (write in update or complete mode)."""
    return stream.groupBy(category).agg(F.count(F.lit(1)).alias("n"))


def _stored(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What earlier batches wrote. The batch in hand is left out: a repeated batch
    replaces its own rows, so results do not depend on how often it ran."""
    try:
        return spark.read.parquet(path).where(F.col("batch_id") < batch_id)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def _put(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(_folder(path, batch_id))


def each_batch(stream: DataFrame, path: str, checkpoint: str,
               change: Callable[[DataFrame, int], DataFrame]) -> StreamingQuery:
    """Run ``change`` on every micro-batch and store its rows under the batch number."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        _put(change(batch, batch_id), path, batch_id)

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def tail_committed(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """What another stream's ``append_batches`` has committed to ``path``, as a stream.

    The folder's file log says which files a batch committed; files of a failed or running
    batch are not read. The folder may still be empty.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return spark.readStream.schema(schema).parquet(path)


def stage(stream: DataFrame, change: Callable[[DataFrame], DataFrame], folder: str
          ) -> StreamingQuery:
    """One stage of a chain: ``change`` applied to a stream, its rows under ``folder``.

    Each stage has its own checkpoint, so stages stop, fail and restart on their own; the next
    one reads ``stage_output``.
    """
    return append_batches(change(stream), f"{folder}/rows", f"{folder}/check")


def stage_output(spark: SparkSession, folder: str, schema: str | StructType) -> DataFrame:
    """Committed rows of a stage, as the input stream of the next."""
    return tail_committed(spark, f"{folder}/rows", schema)


def append_batches(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to a file table as its batches come."""
    return (stream.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _counted(spark: SparkSession, path: str, batch_id: int, keys: Sequence[str]) -> DataFrame:
    """Rows per key that all earlier batches stored: what the last of them has noted."""
    counts = _stored(spark, f"{path}_counts", batch_id)
    if counts is None:
        counts = spark.createDataFrame([], ", ".join([*(f"{k} STRING" for k in keys),
                                                      "n LONG"]))
    else:
        last = counts.agg(F.max("batch_id")).first()[0]
        counts = counts.where(F.col("batch_id") == last)
    return counts.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_used"))


def _put_counted(df: DataFrame, path: str, batch_id: int, keys: Sequence[str]) -> None:
    """Store the rows, and the counts up to this batch, so that later batches read neither
    the rows nor the counts of the batches before."""
    _put(df, path, batch_id)
    spark = df.sparkSession
    new = spark.read.parquet(_folder(path, batch_id)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"))
    before = _counted(spark, path, batch_id, keys).withColumnRenamed("_used", "n")
    _put(before.unionByName(new).groupBy(*keys).agg(F.sum("n").alias("n")).coalesce(1),
         f"{path}_counts", batch_id)


def stream_quota(stream: DataFrame, category: str, n: int, order: Sequence[str], path: str,
                 checkpoint: str) -> StreamingQuery:
    """At most n rows per category over the whole run, first come first kept.

    What is left of a quota comes from the counts of earlier batches (one row per batch and
    category); inside a batch the first rows in order fill it through a two-step top-n, so
    one busy category does not pass through one task.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        picked = rank.top_n(batch, [category], n, order, name="_rank")
        used = _counted(batch.sparkSession, path, batch_id, [category])
        picked = lookup(picked, used, category)
        picked = picked.where(F.col("_rank") <= n - F.coalesce("_used", F.lit(0)))
        _put_counted(picked.drop("_rank", "_used"), path, batch_id, [category])

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_batches(stream: DataFrame, n: int, order: Sequence[str], path: str,
                   checkpoint: str) -> StreamingQuery:
    """Accepted rows numbered through the whole run, in export batches of n rows."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        before = _counted(batch.sparkSession, path, batch_id, []).first()["_used"]
        ranked = rank.running_rank(batch, order, name="row_no")
        row_no = F.col("row_no") + before
        _put_counted(ranked.withColumns({
            "row_no": row_no, "batch": (F.floor((row_no - 1) / n) + 1).cast("long")}),
            path, batch_id, [])

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_first_wins(stream: DataFrame, keys: Sequence[str], order: Sequence[str], path: str,
                      checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """First row per key over the whole run; keys of earlier batches lie in a store.

    A batch is folded to one row per key before its shuffle, so a key that holds a third of the
    stream stays cheap; then keys stored by earlier batches are left out (``SeenStore``: the
    store is not shuffled, and a small batch opens few of its buckets). Rows are written before
    their keys are stored, and both under the batch number: a batch that runs again sees the
    earlier batches only and replaces its own rows and keys.
    """
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema if f.name in keys}
    store = SeenStore(stream.sparkSession, f"{path}_seen", {k: kinds[k] for k in keys}, buckets)

    def handle(batch: DataFrame, batch_id: int) -> None:
        _put(store.unseen(rank.first_wins(batch, keys, order), batch_id), path, batch_id)
        store.add(batch.sparkSession.read.parquet(_folder(path, batch_id)), batch_id)

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_retry(stream: DataFrame, throttled: Column, attempts: int, path: str,
                 retry_path: str, checkpoint: str) -> StreamingQuery:
    """Final rows to ``path``, throttled ones with attempts left to ``retry_path``.

    The retry table is an input folder of the next run; no row is lost on the way.
    """
    again = F.coalesce(throttled & (F.col("attempt") < attempts), F.lit(False))

    def handle(batch: DataFrame, batch_id: int) -> None:
        _put(batch.where(again).withColumn("attempt", F.col("attempt") + 1), retry_path,
             batch_id)
        _put(batch.where(~again), path, batch_id)

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def observe_progress(df: DataFrame, name: str, found: Column) -> DataFrame:
    """Count scanned and found rows on the way through, without another pass."""
    return df.observe(name, F.count(F.lit(1)).alias("scanned"),
                      F.count_if(found).alias("found"))


class ProgressLog(StreamingQueryListener):
    """Keeps the observed counts and can end the run when all targets are met.

    ``done`` gets the latest values of one observation and says whether to stop. With ``total``,
    the number of rows there are to scan, each row says how far the run is and, at the rate so
    far, how many seconds are left.
    """

    def __init__(self, name: str, done: Callable[[dict], bool] | None = None,
                 total: int | None = None) -> None:
        self.name = name
        self.done = done
        self.total = total
        self.scanned = 0
        self.seconds = 0.0
        self.rows: list[dict] = []
        self.finished = False

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        values = row.asDict()
        self.scanned += values.get("scanned", 0)
        self.seconds += event.progress.batchDuration / 1000
        left = None if self.total is None else max(0, self.total - self.scanned)
        rate = self.scanned / self.seconds if self.seconds else 0.0
        self.rows.append({**values, "batch_id": event.progress.batchId,
                          "rows_per_second": event.progress.processedRowsPerSecond,
                          "scanned_so_far": self.scanned, "left": left,
                          "seconds_left": left / rate if left is not None and rate else None})
        if self.done and self.done(values):
            self.finished = True

    def table(self, spark: SparkSession) -> DataFrame:
        """A row for each batch seen so far: counts, rate, rows and seconds left."""
        return spark.createDataFrame(
            [(r["batch_id"], r.get("scanned"), r.get("found"), r["scanned_so_far"], r["left"],
              r["rows_per_second"], r["seconds_left"]) for r in self.rows],
            "batch_id LONG, scanned LONG, found LONG, scanned_so_far LONG, left LONG, "
            "rows_per_second DOUBLE, seconds_left DOUBLE")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stop_when_full(query: StreamingQuery, counts: Callable[[], dict[str, int]],
                   categories: Sequence[str], target: int, wait: float = 5.0) -> bool:
    """Wait for a running query and stop it once every category has reached the target."""
    while query.isActive:
        found = counts()
        if all(found.get(c, 0) >= target for c in categories):
            query.stop()
            return True
        query.awaitTermination(int(wait))
    return False
