"""Streaming operators: the events table arrives as files, results are read back."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from contactloom.catalog.base import dns_answers, query, read, store_domain
from contactloom.operators import match
from contactloom.operators.join import without
from contactloom.session import scratch_path
from contactloom.sources import growing
from contactloom.sources.seen import SeenStore
from contactloom.streaming import stateful, streams

FILES = 4
EVENT = "event_id LONG, ts TIMESTAMP, user_id LONG, event_type STRING, value DOUBLE, props STRING"


def _arrive(spark, sf, label: str, fmt: str = "parquet") -> tuple[str, str]:
    """Events as a folder of files and the folder's path, and a folder for results."""
    path = scratch_path(spark, f"{label}-in")
    rows = read(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartition(FILES, "event_id").write.format(fmt).save(path)
    return path, scratch_path(spark, label)


def _events(spark, sf, label: str, fmt: str = "parquet"):
    path, out = _arrive(spark, sf, label, fmt)
    return streams.tail(spark, path, EVENT, fmt, files_per_trigger=1), out


def _finish(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


@query("stream_tail_files", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    stream, out = _events(spark, sf, "tail", "csv")
    _finish(streams.append_batches(stream.select("event_id", "user_id", "event_type"),
                                   f"{out}/rows", f"{out}/check"))
    return spark.read.parquet(f"{out}/rows")


@query("stream_resume_from_checkpoint", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    path, out = _arrive(spark, sf, "resume")
    for _run in range(2):  # the second run finds every file already read
        stream = streams.tail(spark, path, EVENT, "parquet", files_per_trigger=2)
        _finish(streams.append_batches(stream.select("event_id", "event_type"),
                                       f"{out}/rows", f"{out}/check"))
    return spark.read.parquet(f"{out}/rows")


@query("stream_dedupe_with_history", """
SELECT DISTINCT user_id, event_type FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""")
def _(spark, sf):
    stream, out = _events(spark, sf, "dedupe")
    history = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"))
    fresh = without(stream, history, ["user_id"])
    unique = streams.stream_dedupe(fresh, None, ["user_id", "event_type"])
    _finish(streams.append_batches(unique.select("user_id", "event_type"), f"{out}/rows",
                                   f"{out}/check"))
    return spark.read.parquet(f"{out}/rows")


@query("stream_dedupe_bounded_state", "SELECT DISTINCT event_id FROM events")
def _(spark, sf):
    stream, out = _events(spark, sf, "bounded")
    history = read(spark, sf, "labels").select((-F.col("doc_id") - 1).alias("event_id"))
    unique = streams.stream_dedupe(stream, history, ["event_id"], "ts", "30 days")
    _finish(streams.append_batches(unique.select("event_id"), f"{out}/rows", f"{out}/check"))
    return spark.read.parquet(f"{out}/rows")


@query("stream_first_wins_stored", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf):
    stream, out = _events(spark, sf, "first")
    _finish(streams.stream_first_wins(
        stream.select("user_id", "event_type", "event_id"), ["user_id", "event_type"],
        ["event_id"], f"{out}/rows", f"{out}/check"))
    return spark.read.parquet(f"{out}/rows").select("user_id", "event_type")


@query("stream_enrich_with_dns", """
SELECT event_id, e.user_id, coalesce(has_mx, false) AS has_mx, coalesce(dmarc, false) AS dmarc
FROM (SELECT *, 'shop' || user_id || (['.com', '.co.uk', '.de', '.in', '.com.au', '.ca', '.us',
  '.shop'])[1 + user_id % 8] AS site FROM events) e LEFT JOIN dns_flags d ON d.domain = e.site""",
       uses="dns_flags")
def _(spark, sf):
    stream, out = _events(spark, sf, "enrich")
    facts = match.collapse_dns(dns_answers(spark, sf)).select("domain", "has_mx", "dmarc")
    keyed = stream.withColumn("domain", store_domain(F.col("user_id")))
    rows = streams.stream_enrich(keyed, facts, "domain").select(
        "event_id", "user_id", F.coalesce("has_mx", F.lit(False)).alias("has_mx"),
        F.coalesce("dmarc", F.lit(False)).alias("dmarc"))
    _finish(streams.append_batches(rows, f"{out}/rows", f"{out}/check"))
    return spark.read.parquet(f"{out}/rows")


@query("stream_running_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    stream, out = _events(spark, sf, "counts")

    def keep(batch, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows")

    counts = streams.running_counts(stream, "event_type")
    _finish(counts.writeStream.outputMode("complete").foreachBatch(keep)
            .option("checkpointLocation", f"{out}/check").trigger(availableNow=True).start())
    return spark.read.parquet(f"{out}/rows")


@query("stream_quota_per_category", """
SELECT event_type, least(500, count(*)) AS n FROM events GROUP BY event_type""")
def _(spark, sf):
    stream, out = _events(spark, sf, "quota")
    _finish(streams.stream_quota(stream.select("event_id", "event_type"), "event_type", 500,
                                 ["event_id"], f"{out}/rows", f"{out}/check"))
    return spark.read.parquet(f"{out}/rows").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("stream_retry_split", """
SELECT event_id, event_type = 'error' AND event_id % 3 + 1 < 3 AS again,
  CASE WHEN event_type = 'error' AND event_id % 3 + 1 < 3 THEN event_id % 3 + 2
    ELSE event_id % 3 + 1 END AS attempt FROM events""")
def _(spark, sf):
    stream, out = _events(spark, sf, "retry")
    stream = stream.select("event_id", "event_type",
                           (F.pmod("event_id", F.lit(3)) + 1).alias("attempt"))
    _finish(streams.stream_retry(stream, F.col("event_type") == "error", 3, f"{out}/rows",
                                 f"{out}/retry", f"{out}/check"))
    done = spark.read.parquet(f"{out}/rows").withColumn("again", F.lit(False))
    again = spark.read.parquet(f"{out}/retry").withColumn("again", F.lit(True))
    return done.unionByName(again).select("event_id", "again", "attempt")


@query("stream_export_batches", """
SELECT batch, least(2000, (SELECT count(*) FROM events) - (batch - 1) * 2000) AS n
FROM (SELECT unnest(range(1, (SELECT count(*) FROM events) // 2000
  + CASE WHEN (SELECT count(*) FROM events) % 2000 > 0 THEN 2 ELSE 1 END)) AS batch)""")
def _(spark, sf):
    stream, out = _events(spark, sf, "export")
    _finish(streams.stream_batches(stream.select("event_id", "event_type"), 2000, ["event_id"],
                                   f"{out}/rows", f"{out}/check"))
    return spark.read.parquet(f"{out}/rows").groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


@query("observed_progress", """
SELECT count(*) AS scanned, count(*) FILTER (WHERE event_type = 'purchase') AS found FROM events""")
def _(spark, sf):
    watch = Observation("visits")
    rows = read(spark, sf, "events").observe(
        watch, F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("event_type") == "purchase").alias("found"))
    rows.write.parquet(scratch_path(spark, "observed"))
    return spark.createDataFrame([(watch.get["scanned"], watch.get["found"])],
                                 "scanned LONG, found LONG")


def _append_lines(folder: str, rows) -> None:
    """Let tasks append their events to files of their own, as workers on a cluster do; the last
    line of each stays without its end until the next time."""
    import os

    def write(batches):
        from pyspark import TaskContext

        name = f"{folder}/worker-{TaskContext.get().partitionId()}.csv"
        for batch in batches:
            lines = "\n".join(batch.column("line").to_pylist())
            with open(name, "a") as file:
                file.write("\n" + lines if file.tell() else "event_id,event_type\n" + lines)
        yield from ()

    os.makedirs(folder, exist_ok=True)
    lines = rows.select(F.concat_ws(",", "event_id", "event_type").alias("line"), "event_id")
    lines.repartition(FILES, "event_id").select("line").mapInArrow(write, "line STRING").collect()


@query("stream_grown_files", """
SELECT event_id, event_type FROM events""")
def _(spark, sf):
    out = scratch_path(spark, "grown")
    folder = growing.local_path(f"{out}/in")
    events = read(spark, sf, "events")
    ends = spark.range(FILES * 16).select(F.col("id").alias("event_id"),
                                          F.lit("").alias("event_type"))
    halves = [events.where("event_type < 'p'"), events.where("event_type >= 'p'")]
    for rows in (*halves, ends):  # the last ones end the lines that are still open
        _append_lines(folder, rows)
        stream = growing.tail_csv(spark, folder, "event_id LONG, event_type STRING",
                                  range_bytes=64 << 10)
        _finish(streams.append_batches(stream.where("event_type <> ''").select(
            "event_id", "event_type"), f"{out}/rows", f"{out}/check"))
    return spark.read.parquet(f"{out}/rows")


@query("stream_quota_in_state", """
SELECT event_type, least(300, count(*)) AS n, least(300, count(*)) AS last_number, TRUE AS filled
FROM events WHERE event_type <> 'error' GROUP BY event_type""")
def _(spark, sf):
    stream, out = _events(spark, sf, "state-quota")
    kinds = [r.event_type for r in read(spark, sf, "events").select("event_type").distinct()
             .where("event_type <> 'error'").collect()]  # as many as there are event types
    counts = {r.event_type: r.n for r in read(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    full = stateful.run_until_full(
        stream.select("event_id", "event_type"), "event_type",
        {k: min(300, counts[k]) for k in kinds}, ["event_id"], f"{out}/rows", f"{out}/check",
        available_now=True)[1]
    return spark.read.parquet(f"{out}/rows").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("number").alias("last_number")).withColumn(
        "filled", F.lit(full))


def _turned_away(row, attempt: int) -> bool:
    """A user's error is turned away as often as the number of the user says."""
    return attempt <= int(row["user_id"].iloc[0]) % 5


@query("stream_retry_backoff", """
SELECT user_id, least(user_id % 5 + 1, 3)::INT AS attempt, user_id % 5 >= 3 AS throttled
FROM (SELECT DISTINCT user_id FROM events WHERE event_type = 'error')""")
def _(spark, sf):
    stream, out = _events(spark, sf, "backoff")
    rows = stateful.retry_with_backoff(
        stream.where("event_type = 'error'").select("user_id", "event_id"), ["user_id"],
        _turned_away, attempts=3, delay_ms=200, longest_ms=400)
    stateful.run_retries(rows, f"{out}/rows", f"{out}/check")
    return spark.read.parquet(f"{out}/rows").select("user_id", "attempt", "throttled")


@query("stream_two_stages", """
SELECT event_id, e.user_id, s_name AS supplier
FROM (SELECT *, 'shop' || user_id || (['.com', '.co.uk', '.de', '.in', '.com.au', '.ca', '.us',
  '.shop'])[1 + user_id % 8] AS site FROM events) e JOIN dns_flags d ON d.domain = e.site
LEFT JOIN supplier ON s_suppkey = user_id WHERE has_mx""", uses="dns_flags")
def _(spark, sf):
    path, out = _arrive(spark, sf, "stages")
    facts = match.collapse_dns(dns_answers(spark, sf)).where("has_mx").select("domain", "has_mx")
    names = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"),
                                               F.col("s_name").alias("supplier"))

    def verified(rows):
        keyed = rows.withColumn("domain", store_domain(F.col("user_id")))
        return streams.stream_enrich(keyed, facts, "domain").where("has_mx").select(
            "event_id", "user_id")

    def enriched(rows):
        return streams.stream_enrich(rows, names, "user_id")

    for files in (1, FILES):  # the second stage is stopped and goes on where it was
        _finish(streams.stage(streams.tail(spark, path, EVENT, "parquet", files), verified,
                              f"{out}/verified"))
        committed = streams.stage_output(spark, f"{out}/verified",
                                         "event_id LONG, user_id LONG")
        _finish(streams.stage(committed, enriched, f"{out}/enriched"))
    return spark.read.parquet(f"{out}/enriched/rows").select("event_id", "user_id", "supplier")


@query("stream_live_progress", """
SELECT count(*) AS scanned, count(*) FILTER (WHERE event_type = 'purchase') AS found,
  0::BIGINT AS left FROM events""")
def _(spark, sf):
    stream, out = _events(spark, sf, "progress")
    total = read(spark, sf, "events").count()
    log = streams.ProgressLog("visits", total=total)
    spark.streams.addListener(log)
    try:
        rows = streams.observe_progress(stream, "visits", F.col("event_type") == "purchase")
        _finish(streams.append_batches(rows.select("event_id"), f"{out}/rows", f"{out}/check"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(log)
    return log.table(spark).agg(F.sum("scanned").alias("scanned"), F.sum("found").alias("found"),
                                F.min("left").alias("left"))


@query("exclude_seen_from_store", """
SELECT user_id, count(*) AS n FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) AND user_id NOT IN (
  SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY user_id""")
def _(spark, sf):
    store = SeenStore(spark, scratch_path(spark, "seen"), {"user_id": "LONG"}, buckets=16)
    earlier = (read(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id")),
               read(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(
                   F.col("c_custkey").alias("user_id")))
    for batch_id, keys in enumerate(earlier):
        store.add(keys, batch_id)
    return store.unseen(read(spark, sf, "events")).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"))
