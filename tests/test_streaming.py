"""Streams over small folders, restarts included."""

import pytest
from pyspark.sql import functions as F

from contactloom.streaming import streams

SCHEMA = "email STRING, niche STRING, seq LONG"


def drop(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(path)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_quota_holds_over_batches_and_restarts(spark, tmp_path):
    source, out, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    drop(spark, source, [(f"a{i}", "A", i) for i in range(6)] + [("b0", "B", 6)])
    stream = lambda: streams.tail(spark, source, SCHEMA, "json")
    run(streams.stream_quota(stream(), "niche", 4, ["seq"], out, check))
    drop(spark, source, [(f"x{i}", n, 10 + i) for i, n in enumerate("ABBBBB")])
    run(streams.stream_quota(stream(), "niche", 4, ["seq"], out, check))
    got = {r.niche: r["count"] for r in spark.read.parquet(out).groupBy("niche").count().collect()}
    assert got == {"A": 4, "B": 4}


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    out = f"{tmp_path}/out"
    df = spark.createDataFrame([("a", "A", 1)], SCHEMA)
    for _ in range(2):
        streams._put(df, out, 0)
    streams._put(df, out, 1)
    assert spark.read.parquet(out).count() == 2
    assert streams._stored(spark, out, 1).count() == 1
    assert streams._stored(spark, f"{tmp_path}/none", 1) is None


def test_dedupe_against_history(spark, tmp_path):
    source, out, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    drop(spark, source, [("a", "A", 1), ("a", "A", 2), ("b", "A", 3), ("old", "A", 4)])
    history = spark.createDataFrame([("old",)], "email STRING")
    stream = streams.tail(spark, source, SCHEMA, "json")
    run(streams.append_batches(streams.stream_dedupe(stream, history, ["email"]), out, check))
    drop(spark, source, [("b", "A", 5), ("c", "A", 6)])
    stream = streams.tail(spark, source, SCHEMA, "json")
    run(streams.append_batches(streams.stream_dedupe(stream, history, ["email"]), out, check))
    assert sorted(r.email for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_first_wins_equals_batch(spark, tmp_path):
    source, out, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    first = [("a", "A", 1), ("a", "B", 2), ("b", "A", 3)]
    second = [("b", "B", 4), ("c", "B", 5), ("c", "A", 6)]
    for rows in (first, second):
        drop(spark, source, rows)
        run(streams.stream_first_wins(streams.tail(spark, source, SCHEMA, "json"), ["email"],
                                      ["seq"], out, check))
    got = sorted((r.email, r.seq) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1), ("b", 3), ("c", 5)]


def test_batches_number_through(spark, tmp_path):
    source, out, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    for lo, hi in ((0, 7), (7, 12)):
        drop(spark, source, [(str(i), "A", i) for i in range(lo, hi)])
        run(streams.stream_batches(streams.tail(spark, source, SCHEMA, "json"), 5, ["seq"], out,
                                   check))
    got = {r.seq: (r.row_no, r.batch) for r in spark.read.parquet(out).collect()}
    assert got == {i: (i + 1, i // 5 + 1) for i in range(12)}


def test_retry_loses_nothing(spark, tmp_path):
    source, out, retry, check = (f"{tmp_path}/{n}" for n in ("in", "out", "retry", "check"))
    drop(spark, source, [("429", "A", 1), ("200", "A", 2), ("429", "B", 3)])
    stream = streams.tail(spark, source, SCHEMA, "json").withColumn(
        "attempt", F.when(F.col("niche") == "B", 3).otherwise(1))
    run(streams.stream_retry(stream, F.col("email") == "429", 3, out, retry, check))
    assert [(r.seq, r.attempt) for r in spark.read.parquet(retry).collect()] == [(1, 2)]
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == [2, 3]


def test_progress_log_and_stop(spark, tmp_path):
    source = f"{tmp_path}/in"
    drop(spark, source, [(str(i), "A", i) for i in range(9)])
    log = streams.ProgressLog("seen", done=lambda v: v["found"] >= 3)
    spark.streams.addListener(log)
    try:
        stream = streams.observe_progress(streams.tail(spark, source, SCHEMA, "json"), "seen",
                                          F.col("seq") % 3 == 0)
        query = (stream.writeStream.format("noop").option("checkpointLocation",
                                                          f"{tmp_path}/check").start())
        query.processAllAvailable()
        for _ in range(50):
            if log.rows:
                break
            query.awaitTermination(0.2)
        full = streams.stop_when_full(query, lambda: {"A": 9}, ["A"], 9)
        assert full and not query.isActive
        assert log.rows[0]["scanned"] == 9 and log.rows[0]["found"] == 3 and log.finished
    finally:
        spark.streams.removeListener(log)


def test_running_counts(spark, tmp_path):
    source = f"{tmp_path}/in"
    drop(spark, source, [("a", "A", 1), ("b", "B", 2), ("c", "A", 3)])
    query = (streams.running_counts(streams.tail(spark, source, SCHEMA, "json"), "niche")
             .writeStream.outputMode("complete").format("memory").queryName("counts")
             .trigger(availableNow=True).start())
    run(query)
    assert {r.niche: r.n for r in spark.table("counts").collect()} == {"A": 2, "B": 1}


def test_enrich_keeps_all_rows(spark, tmp_path):
    source, out, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    drop(spark, source, [("a", "A", 1), ("b", "B", 2)])
    table = spark.createDataFrame([("a", True)], "email STRING, has_mx BOOLEAN")
    rows = streams.stream_enrich(streams.tail(spark, source, SCHEMA, "json"), table, "email")
    run(streams.append_batches(rows, out, check))
    assert {r.email: r.has_mx for r in spark.read.parquet(out).collect()} == {"a": True,
                                                                             "b": None}


@pytest.mark.parametrize("rows", [[("a", "A", 1)]])
def test_bounded_dedupe_keeps_first(spark, tmp_path, rows):
    source, out, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    drop(spark, source, rows * 3)
    stream = streams.tail(spark, source, SCHEMA, "json").withColumn(
        "ts", F.timestamp_seconds("seq"))
    unique = streams.stream_dedupe(stream, None, ["email"], "ts", "1 hour")
    run(streams.append_batches(unique, out, check))
    assert spark.read.parquet(out).count() == 1
