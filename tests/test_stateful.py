"""Growing files, keyed state, chained stages and the seen-store, with restarts."""

import os
import re
import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from contactloom.sources import growing
from contactloom.sources.seen import SeenStore
from contactloom.streaming import stateful, streams
from tests.test_streaming import drop, run

SCHEMA = "email STRING, niche STRING, seq LONG"


def append(path, text):
    with open(path, "ab") as file:
        file.write(text.encode() if isinstance(text, str) else text)


# -- growing files ------------------------------------------------------------------------

def read_lines(spark, source, out, check, size=growing.RANGE_BYTES):
    run(streams.append_batches(growing.tail_lines(spark, source, ".csv", size), out, check))
    return sorted((r.file, r.position, r.line) for r in spark.read.parquet(out).collect())


@pytest.mark.parametrize("size", [growing.RANGE_BYTES, 7, 1])
def test_appended_rows_come_once(spark, tmp_path, size):
    source, out, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    os.mkdir(source)
    a, b = f"{source}/a.csv", f"{source}/b.csv"
    append(a, "one\ntwo\r\nthr")  # the last line is under way
    append(f"{source}/_hidden.csv", "no\n")
    append(f"{source}/other.txt", "no\n")
    first = [("a.csv", 0, "one"), ("a.csv", 4, "two")]
    assert read_lines(spark, source, out, check, size) == first
    append(a, "ee\nfour é\n")
    append(b, "\n\nlong line of many bytes\n")
    second = [("a.csv", 9, "three"), ("a.csv", 15, "four é"), ("b.csv", 0, ""),
              ("b.csv", 1, ""), ("b.csv", 2, "long line of many bytes")]
    assert read_lines(spark, source, out, check, size) == first + second
    assert read_lines(spark, source, out, check, size) == first + second  # nothing new


def test_failed_batch_is_read_again(spark, tmp_path):
    """The offset is logged before the batch runs: a restart reads just those bytes again."""
    source, out, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    os.mkdir(source)
    append(f"{source}/a.csv", "1\n2\n")

    def fail(batch, batch_id):
        raise RuntimeError("lost")

    query = (growing.tail_lines(spark, source).writeStream.foreachBatch(fail)
             .option("checkpointLocation", check).trigger(availableNow=True).start())
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    append(f"{source}/a.csv", "3\n")
    for _ in range(2):  # the batch under way, then the rest
        run(streams.append_batches(growing.tail_lines(spark, source), out, check))
    assert sorted(r.line for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_shrunk_file_is_an_error(tmp_path):
    append(f"{tmp_path}/a.csv", "1\n2\n")
    with pytest.raises(ValueError, match="only grow"):
        growing.positions(str(tmp_path), "", {"a.csv": 100})


def test_ranges_own_the_lines_that_begin_in_them(tmp_path):
    path = f"{tmp_path}/a.csv"
    append(path, "".join(f"{'x' * (i % 5)}\n" for i in range(40)))
    whole = list(growing.lines(growing.Range(path, 0, 0, os.path.getsize(path))))
    for size in range(1, 12):
        parts = growing.ranges(str(tmp_path), {"a.csv": 3}, {"a.csv": os.path.getsize(path)},
                               size)
        assert [x for p in parts for x in growing.lines(p)] == [x for x in whole if x[0] >= 3]


def test_last_line_end_is_found_far_back(tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "BLOCK_BYTES", 4)
    path = f"{tmp_path}/a.csv"
    append(path, "ab\n" + "c" * 30)
    assert growing.complete_bytes(path, 0) == 3
    append(path, "\n")
    assert growing.complete_bytes(path, 3) == 34


def test_csv_and_json_rows(spark, tmp_path):
    source = f"{tmp_path}/in"
    os.mkdir(source)
    append(f"{source}/a.csv", 'email,niche,seq\n"a, b",A,1\n\nbroken\n')
    append(f"{source}/a.jsonl", '{"email": "x", "seq": 2}\n')
    for n, stream in enumerate((growing.tail_csv(spark, source, SCHEMA),
                                growing.tail_json(spark, source, SCHEMA))):
        run(streams.append_batches(stream, f"{tmp_path}/out{n}", f"{tmp_path}/check{n}"))
    rows = spark.read.parquet(f"{tmp_path}/out0").orderBy("position").collect()
    assert [(r.email, r.niche, r.seq) for r in rows] == [("a, b", "A", 1), ("broken", None, None)]
    assert [(r.email, r.seq) for r in spark.read.parquet(f"{tmp_path}/out1").collect()] == [
        ("x", 2)]


# -- quotas -------------------------------------------------------------------------------

def test_quota_ends_by_itself_and_restarts(spark, tmp_path):
    source, out, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    targets = {"A": 5, "B": 3, "C": 0}
    drop(spark, source, [(f"a{i}", "A", i) for i in range(20)] + [("b", "B", 50)]
         + [("n", None, 60), ("z", "Z", 61)])

    def fill(available_now):
        stream = streams.tail(spark, source, SCHEMA, "json", files_per_trigger=1)
        return stateful.run_until_full(stream, "niche", {k: v for k, v in targets.items() if v},
                                       ["seq"], out, check, parts=3,
                                       available_now=available_now, timeout=60)[1]

    assert not fill(True)  # B has one of three
    got = {(r.niche, r.number): r.seq for r in spark.read.parquet(out).collect()}
    assert got == {("A", i + 1): i for i in range(5)} | {("B", 1): 50}
    assert stateful.full_in_state(spark, check, "niche", targets) == {"A"}
    # The next run waits for rows, fills B and ends without being told to.
    later = threading.Timer(1.0, lambda: drop(
        spark, source, [(f"b{i}", "B", 70 + i) for i in range(9)] + [("a", "A", 90)]))
    later.start()
    assert fill(False)
    later.join()
    got = {(r.niche, r.number): r.seq for r in spark.read.parquet(out).collect()}
    assert got == {("A", i + 1): i for i in range(5)} | {
        ("B", 1): 50, ("B", 2): 70, ("B", 3): 71}
    assert fill(False)  # nothing left to fill


# -- retries ------------------------------------------------------------------------------

def throttled(row, attempt):
    """The address says how often it is turned away."""
    return attempt <= int(row["email"].iloc[0])


def test_retries_wait_and_end(spark, tmp_path):
    source, out, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    drop(spark, source, [("0", "a", 1), ("1", "b", 2), ("2", "c", 3), ("9", "d", 4),
                         ("9", "d", 4), ("0", None, 5)])

    def retry(timeout):
        rows = stateful.retry_with_backoff(
            streams.tail(spark, source, SCHEMA, "json"), ["niche"], throttled, attempts=3,
            delay_ms=700, longest_ms=1000)
        stateful.run_retries(rows, out, check, timeout=timeout)

    retry(6.0)  # may end while some wait
    time.sleep(0.5)
    drop(spark, source, [("0", "a", 7), ("0", "e", 8)])  # "a" is done, "e" is new
    retry(90.0)
    rows = spark.read.parquet(out).collect()
    assert Counter((r.niche, r.attempt, r.throttled) for r in rows) == Counter([
        ("a", 1, False), ("b", 2, False), ("c", 3, False), ("d", 3, True), (None, 1, False),
        ("e", 1, False)])
    assert {r.seq for r in rows if r.niche == "a"} == {1}
    at = {r.niche: r["at"] for r in rows}
    assert at["b"] > at["a"] and at["c"] > at["a"]
    assert stateful.waiting_rows(spark, check) == 0


# -- stages -------------------------------------------------------------------------------

def test_second_stage_follows_the_first(spark, tmp_path):
    source, mid, out = (f"{tmp_path}/{n}" for n in ("in", "mid", "out"))

    def first():
        rows = streams.tail(spark, source, SCHEMA, "json").where(F.col("seq") % 2 == 0)
        run(streams.append_batches(rows, mid, f"{tmp_path}/check1"))

    def second():
        rows = streams.tail_committed(spark, mid, SCHEMA).withColumn("kind", F.lit("x"))
        run(streams.append_batches(rows, out, f"{tmp_path}/check2"))

    drop(spark, source, [(str(i), "A", i) for i in range(6)])
    first()
    second()
    drop(spark, source, [(str(i), "A", i) for i in range(6, 10)])
    first()  # stage one is ahead
    drop(spark, source, [(str(i), "A", i) for i in range(10, 14)])
    first()
    # A file that no committed batch names is not there for the second stage.
    spark.createDataFrame([("stray", "A", 99)], SCHEMA).write.mode("append").parquet(
        f"{tmp_path}/stray")
    stray = next(f for f in os.listdir(f"{tmp_path}/stray") if f.endswith(".parquet"))
    os.link(f"{tmp_path}/stray/{stray}", f"{mid}/{stray}")
    second()
    second()
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == list(range(0, 14, 2))


# -- seen-store ---------------------------------------------------------------------------

KEYS = {"email": "STRING", "niche": "STRING"}


def test_store_tells_seen_from_unseen(spark, tmp_path):
    folder = f"{tmp_path}/seen"
    store = SeenStore(spark, folder, KEYS, buckets=4)
    first = spark.createDataFrame([("a", "A", 1), ("a", None, 2), (None, None, 3)], SCHEMA)
    assert store.unseen(first, 0).count() == 3
    store.add(first, 0)
    rows = spark.createDataFrame([("a", "A", 9), ("a", "B", 8), ("a", None, 7), (None, None, 6),
                                  (None, "A", 5), ("a", "B", 4)], SCHEMA)
    assert sorted(r.seq for r in store.unseen(rows, 1).collect()) == [4, 5, 8]
    assert store.unseen(rows, 0).count() == 6  # a batch that runs again does not see itself
    store.add(rows, 1)
    store.add(rows.where("seq = 8"), 1)  # and replaces its keys
    store.close()
    again = SeenStore(spark, folder, KEYS, buckets=99)  # another session's view of the folder
    assert again.buckets == 4
    assert sorted(r.seq for r in again.unseen(rows).collect()) == [5]
    assert again.unseen(rows.limit(0)).count() == 0
    again.close()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_is_neither_shuffled_nor_read_whole(spark, tmp_path):
    store = SeenStore(spark, f"{tmp_path}/seen", {"id": "LONG"}, buckets=16)
    store.add(spark.range(20_000), 0)
    small, large = spark.range(19_998, 20_002), spark.range(10_000, 30_000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = store.unseen(small, 1)
        assert sorted(r.id for r in fresh.collect()) == [20_000, 20_001]
        # Four hashes open four buckets at most.
        found = re.search(r"SelectedBucketsCount: (\d+) out of 16", fresh._sc._jvm.PythonSQLUtils
                          .explainString(fresh._jdf.queryExecution(), "formatted"))
        assert found and int(found[1]) <= 4
        fresh = store.unseen(large, 1)
        assert fresh.count() == 10_000
        side = plan_of(fresh).split("FileScan")[0].splitlines()
        # Only the batch is dealt out; between the join and the store's scan no row moves.
        assert plan_of(fresh).count("Exchange hashpartitioning") == 1
        assert not any("Exchange" in line for line in side[-4:])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        store.close()
