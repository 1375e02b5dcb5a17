"""Physical plans: what must be there and what must not."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from contactloom.operators import join, match, rank

SF = "/root/testdata/sf0.001"
BATCH = [n for n in entry.queries() if not n.startswith(("stream_", "observed"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_two_columns_and_pushes_the_filter(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_returnflag = 'R'")
    text = plan(rank.done_keys(df, ["l_suppkey"]))
    assert "ReadSchema: struct<l_suppkey:bigint,l_returnflag:string>" in text
    assert "EqualTo(l_returnflag,R)" in text


def test_first_wins_limits_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_suppkey", "l_orderkey")
    text = plan(rank.first_wins(df, ["l_suppkey"], ["l_orderkey"]))
    assert text.index("WindowGroupLimit") < text.index("Exchange")
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_counts_are_partial_before_the_shuffle(spark):
    answers = spark.createDataFrame([], "domain STRING, rtype STRING, pref INT, data STRING")
    text = plan(match.collapse_dns(answers))
    assert text.count("partial_bool_or") or text.count("partial_max") or "partial_" in text


@pytest.fixture
def shuffled_joins(spark):
    """No broadcast, and limits that make a hot key of a small table stand out."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def test_lookup_splits_a_hot_key_and_shuffles_the_right_side_once(shuffled_joins):
    spark = shuffled_joins
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 3, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key"),
        "id", F.sha2(F.col("id").cast("string"), 256).alias("more"))
    facts = rows.select("key").distinct().withColumn("v", F.lit(1))
    facts = spark.createDataFrame(facts.collect(), "key STRING, v INT")
    out = join.lookup(rows.repartition(16), facts, "key")
    out.write.format("noop").mode("overwrite").save()
    assert plan(out).count("Exchange hashpartitioning(key") == 2
    out.collect()
    text = plan(out)
    assert "skew=true" in text
    assert out.where("key = 'hot' AND v = 1").count() == 18_000


@pytest.mark.parametrize("name,most", [("contacts_with_dns", 4), ("exclude_seen_pairs", 4)])
def test_lookups_add_no_shuffles(shuffled_joins, name, most):
    assert plan(entry.queries()[name](shuffled_joins, SF)).count("Exchange hash") <= most


def test_the_audit_moves_no_markup(shuffled_joins):
    text = plan(entry.queries()["visit_audit"](shuffled_joins, SF))
    for line in text.splitlines():
        if "Exchange" in line:
            assert "html" not in line
