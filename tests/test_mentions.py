"""Person patterns as values and as a table, against Python's own patterns."""

import re

import pytest
from pyspark.sql import functions as F

from contactloom import patterns
from contactloom.operators import extract, mentions

TEXTS = [
    "Founded by Anna Miller in Rome, launched by Peter Hall too. Meet our founder, Ann Lee Ray",
    "Anna Miller, Founder. Anna Miller, Founder. CEO: John Long Doe and Owner: Max Planck",
    "Handmade by Anna & Peter Hall.", "baby gifts, nobody home", "Established by Zoe Claes",
    "", None, "words " * 30_000 + "created by Ida Bell", "Grundlægger: Søren Mikkelsen",
    "MEET OUR FOUNDER JANE ROE", "Founded by Anna Miller in Rome"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, "p", "h") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id INT, text STRING, pat STRING, hit STRING").cache()


def plain(table):
    out = []
    for i, t in enumerate(TEXTS):
        for number, (pattern, needs) in enumerate(table, start=1):
            if any(n in (t or "").lower() for n in needs):
                for hit, m in enumerate(re.finditer("(?i)" + pattern, t)):
                    out.append((i, number, hit, m[0], m[1].strip(" ")))
    return sorted(out)


@pytest.mark.parametrize("table", [patterns.PAGE_PATTERNS, patterns.SITE_PATTERNS])
def test_table_and_row_form_find_the_same(spark, texts, table):
    known = mentions.pattern_table(spark, table)
    by_table = sorted(map(tuple, mentions.mentions_by_table(texts, "id", "text", known).collect()))
    in_row = extract.person_candidates(texts, "text", ["id"], table).select(
        "id", F.posexplode("mentions").alias("n", "m")).select("id", "n", "m.*").collect()
    assert ([(r[0], r[1], r[3], r[4]) for r in by_table]
            == [(r.id, r.pat, r.whole, r.cand) for r in sorted(in_row, key=lambda r: r[:2])])
    if table is patterns.PAGE_PATTERNS:
        assert by_table == plain(table)


def test_only_pairs_with_a_literal_run(spark, texts):
    known = mentions.pattern_table(spark, patterns.PAGE_PATTERNS)
    got = {tuple(r) for r in mentions.possible_patterns(texts, "id", "text", known).collect()}
    assert got == {(i, n) for i, t in enumerate(TEXTS)
                   for n, (_, needs) in enumerate(patterns.PAGE_PATTERNS, start=1)
                   if any(x in (t or "").lower() for x in needs)}


def test_nothing_to_read_and_nothing_to_look_for(spark, texts):
    known = mentions.pattern_table(spark, patterns.PAGE_PATTERNS)
    assert mentions.mentions_by_table(texts.limit(0), "id", "text", known).count() == 0
    assert mentions.mentions_by_table(texts, "id", "text", known.limit(0)).count() == 0
    without = known.withColumn("needs", F.lit(None).cast("array<string>"))
    assert mentions.mentions_by_table(texts, "id", "text", without).count() == 0


def test_plan_does_not_grow_with_the_patterns(texts):
    def nodes(table):
        plan = extract.person_candidates(texts, "text", ["id"], table)._jdf.queryExecution()
        return len(re.findall(r"regexp_extract", plan.optimizedPlan().toString()))

    assert nodes(patterns.PAGE_PATTERNS) == nodes(patterns.SITE_PATTERNS * 4) == 2


def test_patterns_are_read_once(texts):
    plan = extract.person_candidates(texts, "text", ["id"])._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert "from_json" not in text and "JsonToStructs" not in text


def test_bios_of_one_small_file_are_read_by_all_cores(spark):
    """A file of one split, as customers have, would be one task of patterns."""
    from contactloom.catalog import QUERIES

    found = QUERIES["profile_bio_person"](spark, "/root/testdata/sf0.001")
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
