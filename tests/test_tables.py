"""Keyword tables as substrings, sketches that add up, feeds read as XML."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactloom.operators import feeds, sketches, substrings


# -- substrings ---------------------------------------------------------------------------

def text_rows(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices("abc é", k=rng.randrange(0, 40))) for _ in range(60)]
    texts += [None, "", "a", "aaaaaaaaaaaa", "日本語テキスト", "abc" * 400, "aaaaaaaaaaaa"]
    return list(enumerate(texts))


def term_rows(seed):
    rng = random.Random(seed)
    terms = ["".join(rng.choices("abc é", k=rng.randrange(1, 9))) for _ in range(50)]
    return terms + ["", None, "本語", "テキスト", "zzzz", "zz", "a", "a", "aaaaaaaaaaaa",
                    "aaaaaaaaaaaaa", "abcabcabcabc"]


@pytest.mark.parametrize("size", [2, 4, 6])
def test_substrings_equal_contains(spark, size):
    texts, terms = text_rows(size), term_rows(size)
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "id long, text string, term string")
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    got = sorted(tuple(r) for r in substrings.substring_hits(df, "id", "text", table,
                                                             size=size).collect())
    want = sorted({(i, t) for i, x in texts if x for t in terms if t and t in x})
    assert got == want
    assert substrings.substring_hits(df.limit(0), "id", "text", table).count() == 0
    assert substrings.substring_hits(df, "id", "text", table.limit(0)).count() == 0


def test_first_priority_wins(spark):
    df = spark.createDataFrame([(1, "supershoes and bags"), (2, "nothing"), (3, None)],
                               "id long, text string")
    table = spark.createDataFrame(
        [("bag", 2, "B"), ("shoe", 1, "S"), ("shoe", 3, "Z"), ("ags", 1, "A"), ("", 0, "E")],
        "term string, prio int, niche string")
    got = {r.id: r.niche for r in substrings.classify_by_substrings(
        df, "id", "text", table, default="none").collect()}
    assert got == {1: "A", 2: "none", 3: "none"}


def test_no_plan_compares_all_texts_with_all_terms(spark):
    df = spark.createDataFrame([(i, t) for i, t in text_rows(1)], "id long, text string")
    table = spark.createDataFrame([(t,) for t in term_rows(1)], "term string")
    plan = substrings.substring_hits(df, "id", "text", table)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_text_is_confirmed_once_for_all_terms(spark):
    """Rows of equal keys stay rows of their own, and no join repeats a text for each term."""
    df = spark.createDataFrame([(1, "supershoes 日本語テ"), (1, "shoestring"), (2, None)],
                               "id long, text string")
    table = spark.createDataFrame([("shoes",), ("string",), ("本語テ",), ("日本語テ",)], "term string")
    hits = substrings.substring_hits(df.where("text LIKE 'su%' OR text IS NULL"), "id", "text",
                                     table)
    assert sorted(map(tuple, hits.collect())) == [(1, "shoes"), (1, "日本語テ"), (1, "本語テ")]
    assert "Contains(_text" not in hits._jdf.queryExecution().toString()
    assert "collect_list(term" in hits._jdf.queryExecution().toString()
    assert {r.term for r in substrings.substring_hits(df, "id", "text", table).collect()} == {
        "shoes", "string", "本語テ", "日本語テ"}


def test_grams_are_numbers_of_code_points():
    points = np.frombuffer("a日😀a日😀".encode("utf-32-le"), np.uint32).astype(np.uint64)
    assert [len(substrings.grams(points, n)) for n in range(1, 8)] == [3, 3, 3, 3, 2, 1, 0]
    assert set(substrings.grams(points, 1)) == {ord(c) for c in "a日😀"}


# -- sketches -----------------------------------------------------------------------------

def test_merged_slices_estimate_like_one_pass(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 != 0, "A").when(F.col("id") % 2 == 0, "B").alias("niche"),
        (F.col("id") % 7).alias("slice"), (F.col("id") % 9_000).alias("email"),
        F.lit(None).cast("string").alias("phone"))
    exact = {r.niche: r.n for r in rows.groupBy("niche").agg(
        F.count_distinct("email").alias("n")).collect()}
    values = {"emails": "email", "phones": "phone"}
    for batch in range(7):
        part = rows.where(F.col("slice") == batch)
        for _ in range(2 if batch == 3 else 1):  # a batch that runs again counts once
            sketches.store(sketches.sketches(part, ["niche"], values), str(tmp_path), str(batch))
    total = sketches.merged(sketches.stored(spark, str(tmp_path)), ["niche"], list(values))
    got = {r.niche: r for r in sketches.estimates(total, list(values)).collect()}
    assert set(got) == set(exact) == {"A", "B", None}
    for niche, n in exact.items():
        assert abs(got[niche].emails - n) <= 0.02 * n and got[niche].phones == 0
    assert sum(r.n for r in got.values()) == 40_000
    whole = sketches.estimates(sketches.merged(total, [], ["emails"]), ["emails"]).first()
    assert abs(whole.emails - 9_000) <= 180


# -- feeds --------------------------------------------------------------------------------

RSS = """<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>
<title>t</title><managingEditor>desk@shop.com (Ed Itor)</managingEditor>
<item><dc:creator><![CDATA[ Jane Roe ]]></dc:creator></item>
<item><author>joe@shop.com (Joe van Doe)</author></item>
<item><dc:creator>Jane Roe</dc:creator><dc:creator>admin</dc:creator></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><author><name>Own Er</name></author>
<entry><author><name>Ann &amp; Co</name><email>ann@shop.com</email></author>
<author><name>Bob Low</name></author></entry><entry><title>none</title></entry></feed>"""
BROKEN = "<rss><author><name>Max Born</name></author><item>& no end"


def test_all_authors_of_all_entries(spark):
    df = spark.createDataFrame([(1, RSS), (2, ATOM), (3, BROKEN), (4, None), (5, ""), (6, "plain"),
                                (7, "<rss><channel/></rss>")], "id long, feed string")
    got = sorted(tuple(r) for r in feeds.feed_authors(df, "id", "feed").collect())
    assert got == [
        (1, 0, None, "Jane", "Roe", "xml"), (1, 1, "joe@shop.com", "Joe", "Doe", "xml"),
        (1, 2, "desk@shop.com", "Ed", "Itor", "xml"),
        (2, 0, "ann@shop.com", "Ann", "Co", "xml"), (2, 1, None, "Bob", "Low", "xml"),
        (2, 2, None, "Own", "Er", "xml"), (3, 0, None, "Max", "Born", "text")]
    assert feeds.feed_authors(df.limit(0), "id", "feed").count() == 0
