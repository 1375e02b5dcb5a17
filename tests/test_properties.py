"""Brute-force checks on small and skewed inputs, and properties that always hold."""

import random

import pytest
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.operators import audit, generate, match, rank
from contactloom.operators.join import lookup, without
from contactloom.plans import flows
from contactloom.sources import readers, sinks


def skewed(n=900, keys=12, seed=5):
    """Rows (key, item, seq): a third of them under one key."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}",
             f"i{rng.randrange(60)}", i) for i in range(n)]


@pytest.fixture(scope="module")
def data(spark):
    rows = skewed()
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "key STRING, item STRING, seq LONG").repartition(7).cache()
    return rows, df


def test_running_rank(data):
    rows, df = data
    got = {r.seq: r.rank for r in rank.running_rank(df, ["item", "seq"]).collect()}
    want = {r[2]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), 1)}
    assert got == want


def test_running_rank_in_groups(data):
    rows, df = data
    got = {r.seq: r.rank for r in rank.running_rank(
        df, [F.col("seq").desc()], ["key"]).collect()}
    want, seen = {}, {}
    for key, _, seq in sorted(rows, key=lambda r: -r[2]):
        seen[key] = seen.get(key, 0) + 1
        want[seq] = seen[key]
    assert got == want


@pytest.mark.parametrize("salts", [1, 5, None])
def test_top_n(data, salts):
    rows, df = data
    got = {(r.key, r.seq, r.rank) for r in rank.top_n(df, ["key"], 20, ["seq"],
                                                      salts=salts).collect()}
    want = set()
    for key in {r[0] for r in rows}:
        mine = sorted(r[2] for r in rows if r[0] == key)[:20]
        want |= {(key, s, i) for i, s in enumerate(mine, 1)}
    assert got == want


def test_first_wins_is_idempotent_and_keeps_better_sources(data):
    rows, df = data
    once = rank.first_wins(df, ["key", "item"], ["seq"])
    twice = rank.first_wins(once, ["key", "item"], ["seq"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == len({r[:2] for r in rows})
    worse = df.withColumn("seq", F.col("seq") + 10_000)
    both = rank.first_wins(rank.union_sources(df, worse), ["key", "item"], ["source_prio", "seq"])
    assert sorted(both.drop("source_prio").collect()) == sorted(once.collect())


def test_lookups_and_exclusions(spark, data):
    _, df = data
    facts = spark.createDataFrame([("hot", 1), ("k1", 2), ("zz", 3)], "key STRING, v INT")
    skipped = lookup(df, facts, "key", skip=F.col("key") == "hot")
    assert skipped.where("key = 'hot' AND v IS NOT NULL").count() == 0
    assert skipped.where("key = 'k1' AND v = 2").count() == df.where("key = 'k1'").count()
    assert skipped.count() == df.count()
    left = without(df, facts.unionByName(facts), ["key"])
    assert sorted(left.collect()) == sorted(df.where("key NOT IN ('hot', 'k1')").collect())


def greedy(rows, n, order):
    """The row-by-row rule the rounds have to reproduce."""
    full = {c: 0 for c in order}
    taken, out = set(), {}
    for seq, key, fits in rows:
        if key in taken:
            continue
        for c in order:
            if c in fits and full[c] < n:
                full[c] += 1
                taken.add(key)
                out[seq] = c
                break
    return out


@pytest.mark.parametrize("seed, n", [(1, 5), (2, 12), (3, 1), (4, 1000), (5, 20)])
def test_quota_with_spill_equals_greedy(spark, seed, n):
    rng = random.Random(seed)
    order = ["A", "B", "C", "D"]
    weights = {"A": 0.6, "B": 0.4, "C": 0.3, "D": 0.15}
    rows = [(i, f"d{rng.randrange(90)}", [c for c in order if rng.random() < weights[c]])
            for i in range(150)]
    df = spark.createDataFrame([(i, k, ",".join(f)) for i, k, f in rows],
                               "seq LONG, domain STRING, fits STRING").repartition(5)
    tests = {c: F.contains("fits", F.lit(c)) for c in order}
    got = {r.seq: r.niche for r in rank.quota_with_spill(df, tests, n, "domain", ["seq"]
                                                         ).collect()}
    assert got == greedy(rows, n, order)


def test_quota_with_spill_without_matches(spark):
    df = spark.createDataFrame([(1, "d", "")], "seq LONG, domain STRING, fits STRING")
    got = rank.quota_with_spill(df, {"A": F.contains("fits", F.lit("A"))}, 3, "domain", ["seq"])
    assert got.count() == 0


def test_interleave(spark):
    rows = [("A", i) for i in range(7)] + [("C", i) for i in range(3)] + [("B", i)
                                                                         for i in range(5)]
    df = spark.createDataFrame(rows + [("other", 1)], "niche STRING, seq LONG").repartition(4)
    got = {(r.niche, r.seq): r.position for r in rank.interleave(
        df, "niche", ["C", "A", "B"], ["seq"]).collect()}
    want, pos = {}, 0
    for i in range(7):
        for c in ("C", "A", "B"):
            if (c, i) in rows:
                pos += 1
                want[(c, i)] = pos
    assert got == want


def test_slices_are_disjoint_and_cover(spark):
    df = spark.range(503).withColumnRenamed("id", "seq")
    placed = rank.running_rank(df, ["seq"], name="position")
    by_place = rank.slices(placed, 10, position="position").groupBy("slice").count().collect()
    assert sorted(r["count"] for r in by_place) == [50] * 7 + [51] * 3
    by_hash = rank.slices(df, 10, key="seq")
    assert by_hash.count() == 503 and by_hash.select("seq").distinct().count() == 503


def test_siblings_never_name_themselves(data):
    rows, df = data
    got = rank.siblings(df, "key", "item", 4, order=["seq"]).collect()
    first = {}
    for key, item, seq in sorted(rows, key=lambda r: r[2]):
        first.setdefault(key, [])
        if item not in first[key]:
            first[key].append(item)
    for r in got:
        others = [i for i in first[r.key] if i != r.item][:4]
        assert r.secondary_email == "; ".join(others)


def test_match_terms(spark):
    df = spark.createDataFrame([(1, "red ring"), (2, "blue bolt"), (3, "red ring")],
                               "id INT, name STRING")
    dim = spark.createDataFrame([("ring",), ("nut",)], "term STRING")
    words = F.split("name", " ")
    assert match.match_terms(df, words, dim, "term").count() == 2
    assert [r.id for r in match.match_terms(df, words, dim, "term", "left_anti").collect()] == [2]


def test_directory_beyond_the_broadcast_limit(spark, monkeypatch):
    df = spark.createDataFrame([("a", "own"), ("b", "own")], "domain STRING, owner STRING")
    dim = spark.createDataFrame([("a", "listed")], "domain STRING, owner STRING")
    want = [("a", "listed"), ("b", "own")]
    assert sorted(map(tuple, match.directory(df, dim, "domain", ["owner"]).collect())) == want
    monkeypatch.setattr(match, "lookup", lambda d, r, on: d.hint("merge").join(r, on, "left"))
    assert sorted(map(tuple, match.directory(df, dim, "domain", ["owner"]).collect())) == want


def test_audit_gives_each_visit_one_reason(spark):
    visits = spark.createDataFrame([
        ("a.test", 1, "200", "<p>"), ("b.test", 2, "200", "<p>"), ("c.test", 3, "503", None),
        ("nodot", 4, "200", "<p>"), ("d.test", 5, None, None), ("e.test", 6, "200", "<p>"),
        ("f.test", 7, "200", "<p>"), ("g.test", 8, "200", "<p>")],
        "domain STRING, seq LONG, http_status STRING, html STRING")
    candidates = spark.createDataFrame([
        ("a.test", "info@a.test", 100, 0), ("a.test", "x@gmail.com", 60, 1),
        ("e.test", "known@e.test", 100, 0), ("f.test", "info@nomx.test", 80, 0),
        ("g.test", "info@g.test", 80, 0)], "domain STRING, email STRING, score INT, pos INT")
    answers = spark.createDataFrame([("a.test", "MX", 1, "mx.zoho.eu")],
                                    "domain STRING, rtype STRING, pref INT, data STRING")
    seen = spark.createDataFrame([("g.test",)], "domain STRING")
    seen_emails = spark.createDataFrame([("known@e.test",)], "email STRING")
    got = {r.domain: r for r in audit.audit(
        visits, candidates, match.collapse_dns(answers), seen, seen_emails,
        rules.KNOWN_PROVIDERS).collect()}
    assert {d: r.rejection_reason for d, r in got.items()} == {
        "a.test": "", "b.test": "no_email_found", "c.test": "no_html:503",
        "nodot": "invalid_domain", "d.test": "timeout", "e.test": "duplicate_email",
        "f.test": "no_mx:nomx.test", "g.test": "duplicate_domain"}
    assert [d for d, r in got.items() if r.qualified == "YES"] == ["a.test"]
    assert got["a.test"].emails_found == "info@a.test, x@gmail.com"
    assert got["a.test"].mx_provider == "Zoho Mail"


def plain_audit(visits, candidates, mx, seen_domains, seen_emails):
    """The rule itself: one visit after another."""
    domains, taken, out = set(seen_domains), set(seen_emails), {}
    for domain, seq, status, html in sorted(visits, key=lambda v: v[1]):
        found = [c for c in candidates if c[0] == domain]
        if status == "429":
            continue
        if "." not in domain:
            out[seq] = ("invalid_domain", None)
        elif domain in domains:
            out[seq] = ("duplicate_domain", None)
        elif not html:
            out[seq] = ("timeout" if status == "timeout" else f"no_html:{status}", None)
        elif not found:
            out[seq] = ("no_email_found", None)
        else:
            best = [e for _, e, _, _ in sorted(found, key=lambda c: (-c[2], c[3]))
                    if e not in taken]
            if not best:
                out[seq] = ("duplicate_email", None)
            elif best[0].split("@")[1] not in mx:
                out[seq] = (f"no_mx:{best[0].split('@')[1]}", best[0])
            else:
                domains.add(domain)
                taken.add(best[0])
                out[seq] = ("", best[0])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_audit_is_the_sequence_of_visits(spark, seed):
    rng = random.Random(seed)
    sites = [f"s{i}.test" for i in range(12)] + ["nodot"]
    mails = [f"m{i}@{rng.choice(['mx.test', 'dead.test'])}" for i in range(10)]
    visits = [(rng.choice(sites), seq, status, "<p>" if status == "200" else None)
              for seq, status in enumerate(
                  rng.choices(["200", "429", "503", "timeout"], [8, 1, 1, 1], k=60))]
    candidates = [(s, m, score, pos) for s in sites[:11] for pos, (m, score) in enumerate(
        (rng.choice(mails), rng.choice([60, 80, 100])) for _ in range(rng.randrange(1, 4)))]
    unique, seen = [], set()
    for c in sorted(candidates, key=lambda c: (-c[2], c[3])):
        if c[:2] not in seen:
            seen.add(c[:2])
            unique.append(c)
    got = audit.audit(
        spark.createDataFrame(visits, "domain STRING, seq LONG, http_status STRING, html STRING"),
        spark.createDataFrame(candidates, "domain STRING, email STRING, score INT, pos INT"),
        match.collapse_dns(spark.createDataFrame(
            [("mx.test", "MX", 1, "mx.zoho.eu")],
            "domain STRING, rtype STRING, pref INT, data STRING")),
        spark.createDataFrame([("s0.test",)], "domain STRING"),
        spark.createDataFrame([("m0@mx.test",)], "email STRING"),
        {"unused.test": "Other"}).collect()
    want = plain_audit(visits, unique, {"mx.test"}, ["s0.test"], ["m0@mx.test"])
    assert {r.seq: (r.rejection_reason, r.primary_email) for r in got} == want
    yes = [r for r in got if r.qualified == "YES"]
    assert len(yes) == len({r.domain for r in yes}) == len({r.primary_email for r in yes})


def test_work_list_spill_and_plain(spark):
    rows = [(f"ring{i}.test", "", "", "", "11-50", 0, i) for i in range(8)]
    rows += [(f"ring-shirt{i}.test", "", "", "", "11-50", 1, 100 + i) for i in range(4)]
    df = spark.createDataFrame(rows, "domain STRING, brand STRING, tags STRING, tech STRING, "
                               "employees STRING, source_prio INT, seq LONG")
    seen = spark.createDataFrame([("ring0.test",)], "domain STRING")
    spilled = flows.registry_to_work_list(df, seen, 5, 3).collect()
    assert sorted((r.niche, r.domain[:6]) for r in spilled) == (
        [(rules.APPAREL, "ring-s")] * 4 + [(rules.JEWELRY, f"ring{i}.") for i in range(1, 6)])
    plain = flows.registry_to_work_list(df, seen, 5, 3, spill=False).collect()
    assert {r.niche for r in plain} == {rules.JEWELRY} and len(plain) == 5
    assert sorted(r.position for r in spilled) == list(range(1, 10))


def test_generated_rows_are_labelled(spark):
    vocabulary = {"first": ["Ada"], "last": ["Hall"], "prefix": ["Oak"], "suffix": ["Home"],
                  "title": ["Owner"], "country": ["Canada"]}
    df = generate.generate(spark, 4, vocabulary)
    assert df.count() == 20 and df.where("NOT synthetic").count() == 0
    assert df.where("NOT endswith(domain, '.example')").count() == 0
    assert [r["count"] for r in df.groupBy("niche").count().collect()] == [4] * 5


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a.test", "A", "Jewelry", "", "1-10", 0, 1),
                                ("b.test", "B", "Odd", "", "1-10", 0, 2)],
                               "domain STRING, brand STRING, niche STRING, tech STRING, "
                               "employees STRING, source_prio INT, seq LONG")
    sinks.write_by_category(df, f"{tmp_path}/niches")
    counts = spark.read.parquet(f"{tmp_path}/niches").groupBy("niche").count().collect()
    assert {r.niche: r["count"] for r in counts} == {"Jewelry": 1, rules.GENERAL: 1}
    sinks.write_slices(df, f"{tmp_path}/slices", 2)
    assert readers.read_slices(spark, f"{tmp_path}/slices", [0, 1]).count() == 1
    sinks.write_batches(df, f"{tmp_path}/batches", ["seq"], 1)
    assert spark.read.parquet(f"{tmp_path}/batches").select("batch").distinct().count() == 2
    sinks.write_master(df.withColumn("email", F.lit("a@b.test")), f"{tmp_path}/master",
                       pii="mask")
    back = spark.read.option("header", True).csv(f"{tmp_path}/master")
    assert tuple(back.columns) == rules.PROFILES["master"]
    assert {r.Email for r in back.collect()} == {"a***@b.test"}
