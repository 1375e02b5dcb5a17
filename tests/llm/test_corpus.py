"""Fingerprints, spelling variants and divergence of sources against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from contactloom.llm import divergence as dv
from contactloom.llm import simhash as sh
from contactloom.llm import variants as va
from contactloom.llm import quality
from contactloom.llm.decontaminate import passages, tokens, whole_lines
from contactloom.llm.near import keep_one
from tests.llm.conftest import edge_rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_row(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


# -- fingerprints -------------------------------------------------------------------------

def plain_print(text, width):
    w = WORD.findall((text or "").translate(LOW))
    shingles = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, most=4):
    label = list(range(len(prints)))
    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= most and label[i] != label[j]:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("width", [1, 4])
def test_simhash_equals_all_pairs(edge_docs, width):
    rows = edge_rows()
    prints = [plain_print(r[1], width) for r in rows]
    label = plain_groups(prints)
    lowest = defaultdict(list)
    for r, group in zip(rows, label, strict=True):
        lowest[group] += [] if r[0] is None else [r[0]]
    want = [(r[0], f"{p:016x}", min(lowest[g], default=None))
            for r, p, g in zip(rows, prints, label, strict=True)]
    got = [tuple(r) for r in sh.simhash_duplicates(edge_docs, width).collect()]
    assert by_row(got) == by_row(want)


def clusters(seed, n=60):
    """Prints around a few centres, so that near, just near and just far pairs all occur."""
    rng = random.Random(seed)
    out = {0, 2**64 - 1}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(n // 6):
            print_ = centre
            for bit in rng.sample(range(64), rng.randrange(7)):
                print_ ^= 1 << bit
            out.add(print_)
    return sorted(out)


@pytest.mark.parametrize("most", [sh.BUCKET_VARIANTS, 3000, 40])
def test_balls_connect_what_is_near(spark, most):
    prints = clusters(most)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = sh.ball_links(spark.createDataFrame([(p,) for p in signed], "print long"), 4, most)
    at = {p: i for i, p in enumerate(signed)}
    pairs = [(at[r.a], at[r.b]) for r in links.collect()]
    label = sh.roots(len(prints), *np.array(pairs).T)
    want = plain_groups(prints)
    assert [label.tolist().index(x) for x in label] == [want.index(x) for x in want]


def test_a_large_group_is_no_pairs(spark):
    centre = 0x0123456789ABCDEF
    prints = [centre ^ m for m in sh.flips(64, 2)]
    rows = spark.createDataFrame(
        [(p - (p >> 63 << 64),) for p in prints], "print long")
    links = sh.ball_links(rows, 8, 10**9)
    # A bucket links a print once at most, however many pairs its prints form.
    assert links.count() <= sh.spread(rows, 8).count()
    found = links.select("a").union(links.select("b")).distinct().count()
    assert found == len(prints)


def test_simhash_of_no_rows(no_docs):
    assert sh.simhash_duplicates(no_docs).columns == ["doc_id", "fingerprint", "component_id"]
    assert sh.simhash_duplicates(no_docs).collect() == []


# -- spelling variants --------------------------------------------------------------------

def plain_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 5
    n = {w: c for w, c in counts.items() if c >= 3}

    def is_near(x, y):
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y, strict=True)) == 1
        x, y = sorted((x, y), key=len)
        return len(y) - len(x) == 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))

    near = {w: [x for x in n if is_near(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return [(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None)
            for w in n]


def variant_rows(seed):
    """Words over few letters, so that all kinds of edits occur, doubled letters too."""
    rng = random.Random(seed)
    bases = ["".join(rng.choices("abé", k=rng.randrange(5, 9))) for _ in range(60)]
    bases += ["aaaaa", "aaaaaa", "aaaaaaa", "ÿÿÿÿÿ", "abcdefgh", "abcdXfgh", "abcdefghÀ", "×÷×÷×"]
    texts = [" ".join(rng.choices(bases, weights=range(1, len(bases) + 1), k=200)).title()
             for _ in range(12)]
    texts += [None, "", " \n ", "word-break_and1digits 日本語 " * 3, "Aaaaa " * 50,
              "chainaaa " * 3 + "chainaab " * 7 + "chainabb " * 20]
    return [(None if i == 3 else i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("shard_words", [10_000, 7])
def test_variants_equal_all_pairs(spark, monkeypatch, shard_words):
    monkeypatch.setattr(va, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(va, "QUERIES_AT_ONCE", 5)
    monkeypatch.setattr(va, "HELD_WORDS", 20)
    rows = variant_rows(shard_words)
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n long")
    got = [tuple(r) for r in va.spelling_variants(docs.repartition(3)).collect()]
    assert by_row(got) == by_row(plain_variants(rows))
    assert any(r[1] and r[2] != r[1] for r in got)  # a chain of forms


def test_variants_of_odd_rows(edge_docs, no_docs):
    got = [tuple(r) for r in va.spelling_variants(edge_docs).collect()]
    assert by_row(got) == by_row(plain_variants([(r[0], r[1]) for r in edge_rows()]))
    assert va.spelling_variants(no_docs).collect() == []


def test_index_ranks():
    index = va.Index([b"banana", b"bandana", b"ana"])
    low, high = index.extend(np.array([0]), np.array([index.n]), np.array([1]))
    for letter in b"ana":
        low, high = index.extend(low, high, np.array([letter]))
    # Three words end in "ana" before a delimiter.
    assert int(high[0] - low[0]) == 3


# -- divergence of sources ----------------------------------------------------------------

def plain_divergence(rows, least, top):
    group, lang_docs, lang_n = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        group[lang, source].update(terms)
        lang_n[lang].update(terms)
        lang_docs[lang].update(set(terms))
    out = []
    for (lang, source), counts in group.items():
        kept = [t for t, d in lang_docs[lang].items() if d >= least]

        def level(c, t, kept=kept):
            n = sum(c[x] for x in kept)
            return 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        pair = [(o, sum(f(level(counts, t), level(group[lang, o], t)) for t in kept))
                for la, o in group if la == lang and o != source]
        term = [(t, f(level(counts, t), level(lang_n[lang], t))) for t in kept
                if counts[t] and level(counts, t) > level(lang_n[lang], t)]
        for part, found in (("pair", pair), ("term", term)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, i + 1)
                    for i, (item, value) in enumerate(found) if part == "pair" or i < top]
    return out


def source_rows(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(90):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "c", "é", None])
        words = [f"w{'abcdefghij'[min(9, int(rng.expovariate(0.5)))]}{source}" if rng.random() < .3
                 else "Äé" if rng.random() < .1 else "t" + "abcdefghij"[rng.randrange(10)]
                 for _ in range(rng.randrange(40))]
        rows.append((" ".join(words), lang, source))
    rows += [(None, "en", "empty"), ("", "lone", "only"), ("12 34 _", "none", "x"),
             ("", "none", "y"), (None, None, None)]
    return rows + rows[:5]


@pytest.mark.parametrize("block,tile", [(512, 1024), (3, 5)])
def test_divergence_equals_the_sum_over_terms(spark, monkeypatch, block, tile):
    monkeypatch.setattr(dv, "BLOCK_TERMS", block)
    monkeypatch.setattr(dv, "TILE", tile)
    monkeypatch.setattr(dv, "HELD_TERMS", 30)
    rows = source_rows(block)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, "
                                 "source string, term string, value long").repartition(3)
    for least, top in ((10, 10), (1, 3), (1000, 10)):
        got = [tuple(r) for r in dv.divergence(docs, least, top).collect()]
        assert by_row(got) == by_row(plain_divergence(rows, least, top))


def test_divergence_of_no_rows(no_docs):
    assert dv.divergence(no_docs).collect() == []


def test_share_is_exact(spark):
    rng = random.Random(5)
    cases = [(rng.randrange(10**k), rng.randrange(1, 9)) for k in (1, 5, 9, 12)]
    cases = [(c, c * m + rng.randrange(1, 10**6)) for c, m in cases] + [(10**13, 9 * 10**13)]
    got = spark.createDataFrame(cases, "c long, d long").select(
        dv.share("c", "d").alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * (c + 2) // d for c, d in cases]


# -- generated code -----------------------------------------------------------------------

def test_decontamination_is_compiled(spark, edge_docs):
    """Methods over 8000 bytes of code are never compiled by the JVM."""
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40))),
                                   (2, "nine words make one window of their own length"),
                                   (3, "short one")], "item_id long, text string")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = passages(edge_docs, items)._jdf.queryExecution()
        code = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert len(sizes) > 3 and max(sizes) < 8000


def test_words_of_lines_are_found_once(spark):
    docs = spark.createDataFrame([(1, "one\nshort one\n")], "doc_id long, text string")
    items = spark.createDataFrame([(3, [1, 2])], "item_id long, item_hashes array<long>")
    plan = whole_lines(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_curly_quotes_take_the_short_way(spark):
    rows = spark.createDataFrame([("“Quoted” — 5 €",), ("漢字 and かな",), (None,)], "text string")
    got = [r[0] for r in rows.select(tokens("text")).collect()]
    assert got == [["quoted", "5"], ["漢", "字", "and", "か", "な"], []]


# -- one row of a group, risk of a stratum -------------------------------------------------

def test_keep_one_with_null_and_repeated_ids(spark):
    base = [f"w{i}" for i in range(120)]
    near = [" ".join(base[:i] + ["x"] + base[i + 1:]) for i in range(3)]
    far = " ".join(f"v{i}" for i in range(80))
    rows = [(None, near[0], "a"), (None, near[1], "b"), (None, near[2], "c"),  # one stays
            (5, far, "d"), (5, far + " y", "e"), (9, "z " + far, "f"),  # one of id 5 stays
            (7, None, "g"), (7, None, "h"), (None, "", "i"), (None, " ", "j"), (7, "", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = keep_one(docs).collect()
    assert sum(r.text in near for r in got) == 1
    kept = [r for r in got if r.text and "v1" in r.text]
    assert len(kept) == 1 and kept[0].doc_id == 5
    assert Counter((r.doc_id, r.text) for r in got if not (r.text or "").strip()) == Counter(
        [(7, None), (None, ""), (None, " "), (7, "")])
    assert keep_one(docs.limit(0)).collect() == []
    # A name that is not null goes before nulls.
    both = spark.createDataFrame([(None, near[0]), (12, near[1])], "doc_id long, text string")
    assert [r.doc_id for r in keep_one(both).collect()] == [12]


def test_cutoffs_hold_the_risk_together():
    """Each cutoff alone would hold the risk; all of them would reject twice as much."""
    proposed = {"symbol_share": 0.1, "mark_share": 0.2, "digit_share": 0.3}
    counts = {"good": 30_000, "first_1": 250, "first_2": 480, "first_3": 900}
    assert list(quality.certified(proposed, counts, 0.02, 0.005)) == ["symbol_share",
                                                                      "mark_share"]
    assert quality.certified(proposed, counts | {"first_1": 900}, 0.02, 0.005) == {}
    assert quality.certified({}, counts, 0.02, 0.005) == {}
