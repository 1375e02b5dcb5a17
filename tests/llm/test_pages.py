"""Operators over pages against plain versions, on every odd kind of row."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.sql import functions as F

from contactloom.llm import archive, extract
from contactloom.llm.queries_pages import RULES
from contactloom.llm.urls import (
    FEATURES, FOLDS, SAMPLE_ROWS, entropy, featured, filter_urls, lexical, ruled, train)
from contactloom.session import scratch_path

SCHEMA = "page_id long, url string, html string, host string, shard string"


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(1, "http://a.com/x", "<p>one</p>"), (2, "http://a.com/y", "<p>one</p>"),
            (3, "http://a.com/z", None), (4, None, ""), (None, "http://b.com/", "<p>one</p>"),
            (5, "no scheme", "<article>A<b>B</b> &amp; C<p>D</article>"),
            (5, "no scheme", "<article>A<b>B</b> &amp; C<p>D</article>"),
            (6, "http://c.net/es/\r\nWARC-Type: x", "<p>long " + "word " * 50_000 + "</p>")]
    return spark.createDataFrame([(*r, "h", "s") for r in rows], SCHEMA).cache()


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 1, 1000])
def test_archive_reads_back_what_it_wrote(spark, odd_pages, least):
    path = scratch_path(spark, "test-archive")
    archive.write_archive(odd_pages, path, least)
    rows = odd_pages.collect()
    got = archive.read_index(spark, path).collect()
    assert len(got) == len(rows)
    first = {}
    for r in rows:
        if r.page_id is not None and len((r.html or "").encode()) >= least:
            first[r.html or ""] = min(first.get(r.html or "", r.page_id), r.page_id)
    want = []
    for r in rows:
        size = len((r.html or "").encode())
        again = size >= least and first.get(r.html or "") not in (None, r.page_id)
        want.append((r.page_id, size, digest(r.html), "revisit" if again else "response",
                     first[r.html or ""] if again else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    for r in archive.read_records(spark, path).collect():
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert fields[b"WARC-Payload-Digest"] == b"sha1:" + digest(
            bytes(r.payload).decode()).encode()
        assert len(body) == int(fields[b"Content-Length"]) + 4
        if fields[b"WARC-Type"] == b"response":
            assert body == bytes(r.payload) + b"\r\n\r\n"


def test_damaged_payloads_are_noticed(spark, odd_pages):
    path, broken = scratch_path(spark, "test-archive"), scratch_path(spark, "test-archive")
    archive.write_archive(odd_pages, path)
    spark.read.parquet(f"{path}/headers").write.parquet(f"{broken}/headers")
    spark.read.parquet(f"{path}/payloads").selectExpr(
        "sha256", "sha1", "payload_bytes", "cast('x' AS binary) AS payload").write.parquet(
        f"{broken}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        archive.read_index(spark, broken).collect()


def test_archive_of_nothing(spark, odd_pages):
    path = scratch_path(spark, "test-archive")
    archive.write_archive(odd_pages.limit(0), path)
    assert archive.read_index(spark, path).count() == 0


def plain_parts(url):
    after = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", after)[0]
    return host.lower(), re.match(r"[^?#]*", after[len(host):])[0]


def plain_rule(host, path):
    best = None
    for what, rule in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[1]):
                best = (what, rule)
    return best


def test_url_rules(spark):
    urls = [None, "", "x", "http://", "http://com/", "http://COM", "http://Example.com/en/1?a=b",
            "http://www.example.com/en/2#x", "http://www.example.com/enx", "ftp://a.net/es/x",
            "http://a.net/fr", "http://a.net/fr/", "http://xexample.com/en/", "//a.com/",
            "http://a.b.www.example.com/en/", "http://a.org/http://b.com/", "http://ünï.com/É",
            "http://a.com?x=/y", "http://x.net/" + "a" * 100_000, "http://a.com/\nb"]
    rows = [(i, u, "h", "p") for i, u in enumerate(urls)] + [(0, None, "h", "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, label string")
    got = filter_urls(pages, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = plain_parts(urls[r.page_id])
        rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[1])
        assert r.verdict == rule[0] if rule else r.verdict in ("allow", "block")
    assert filter_urls(pages.limit(0), RULES).count() == 0


def test_trees_learn_held_out_addresses(spark):
    """Trained on half of labelled addresses, the trees judge the other half."""
    rng = random.Random(4)
    rows = []
    for i in range(2000):
        bad = rng.random() < 0.5
        host = "".join(rng.choice("abcdefgh") for _ in range(6 + 12 * bad))
        path = "/".join(str(rng.randrange(10 ** (1 + 6 * bad))) for _ in range(1 + 3 * bad))
        rows.append((i, f"http://{host}.org/{path}", float(bad)))
    data = spark.createDataFrame(rows, "page_id long, url string, known double")
    data = data.selectExpr("*", "parse_url(url, 'HOST') AS host", "parse_url(url, 'PATH') AS "
                           "path", "IF(page_id % 2 = 0, known, NULL) AS label",
                           "page_id AS draw", "0.0D AS suffix_frequency",
                           "0.5D AS suffix_block_share")
    data = lexical(data)
    from pyspark.ml.feature import VectorAssembler
    model = train(data, SAMPLE_ROWS)
    held = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features")
                           .transform(data.where("label IS NULL")))
    assert held.where("prediction = known").count() >= 0.97 * held.count()
    assert train(data.where("known = 1")) == "block"
    assert train(data.where("label IS NULL")) == "allow"


def plain_features(rows):
    """The features of (url, label) rows, computed one by one."""
    parts = [plain_parts(u) for u, _ in rows]
    suffix = [h.rsplit(".", 1)[-1] for h, _ in parts]
    fold = []
    for h, _ in parts:
        x = xxhash.xxh64(h.encode(), seed=42).intdigest()
        fold.append((x - 2**64 if x >= 2**63 else x) % FOLDS)
    out = []
    for i, ((url, _), (host, path)) in enumerate(zip(rows, parts, strict=True)):
        url = url or ""
        found = re.search(r"\?([^#]*)", url)
        query = found[1] if found else ""
        shares = [url.count(c) / len(url) for c in dict.fromkeys(url)]
        others = [rows[j][1] for j in range(len(rows)) if suffix[j] == suffix[i]
                  and fold[j] != fold[i] and rows[j][1] is not None]
        out.append([
            len(url), len(host), host.count("."), path.count("/"), len(path),
            len(re.findall("[0-9]", url)) / len(url) if url else 0.0, url.count("-"),
            query.count("&") + 1 if query else 0, len(query), url.count("%"),
            -sum(p * math.log2(p) for p in shares), float(url.startswith("https:")),
            float(bool(re.search(r"\.[A-Za-z0-9]{1,5}$", path))),
            math.log1p(suffix.count(suffix[i])), (sum(others) + 1) / (len(others) + 2)])
    return out


def plain_tree(lines):
    """A tree of the model's printed form, as a function of a row of features."""
    text = lines.pop(0)
    if text.startswith("Predict"):
        value = float(text.split(":")[1])
        return lambda row: value
    feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", text).groups()
    low = plain_tree(lines)
    assert lines.pop(0).startswith("Else")
    high = plain_tree(lines)
    return lambda row: (low if row[int(feature)] <= float(limit) else high)(row)


def test_verdicts_equal_a_plain_evaluation_of_the_trees(spark):
    """Every page without a rule, null and odd addresses among them."""
    rows = [(r.page_id, r.url) for r in spark.read.parquet(
        "/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()]
    rows += [(-1, None), (-2, ""), (-3, "no scheme"), (-4, "http://a.org/x"), (-4, "http://a.org/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    known = [plain_rule(*plain_parts(u)) for _, u in rows]
    labels = [k and float(k[0] == "block") for k in known]
    features = plain_features([(u, label) for (_, u), label in zip(rows, labels, strict=True)])

    table = featured(ruled(pages, RULES))
    got = {r.page_id: r for r in table.collect()}
    for (i, _), want in zip(rows, features, strict=True):
        assert [got[i][f] for f in FEATURES] == pytest.approx(want, abs=1e-9)

    model = train(table)
    printed = re.split(r"Tree \d+ \(weight ([\d.E-]+)\):\n", model.toDebugString)[1:]
    trees = [(float(weight), plain_tree([x.strip() for x in body.splitlines() if x.strip()]))
             for weight, body in zip(printed[::2], printed[1::2], strict=True)]
    assert len(trees) == model.getNumTrees
    verdicts = {(r.page_id, r.verdict) for r in filter_urls(pages, RULES).collect()}
    assert verdicts == {
        (i, k[0] if k else "block" if sum(w * t(f) for w, t in trees) > 0 else "allow")
        for (i, _), k, f in zip(rows, known, features, strict=True)}


def test_suffix_shares_come_from_other_hosts(spark):
    """Labels of one host change the share of no row of that host."""
    def shares(label):
        rows = [(i, f"http://h{i % 7}.org/{i}", label if i % 7 == 3 else float(i % 2))
                for i in range(70)]
        data = ruled(spark.createDataFrame(rows, "page_id long, url string, own double")
                     .drop("own"), RULES).drop("label").join(spark.createDataFrame(
                         [(r[0], r[2]) for r in rows], "page_id long, label double"), "page_id")
        return {(r.page_id, r.suffix_block_share) for r in featured(data).collect()
                if r.host == "h3.org"}
    assert shares(0.0) == shares(1.0) == shares(None)


def test_entropy(spark):
    rows = spark.createDataFrame([("aabb",), ("aaaa",), ("",), ("abcd",)], "t string")
    assert [round(r[0], 6) for r in rows.select(entropy(F.col("t"))).collect()] == [1, 0, 0, 2]


PAGES = [
    ("<html><head><title>t</title><style>p{}</style></head><body><nav>menu</nav><article>"
     "<h1>Head</h1><p>One&nbsp;two<br>three <b>bo</b>ld</p><div class='ad'>buy</div>"
     "<script>var x = '<p>';</script></article><footer>f</footer></body></html>",
     "Head One two three bold"),
    ("<main><p>a</p><aside>no</aside><form><p>no</p></form>b</main>", "a b"),
    ("<article><p>a<p>b</p><div id='comments'>c</div><div class='user-comment x'>c</div>"
     "<section hidden>h</section></article>d", "a b"),
    ("<div role='banner'>x</div><p>plain &lt;text&gt; &#65;&#x42;</p>", "plain <text> AB"),
    ("<article>a < b and 3 > 2 <unclosed", "a < b and 3 > 2"),
    ("<article><!-- no --><p title=\"a > b\">x</p><textarea>no</textarea></article>", "x"),
    ("<body class='with-sidebar form'><article class='post comments'>x<p class='ad-slot'>y"
     "<p class='no-ads'>z</article></body>", "x z"),
    ("<header>Site</header><article><header class='entry-header'><h1>Title</h1>By A</header>"
     "<p>x</p><div class='site-header'>no</div><footer>no</footer></article>", "Title By A x"),
    ("<form id='aspnetForm'><input><label>no</label><div class='search-page'><article><p>x</p>"
     "<form><p>no</p></form></article></div>no</form>", "x"),
    ("<div class='page-header'>no<main>y</main></div><div class='search'><p>no</p></div>", "y"),
    ("<article><section class='related-work'>a</section><div class='legal-article'>b</div>"
     "<label>c</label><div class='related-articles'>no</div><div class='alert-box'>no</div>"
     "<div class='comment-body'>no</div></article>", "a b c"),
    ("<article>x</article><div class='comments'><article class='comment'>no</article></div>"
     "<aside><article>no</article></aside><form><div id='respond'><main>no</main></div></form>",
     "x"),
    ("<article><header role='banner'>no</header><header hidden>no</header>x</article>", "x"),
    ("", ""), (None, ""), ("   ", ""), ("no tags at all", "no tags at all"),
]


def test_main_texts(spark):
    pages = spark.createDataFrame(
        [(i, f"http://h{i}.com/", h, "x", "y") for i, (h, _) in enumerate(PAGES)], SCHEMA)
    got = {r.page_id: (r.text, r.n_chars) for r in extract.main_texts(pages).collect()}
    assert got == {i: (t, len(t)) for i, (_, t) in enumerate(PAGES)}
    assert extract.main_texts(pages.limit(0)).count() == 0


def site(host, n):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        own = " ".join(f"u{rng.randrange(10**6)}" for _ in range(30))
        rows.append((i, f"http://{host}/{i}", "<div>Welcome to our site, the best one there is"
                     f" today</div><div>{own}</div><div>Call us any time on weekdays from nine"
                     " to five</div>", "x", own))
    return rows


@pytest.mark.parametrize("limit", [4 << 20, 500])
def test_repeated_runs_go_where_markup_is_silent(spark, monkeypatch, limit):
    """The same with one shard a host and with many: repeats between shards are found."""
    monkeypatch.setattr(extract, "SHARD_BYTES", limit)
    rows = site("one.com", 12)
    pages = spark.createDataFrame(rows, SCHEMA)
    got = {r.page_id: r.text for r in extract.main_texts(pages).collect()}
    assert got == {r[0]: r[4] for r in rows}


@pytest.mark.parametrize("limit", [4 << 20, 300])
def test_copies_and_quotations_are_no_boilerplate(spark, monkeypatch, limit):
    """Articles that stand twice on a host, exactly or nearly, and a quotation on two pages are
    kept; a page on its own and its copy have nothing to compare."""
    monkeypatch.setattr(extract, "SHARD_BYTES", limit)
    rows = site("one.com", 12)
    quote = "a saying of eight words or more that two of them have"
    rows[3:5] = [(*r[:2], r[2].replace(r[4], f"{r[4]} {quote}"), "x", f"{r[4]} {quote}")
                 for r in rows[3:5]]
    (_, _, page, _, own) = rows[0]
    rows += [(20 + i, f"http://one.com/copy{i}", page, "x", own) for i in range(4)]
    rows.append((30, "http://one.com/near", page.replace(own, own + " later"), "x",
                 own + " later"))
    lone = " ".join(f"v{i}" for i in range(40))
    rows += [(40 + i, f"http://two.com/{i}", f"<p>{lone}</p>", "x", lone) for i in range(2)]
    got = {r.page_id: r.text
           for r in extract.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {r[0]: r[4] for r in rows}


@pytest.mark.parametrize("limit", [4 << 20, 300])
def test_arrays_judge_named_content(spark, monkeypatch, limit):
    """A block inside article goes if it is boilerplate of the host; one that two articles share
    stays, and so does all on hosts of two pages."""
    monkeypatch.setattr(extract, "SHARD_BYTES", limit)
    notice = "Read more of our stories every day and tell all of your friends"
    shared = "a passage of eight words or more that two articles share"
    rows = []
    for host, n in (("one.com", 12), ("two.com", 2)):
        for i, (_, url, _, _, own) in enumerate(site(host, n)):
            kept = [own] + [shared] * (i < 2) + [notice] * (n == 2)
            body = "".join(f"<p>{x}</p>" for x in [own] + [shared] * (i < 2) + [notice])
            rows.append((len(rows), url, f"<article>{body}</article>", "x", " ".join(kept)))
    rows.append((99, "http://one.com/plain", f"<p>{notice}</p><p>just this</p>", "x",
                 "just this"))
    got = {r.page_id: r.text
           for r in extract.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {r[0]: r[4] for r in rows}


def test_texts_do_not_depend_on_the_size_of_shards(spark, monkeypatch):
    """Hosts whose pages all, partly or never name their content, with copies, near copies, equal
    rows and short pages, give the same texts as one shard and as many."""
    rng, rows = random.Random(4), []
    for kind, host in enumerate(("all.com", "some.com", "none.com")):
        notices = [" ".join(f"{host[:3]}{k}n{j}" for j in range(12)) for k in range(6)]
        own = [" ".join(f"u{rng.randrange(300)}" for _ in range(rng.randrange(4, 60)))
               for _ in range(30)]
        own[7:12] = [own[6], own[6] + " more", own[6].replace("u1", "v1"), own[6], ""]
        for i, text in enumerate(own):
            tag = "article" if kind == 0 or kind == 1 and i % 3 else "div"
            body = "".join(f"<p>{x}</p>" for k, x in enumerate(notices) if i % 6 >= k)
            rows.append((len(rows), f"http://{host}/{i}",
                         f"<{tag}><p>{text}</p>{body}<p>Share</p></{tag}>", "x", "y"))
    rows += rows[::7] + rows[::9]
    pages, got = spark.createDataFrame(rows, SCHEMA).repartition(3).cache(), []
    for limit in (4 << 20, 3_000, 200):
        monkeypatch.setattr(extract, "SHARD_BYTES", limit)
        got.append(sorted((r.page_id, r.text, r.n_chars)
                          for r in extract.main_texts(pages).collect()))
    assert got[0] == got[1] == got[2]
    assert any("all0n3" in r[2] for r in rows) and not any("all0n3" in x[1] for x in got[0])
    assert any("all5n3" in x[1] for x in got[0])


def dealt_pages(seed, n):
    """Parsed pages of two hosts, one in three ranges, with shared passages, copies and equal
    rows; in two batches."""
    rng, rows = random.Random(seed), []
    passages = [" ".join(f"p{k}w{j}" for j in range(20)) for k in range(5)]
    for i in range(n):
        own = " ".join(f"u{rng.randrange(10**6)}" for _ in range(200))
        texts = rows[-1]["texts"] if i % 9 == 8 else [own, *rng.sample(passages, i % 4)]
        host, parts = (("a.com", 3), ("b.com", 1))[i % 5 == 0]
        rows.append({"host": host, "parts": parts, "least": 12, "salt": parts * 77,
                     "page_key": rng.randrange(-2**63, 2**63), "texts": texts})
    rows += rows[::6] + [dict(rows[0], page_key=5, texts=[]), dict(rows[1], page_key=6, texts=[])]
    schema = pa.schema([("host", pa.string()), ("parts", pa.int64()), ("least", pa.int64()),
                        ("salt", pa.int64()), ("page_key", pa.int64()),
                        ("texts", pa.list_(pa.string()))])
    return [pa.RecordBatch.from_pylist(part, schema) for part in (rows[:n // 2], rows[n // 2:])]


def test_windows_of_large_hosts_travel_packed(monkeypatch):
    """Many pages share a row, which costs less than ten bytes for a window; what is compared in
    ranges is what a plain count finds."""
    batches = dealt_pages(3, 300)
    on = defaultdict(set)
    for part in batches:
        row, window = extract.hashed_windows(part)
        for i, w in zip(row.tolist(), window.tolist(), strict=True):
            r = part.slice(i, 1).to_pylist()[0]
            on[r["host"], w].add(r["page_key"])
    of_page = Counter(k for (_, w), keys in on.items() if len(keys) < 12 for k in keys)
    pairs = Counter((k, min(keys)) for keys in on.values() if 1 < len(keys) < 12
                    for k in keys if k != min(keys))
    want = {(host, w - (w >> 63 << 64), k, len(keys), min(keys), len(keys) < 12)
            for (host, w), keys in on.items() if len(keys) > 1 for k in keys}
    copies = {(k, hub) for (k, hub), n in pairs.items() if n * 100 >= of_page[k] * 80}
    for pages in (extract.DEALT_PAGES, 40):
        monkeypatch.setattr(extract, "DEALT_PAGES", pages)
        got, near, packed, rows = [], set(), b"", 0
        for turn in range(extract.ROUNDS):
            dealt = pa.Table.from_batches(list(extract.deal(turn, iter(batches))))
            packed += b"".join(r[c] for r in dealt.to_pylist() for c in ("keys", "pages", "gaps"))
            rows += dealt.num_rows
            for host, part in {(r["host"], r["part"]) for r in dealt.to_pylist()}:
                mine = dealt.filter((pc.field("host") == host)
                                    & (pc.field("part") == part))
                for r in extract.compare(mine).to_pylist():
                    got.append((host, r["window"], r["page_key"], r["n"], r["hub"], r["rare"]))
                    if r["near"]:
                        near.add((r["page_key"], r["hub"]))
        assert len(got) == len(set(got)) and set(got) == want
        assert copies and copies <= near
        if pages > 40:
            assert rows <= 2 * 4 * extract.ROUNDS
            assert len(zlib.compress(packed, 1)) < 10 * sum(map(len, on.values()))


def test_extraction_on_odd_rows(odd_pages):
    got = extract.main_texts(odd_pages).collect()
    assert len(got) == 8
    assert [r.text for r in got if r.page_id == 5] == ["AB & C D"] * 2
    assert [r.n_chars for r in got if r.page_id == 6] == [len("long " + "word " * 50_000) - 1]
