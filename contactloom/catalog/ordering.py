"""Sources, dedupe, quotas, slices, set operations and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from contactloom import rules
from contactloom.catalog.base import (cards, dns_answers, evidence_rows, query, read, read_texts,
                                      registry,
                                      site_pages, sql_any, sql_list, store)
from contactloom.functions import domains, emails
from contactloom.functions.text import contains_any
from contactloom.operators import classify, contacts, extract, rank
from contactloom.plans import flows
from contactloom.session import scratch_path
from contactloom.sources import readers, sinks


# --------------------------------------------------------------------- classification
def _keywords(text: str, table, default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {sql_any(text, terms)} THEN '{category}'"
                              for category, terms in table) + f" ELSE {default} END"


def _strict(text: str, default: str = "NULL") -> str:
    over = " ".join(f"WHEN {sql_any(text, terms)} THEN '{category}'"
                    for category, terms in rules.BRAND_OVERRIDES)
    rest = " ".join(f"WHEN {sql_any(text, inc)} AND NOT {sql_any(text, exc)} THEN '{category}'"
                    for category, inc, exc in rules.STRICT_RULES)
    return f"CASE {over} {rest} ELSE {default} END"


GENERAL = f"'{rules.GENERAL}'"
_KNOWN = "(" + ", ".join(f"'{c}'" for c in rules.CATEGORIES) + ")"
_REGISTRY_TEXT = "lower(domain || ' ' || brand || ' ' || tags || ' ' || tech)"


def _registry_text():
    return classify.joined_text("domain", "brand", "tags", "tech")


@query("classify_strict", f"""
SELECT seq, {_strict('t', GENERAL)} AS niche FROM (SELECT seq, {_REGISTRY_TEXT} AS t FROM registry)""",
       uses="registry")
def _(spark, sf):
    return registry(spark, sf).select(
        "seq", classify.classify(_registry_text(), "strict").alias("niche"))


@query("classify_strict_documents", f"""
SELECT doc_id, {_strict('lower(text)', GENERAL)} AS niche FROM documents""")
def _(spark, sf):
    return read_texts(spark, sf, "documents").select(
        "doc_id", classify.classify(F.lower("text"), "strict").alias("niche"))


@query("classify_with_fallback", f"""
SELECT seq, coalesce(nullif({_strict('t', GENERAL)}, {GENERAL}),
  {_keywords('t', rules.FALLBACK_KEYWORDS)}, CASE WHEN cur IN {_KNOWN} THEN cur END, {GENERAL})
  AS niche
FROM (SELECT seq, {_REGISTRY_TEXT} AS t,
        CASE seq % 3 WHEN 0 THEN 'Jewelry' WHEN 1 THEN 'Other' END AS cur FROM registry)""",
       uses="registry")
def _(spark, sf):
    third = F.pmod("seq", F.lit(3))
    current = F.when(third == 0, "Jewelry").when(third == 1, "Other")
    return registry(spark, sf).select("seq", classify.classify(
        _registry_text(), "strict_fallback", current).alias("niche"))


@query("classify_keep_initial", f"""
SELECT seq, coalesce(nullif({_strict('t', GENERAL)}, {GENERAL}), cur, {GENERAL}) AS niche
FROM (SELECT seq, {_REGISTRY_TEXT} AS t,
        CASE seq % 3 WHEN 0 THEN 'Jewelry' WHEN 1 THEN 'Other' END AS cur FROM registry)""",
       uses="registry")
def _(spark, sf):
    third = F.pmod("seq", F.lit(3))
    current = F.when(third == 0, "Jewelry").when(third == 1, "Other")
    return registry(spark, sf).select("seq", classify.classify(
        _registry_text(), "strict_initial", current).alias("niche"))


@query("classify_harvest", f"""
SELECT seq, coalesce({_keywords('t', rules.HARVEST_KEYWORDS)}, cur, {GENERAL}) AS harvest,
  coalesce({_keywords('t', rules.HARVEST_KEYWORDS)}, CASE WHEN cur IN {_KNOWN} THEN cur END,
    {GENERAL}) AS turbo
FROM (SELECT seq, lower(brand || ' ' || domain) AS t,
        CASE seq % 3 WHEN 0 THEN 'Jewelry' WHEN 1 THEN 'Other' END AS cur FROM registry)""",
       uses="registry")
def _(spark, sf):
    third = F.pmod("seq", F.lit(3))
    current = F.when(third == 0, "Jewelry").when(third == 1, "Other")
    text = classify.joined_text("brand", "domain")
    return registry(spark, sf).select(
        "seq", classify.classify(text, "harvest", current).alias("harvest"),
        classify.classify(text, "turbo", current).alias("turbo"))


@query("classify_inline", f"""
SELECT seq, {_keywords('t', rules.INLINE_KEYWORDS, GENERAL)} AS niche
FROM (SELECT seq, {_REGISTRY_TEXT} AS t FROM registry)""", uses="registry")
def _(spark, sf):
    return registry(spark, sf).select(
        "seq", classify.classify(_registry_text(), "inline").alias("niche"))


def _page_case(text: str, table, field: int, default: str) -> str:
    return "CASE " + " ".join(
        "WHEN {} THEN '{}'".format(sql_any(text, row[2]), row[field]) for row in table
    ) + f" ELSE {default} END"


@query("classify_page_text", f"""
SELECT page_id, {_page_case('t', rules.PAGE_KEYWORDS, 0, "'Fashion & Apparel'")} AS niche,
  {_page_case('t', rules.PAGE_KEYWORDS, 1, "'Apparel & Streetwear'")} AS sub_niche
FROM (SELECT page_id, lower(html || ' ' || domain) AS t FROM site_pages)""", uses="site_pages")
def _(spark, sf):
    text = classify.joined_text("html", "domain")
    return site_pages(spark, sf).select("page_id", classify.classify_page(text).alias("c")
                                        ).select("page_id", "c.*")


@query("classify_page_text_ranked", f"""
SELECT page_id, {_page_case('t', rules.RANKED_PAGE_KEYWORDS, 0, "cur")} AS niche,
  {_page_case('t', rules.RANKED_PAGE_KEYWORDS, 1, "cur || ' Goods'")} AS sub_niche
FROM (SELECT page_id, lower(title || ' ' || domain) AS t,
        CASE page_id % 2 WHEN 0 THEN 'Jewelry' ELSE 'Extended DTC' END AS cur
      FROM (SELECT page_id, domain, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title
            FROM site_pages))""", uses="site_pages")
def _(spark, sf):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    current = F.when(F.pmod("page_id", F.lit(2)) == 0, "Jewelry").otherwise("Extended DTC")
    return site_pages(spark, sf).select("page_id", classify.classify_page(
        classify.joined_text(title, "domain"), "ranked_page", current).alias("c")).select(
        "page_id", "c.*")


@query("classify_registry", f"""
SELECT seq, {_keywords('t', rules.REGISTRY_KEYWORDS)} AS niche
FROM (SELECT seq, {_REGISTRY_TEXT} AS t FROM registry)""", uses="registry")
def _(spark, sf):
    return registry(spark, sf).select(
        "seq", classify.classify(_registry_text(), "registry").alias("niche"))


_RANKED_CASE = (f"coalesce({_keywords('d', rules.RANKED_KEYWORDS)}, "
                f"CASE WHEN {sql_any('d', rules.RANKED_INDICATORS)} THEN {GENERAL} END)")


def _ranked(spark, sf):
    return registry(spark, sf).select(
        (F.col("seq") + 1).alias("rank"),
        F.lower(F.concat(F.replace("brand", F.lit(" "), F.lit("-")), F.lit("-"),
                         F.replace("tags", F.lit(" "), F.lit("-")), F.lit("."),
                         F.when(F.pmod("seq", F.lit(9)) == 0, "org").otherwise("com")))
        .alias("domain"))


_RANKED_SQL = """SELECT seq + 1 AS rank, lower(replace(brand, ' ', '-') || '-'
  || replace(tags, ' ', '-') || '.' || CASE WHEN seq % 9 = 0 THEN 'org' ELSE 'com' END) AS d
  FROM registry"""


@query("classify_ranked_domains", f"""
SELECT rank, d AS domain, {_RANKED_CASE} AS niche FROM ({_RANKED_SQL})""", uses="registry")
def _(spark, sf):
    return _ranked(spark, sf).select(
        "rank", "domain", classify.classify(F.col("domain"), "ranked").alias("niche"))


@query("classify_whole_words", f"""
SELECT seq, regexp_matches(t, '\\b(ring|bag|hat|tea|pet)\\b') AS token,
  {sql_any('t', ('ring', 'bag', 'hat', 'tea', 'pet'))} AS substring
FROM (SELECT seq, {_REGISTRY_TEXT} AS t FROM registry)""", uses="registry")
def _(spark, sf):
    from contactloom.functions.text import contains_token

    terms = ("ring", "bag", "hat", "tea", "pet")
    return registry(spark, sf).select(
        "seq", contains_token(_registry_text(), terms).alias("token"),
        contains_any(_registry_text(), terms).alias("substring"))


# ------------------------------------------------------------------------- filters
@query("required_keys", """
SELECT seq, lower(trim(email)) AS email FROM store
WHERE contains(email, '@') AND contains(domain, '.')""", uses="store")
def _(spark, sf):
    return contacts.require_domain(contacts.require(store(spark, sf))).select("seq", "email")


@query("ranked_domain_filter", f"""
SELECT rank, d AS domain FROM ({_RANKED_SQL})
WHERE NOT regexp_matches(d, '\\.(edu|gov|mil|org|int|cn|ru|ir)$')
  AND NOT {sql_any('d', rules.RANKED_DENIED_TERMS)}""", uses="registry")
def _(spark, sf):
    return _ranked(spark, sf).where(classify.ranked_domain_ok("domain"))


@query("keyword_any_match", f"""
SELECT seq, domain FROM registry WHERE {sql_any(_REGISTRY_TEXT, rules.REGISTRY_KEYWORDS[1][1])}""",
       uses="registry")
def _(spark, sf):
    return contacts.has_keyword(registry(spark, sf), ["domain", "brand", "tags", "tech"],
                                rules.REGISTRY_KEYWORDS[1][1]).select("seq", "domain")


@query("pages_fetched_well", """
SELECT page_id, status, status = 200 AS exact FROM site_pages
WHERE status < 400 AND length(html) > 250""", uses="site_pages")
def _(spark, sf):
    from contactloom.operators.audit import ok_pages

    return ok_pages(site_pages(spark, sf), floor=250).select(
        "page_id", "status", (F.col("status") == 200).alias("exact"))


@query("company_register_gate", f"""
SELECT seq, domain, key FROM (SELECT seq, domain, regexp_replace(regexp_replace(owner || '.com',
    '(?i)\\.(com|net|org|store|shop|co|io)$', ''), '[^a-zA-Z0-9]', '', 'g') AS key FROM store)
WHERE length(key) >= 5 AND NOT {' AND NOT '.join(f"ends_with(domain, '{s}')" for s in rules.GATE_SUFFIXES)}""",
       uses="store")
def _(spark, sf):
    from contactloom.operators.people import registry_gate

    rows = store(spark, sf).withColumn("brand", F.concat("owner", F.lit(".com")))
    return registry_gate(rows, ("shop",)).select("seq", "domain",
                                                 domains.brand_key("brand").alias("key"))


# ------------------------------------------------------------------ sources and sinks
@query("alias_registry_columns", """
SELECT seq, lower(replace(replace(d, 'https://', ''), 'http://', '')) AS domain, brand
FROM (SELECT seq, CASE seq % 3 WHEN 0 THEN domain WHEN 1 THEN 'https://' || domain END AS d, brand
      FROM registry)
WHERE d IS NOT NULL""", uses="registry")
def _(spark, sf):
    third = F.pmod("seq", F.lit(3))
    raw = registry(spark, sf).select(
        "seq", F.when(third == 0, F.col("domain")).otherwise("").alias("Domain"),
        F.when(third == 1, F.concat(F.lit("https://"), "domain")).alias("url"),
        F.col("brand").alias("merchant_name"))
    return readers.alias_registry(raw).select("seq", "domain", "brand")


@query("registry_csv_round_trip", """
SELECT domain, brand, tech, employees, source_prio FROM registry""", uses="registry")
def _(spark, sf):
    rows = registry(spark, sf).select(
        "domain", F.col("brand").alias("merchant_name"), "tags",
        F.col("tech").alias("technologies"), F.col("employees").alias("employee_count_bucket"),
        "source_prio")
    paths = []
    for prio in (0, 1):
        path = scratch_path(spark, f"registry-{prio}")
        out = rows.where(F.col("source_prio") == prio).drop("source_prio")
        out.write.option("header", True).option(
            "compression", "gzip" if prio else "none").csv(path)
        paths.append(path)
    return readers.read_registry(spark, paths).select("domain", "brand", "tech", "employees",
                                                      "source_prio")


@query("ranked_list_scan", f"""
SELECT rank, d AS domain FROM ({_RANKED_SQL})""", uses="registry")
def _(spark, sf):
    path = scratch_path(spark, "ranked")
    rows = _ranked(spark, sf).withColumn("domain", F.upper("domain"))
    rows.write.option("header", False).csv(path)
    return readers.read_ranked(spark, path)


@query("lines_to_domains", """
SELECT page_id, split_part(replace(replace(replace(lower(trim(url)), 'https://', ''),
  'http://', ''), 'www.', ''), '/', 1) AS domain FROM pages""")
def _(spark, sf):
    lines = read(spark, sf, "pages").select("page_id", F.concat(
        F.upper("url"), F.lit(",x,1")).alias("value"))
    return readers.lines_to_domains(lines).select("page_id", "domain")


@query("first_nonempty_source", "SELECT seq, domain FROM registry", uses="registry")
def _(spark, sf):
    rows = registry(spark, sf).select("seq", "domain")
    return rank.first_nonempty(rows.where("domain IS NULL"), rows, rows.limit(1))


def _contact_files(spark, sf):
    """Three contact files that overlap: stores, suppliers, stores in capitals."""
    base = store(spark, sf)
    suppliers = read(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("seq"), F.concat(
            F.lit("info@shop"), F.col("s_suppkey").cast("string"), F.lit(".com")).alias("email"),
        F.col("s_name").alias("company"))
    one = base.select("seq", "email", F.lit("").alias("company"), "domain",
                      F.col("owner").alias("title"))
    three = base.select("seq", F.upper("email").alias("email"), F.col("brand").alias("company"))
    return [one, suppliers, three]


_FILES_SQL = """
SELECT 0 AS file_prio, seq, lower(trim(email)) AS email, '' AS company, domain, owner AS title
  FROM store
UNION ALL SELECT 1, s_suppkey, 'info@shop' || s_suppkey || '.com', s_name, NULL, NULL FROM supplier
UNION ALL SELECT 2, seq, lower(trim(email)), brand, NULL, NULL FROM store"""


@query("first_wins_over_files", f"""
SELECT email, file_prio, seq, company FROM ({_FILES_SQL})
QUALIFY row_number() OVER (PARTITION BY email ORDER BY file_prio, seq) = 1""", uses="store")
def _(spark, sf):
    frames = [contacts.require(f) for f in _contact_files(spark, sf)]
    return readers.scan_ordered(frames).select("email", "file_prio", "seq", "company")


@query("union_of_files", f"SELECT file_prio, seq, email, company, title FROM ({_FILES_SQL})",
       uses="store")
def _(spark, sf):
    stacked = contacts.require(rank.union_sources(*_contact_files(spark, sf), prio="file_prio"))
    return stacked.select("file_prio", "seq", "email", "company", "title")


@query("slice_scan", """
SELECT domain, slice FROM (SELECT domain, CAST(seq % 10 AS INTEGER) AS slice FROM registry)
WHERE slice IN (2, 5)""", uses="registry")
def _(spark, sf):
    path = scratch_path(spark, "slices")
    numbered = registry(spark, sf).withColumn("position", F.col("seq") + 1)
    (rank.slices(numbered, 10, position="position").write.partitionBy("slice").parquet(path))
    return readers.read_slices(spark, path, [2, 5]).select("domain", "slice")


@query("items_to_contacts", """
SELECT CASE WHEN seq % 4 = 0 THEN 'Founder' ELSE split_part(owner, ' ', 1) END AS first_name,
  CASE WHEN seq % 4 = 0 THEN '' ELSE split_part(owner, ' ', 2) END AS last_name,
  trim(email) AS email, brand AS company, 'https://' || domain AS website
FROM store WHERE seq % 5 <> 0""", uses="store")
def _(spark, sf):
    even = F.pmod("seq", F.lit(2)) == 0
    items = store(spark, sf).select(
        F.when(even, F.concat(F.lit("https://www."), "domain", F.lit("/x"))).alias("website"),
        F.when(~even, F.col("domain")).alias("domain"),
        F.when(F.pmod("seq", F.lit(5)) == 0, "not an address").when(even, F.trim("email"))
        .alias("email"),
        F.when(~even, F.trim("email")).alias("contact_email"),
        F.when(F.pmod("seq", F.lit(4)) != 0, F.col("owner")).alias("founder_name"),
        F.col("brand").alias("brand_name"))
    path = scratch_path(spark, "items")
    items.write.json(path)
    return contacts.items_to_contacts(readers.read_items(spark, path)).select(
        "first_name", "last_name", "email", "company", "website")


@query("keys_already_done", "SELECT DISTINCT l_suppkey, l_partkey FROM lineitem")
def _(spark, sf):
    return rank.done_keys(read(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"])


@query("worker_progress_files", """
SELECT user_id AS worker_id, count(*) AS scanned, count(*) FILTER (WHERE event_type = 'purchase')
  AS found FROM events GROUP BY user_id""")
def _(spark, sf):
    path = scratch_path(spark, "progress")
    rows = read(spark, sf, "events").groupBy(F.col("user_id").cast("int").alias("worker_id")).agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("event_type") == "purchase").alias("found"))
    rows.write.json(path)
    return readers.read_progress(spark, path, one_each=False).select(
        "worker_id", "scanned", "found")


@query("brand_registry_head", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 50")
def _(spark, sf):
    return readers.brand_registry(read(spark, sf, "part"), 50, "p_partkey").select(
        "p_partkey", "p_name")


@query("master_by_category", f"""
SELECT niche, count(*) AS n FROM (
  SELECT coalesce({_keywords('t', rules.REGISTRY_KEYWORDS)}, {GENERAL}) AS niche
  FROM (SELECT {_REGISTRY_TEXT} AS t FROM registry)) GROUP BY niche""", uses="registry")
def _(spark, sf):
    path = scratch_path(spark, "niches")
    rows = registry(spark, sf).withColumn(
        "niche", F.coalesce(classify.classify(_registry_text(), "registry"), F.lit("Other")))
    sinks.write_by_category(rows, path)
    return spark.read.parquet(path).groupBy("niche").agg(F.count(F.lit(1)).alias("n"))


@query("export_profile_upload", """
SELECT split_part(owner, ' ', 1) AS first_name, split_part(owner, ' ', 2) AS last_name,
  trim(email) AS email, brand AS company, 'https://' || domain AS website, '' AS title,
  '' AS ads_url, '' AS niche, '' AS country, '' AS note FROM store""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).select(
        F.split_part("owner", F.lit(" "), F.lit(1)).alias("first_name"),
        F.split_part("owner", F.lit(" "), F.lit(2)).alias("last_name"),
        F.trim("email").alias("email"), F.col("brand").alias("company"),
        F.concat(F.lit("https://"), "domain").alias("website"),
        F.lit(None).cast("string").alias("niche"))
    return contacts.project_profile(rows, "upload", headers=False)


@query("export_profile_hashed", """
SELECT sha256(lower(trim(email))) AS email, sha256(lower(split_part(owner, ' ', 1))) AS first_name,
  brand AS company FROM store""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).select(
        F.split_part("owner", F.lit(" "), F.lit(1)).alias("first_name"),
        F.trim("email").alias("email"), F.col("brand").alias("company"))
    return contacts.project_profile(rows, "master", pii="hash", headers=False).select(
        "email", "first_name", "company")


@query("master_file", """
SELECT sha256(lower(split_part(owner, ' ', 1))) AS first_name,
  sha256(lower(trim(email))) AS email, brand AS company FROM store""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).select(
        F.split_part("owner", F.lit(" "), F.lit(1)).alias("first_name"),
        F.trim("email").alias("email"), F.col("brand").alias("company"))
    path = scratch_path(spark, "master")
    sinks.write_master(rows, path, pii="hash")
    back = spark.read.option("header", True).csv(path)
    names = {c.lower().replace(" ", "_"): c for c in back.columns}
    return back.select(*[F.col(f"`{names[n]}`").alias(n)
                         for n in ("first_name", "email", "company")])


@query("batch_files", """
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 2000 + 1 AS batch
FROM orders""")
def _(spark, sf):
    path = scratch_path(spark, "batches")
    sinks.write_batches(read(spark, sf, "orders").select("o_orderkey", "o_orderdate"), path,
                        ["o_orderdate", "o_orderkey"])
    return spark.read.parquet(path).select("o_orderkey", F.col("batch").cast("long"))


@query("malformed_rows_dropped", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0""")
def _(spark, sf):
    path = scratch_path(spark, "rows")
    short = F.pmod("c_custkey", F.lit(3)) == 0
    read(spark, sf, "customer").select(F.when(short, F.col("c_custkey").cast("string")).otherwise(
        F.concat_ws(",", "c_custkey", "c_name"))).write.text(path)
    return readers.drop_malformed(spark, path, "c_custkey STRING, c_name STRING").select(
        F.col("c_custkey").cast("long"), "c_name")


@query("append_enrichment_columns", """
SELECT *, md5(lower(trim(email))) AS address_hash FROM store""", uses="store")
def _(spark, sf):
    return contacts.append_columns(store(spark, sf), address_hash=emails.email_hash("email"))


@query("numbered_batches", """
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 2000 + 1 AS batch
FROM orders""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return rank.batch_no(rows, rules.BATCH_ROWS, ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "batch")


# ------------------------------------------------------- dedupe, quotas, slices, limits
@query("first_wins_by_key", """
SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber) = 1""")
def _(spark, sf):
    rows = read(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber",
                                              "l_shipdate")
    return rank.first_wins(rows, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"]
                           ).drop("l_shipdate")


@query("exclude_seen_documents", """
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "source")
    return rank.exclude_seen(docs, read(spark, sf, "labels"), ["doc_id"])


@query("exclude_seen_pairs", """
SELECT DISTINCT l_partkey, l_suppkey FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_partkey = l.l_partkey
    AND r.l_suppkey = l.l_suppkey)""")
def _(spark, sf):
    li = read(spark, sf, "lineitem")
    pairs = li.select("l_partkey", "l_suppkey").distinct()
    return rank.exclude_seen(pairs, li.where("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"])


@query("top_candidates_by_score", """
SELECT o_custkey, o_orderkey, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderdate, o_orderkey)
    AS rank FROM orders) WHERE rank <= 3""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("email"), F.col("o_totalprice").alias("score"),
        F.struct("o_orderdate", "o_orderkey").alias("pos"))
    return rank.top_candidates(rows, "o_custkey", 3).select(
        "o_custkey", F.col("email").alias("o_orderkey"), "rank")


@query("top_candidates_in_order", """
SELECT o_custkey, o_orderkey, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rank
  FROM orders) WHERE rank <= 3""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("email"), F.col("o_totalprice").alias("score"),
        F.struct("o_orderdate", "o_orderkey").alias("pos"))
    return rank.top_candidates(rows, "o_custkey", 3, by="pos").select(
        "o_custkey", F.col("email").alias("o_orderkey"), "rank")


@query("stop_after_top_score", """
SELECT o_custkey, o_orderkey FROM (SELECT *, min(CASE WHEN o_orderpriority = '1-URGENT'
    THEN o_orderdate END) OVER (PARTITION BY o_custkey) AS stop FROM orders)
WHERE stop IS NULL OR o_orderdate <= stop""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("path_no"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 100).otherwise(60).alias("score"))
    return rank.stop_at_score(rows, "o_custkey").select("o_custkey", "o_orderkey")


@query("quota_per_category", f"""
SELECT niche, seq, niche_rank FROM (
  SELECT niche, seq, row_number() OVER (PARTITION BY niche ORDER BY source_prio, seq) AS niche_rank
  FROM (SELECT seq, source_prio, {_keywords('t', rules.REGISTRY_KEYWORDS)} AS niche
        FROM (SELECT *, {_REGISTRY_TEXT} AS t FROM registry)) WHERE niche IS NOT NULL)
WHERE niche_rank <= 100""", uses="registry")
def _(spark, sf):
    rows = registry(spark, sf).withColumn("niche", classify.classify(
        _registry_text(), "registry")).where("niche IS NOT NULL")
    return rank.quota(rows, "niche", 100, ["source_prio", "seq"]).select(
        "niche", "seq", "niche_rank")


_SPILL_ORDER = [c for c, _ in rules.REGISTRY_KEYWORDS]
_SPILL_FITS = ", ".join(f"CASE WHEN {sql_any('t', terms)} THEN '{c}' END"
                        for c, terms in rules.REGISTRY_KEYWORDS)


# the SQL walks row by row: first fitting category with room, taken domains are skipped
@query("quota_with_spill", f"""
WITH RECURSIVE numbered AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY source_prio, seq) AS i, domain, seq,
    list_filter([{_SPILL_FITS}], lambda x: x IS NOT NULL) AS fits
  FROM (SELECT *, {_REGISTRY_TEXT} AS t FROM registry)),
walk AS (
  SELECT 0::BIGINT AS i, ''::VARCHAR AS domain, 0::BIGINT AS seq, NULL::VARCHAR AS niche,
    MAP {{{', '.join(f"'{c}': 0" for c in _SPILL_ORDER)}}} AS used, []::VARCHAR[] AS taken
  UNION ALL
  SELECT i, domain, seq, niche, CASE WHEN niche IS NULL THEN used ELSE map_from_entries(
      list_transform(map_entries(used), lambda e: {{'k': e.key,
        'v': e.value + CASE WHEN e.key = niche THEN 1 ELSE 0 END}})) END,
    CASE WHEN niche IS NULL THEN taken ELSE list_append(taken, domain) END
  FROM (SELECT n.i, n.domain, n.seq, w.used, w.taken,
          CASE WHEN list_contains(w.taken, n.domain) THEN NULL
            ELSE list_filter(n.fits, lambda c: w.used[c] < 100)[1] END AS niche
        FROM walk w JOIN numbered n ON n.i = w.i + 1))
SELECT domain, seq, niche FROM walk WHERE niche IS NOT NULL""", uses="registry")
def _(spark, sf):
    picked = rank.quota_with_spill(
        registry(spark, sf), classify.registry_matches(_registry_text()), 100, "domain",
        ["source_prio", "seq"])
    return picked.select("domain", "seq", "niche")


@query("interleaved_categories", f"""
SELECT seq, niche, row_number() OVER (ORDER BY r, place) AS position FROM (
  SELECT seq, niche, row_number() OVER (PARTITION BY niche ORDER BY source_prio, seq) AS r,
    list_position({sql_list(rules.CATEGORIES)}, niche) AS place
  FROM (SELECT *, {_keywords('t', rules.REGISTRY_KEYWORDS)} AS niche
        FROM (SELECT *, {_REGISTRY_TEXT} AS t FROM registry)) WHERE niche IS NOT NULL)""",
       uses="registry")
def _(spark, sf):
    rows = registry(spark, sf).withColumn("niche", classify.classify(
        _registry_text(), "registry"))
    return rank.interleave(rows, "niche", rules.CATEGORIES, ["source_prio", "seq"]).select(
        "seq", "niche", "position")


@query("round_robin_slices", """
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) % 10 AS slice FROM orders""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select("o_orderkey")
    placed = rank.running_rank(rows, ["o_orderkey"], name="position")
    return rank.slices(placed, 10, position="position").select("o_orderkey", "slice")


@query("hash_slices", """
SELECT o_orderkey, CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT % 10
  AS INTEGER) AS slice FROM orders""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select("o_orderkey")
    return rank.slices(rows, 10, key="o_orderkey")


@query("work_list_order", f"""
SELECT domain, niche, row_number() OVER (ORDER BY list_position({sql_list(rules.RANKED_ORDER)}, niche),
  rank) AS work_no
FROM (SELECT d AS domain, min(rank) AS rank, {_RANKED_CASE} AS niche FROM ({_RANKED_SQL}) GROUP BY d)
WHERE niche IS NOT NULL""", uses="registry")
def _(spark, sf):
    rows = _ranked(spark, sf).withColumn("niche", classify.classify(F.col("domain"), "ranked"))
    unique = rank.first_wins(rows.where("niche IS NOT NULL"), ["domain"], ["rank"])
    return rank.prioritise(unique, "niche", rules.RANKED_ORDER, "rank").select(
        "domain", "niche", "work_no")


@query("target_cap", """
SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100""")
def _(spark, sf):
    rows = read(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return rank.limit_ranked(rows, 100, [F.col("c_acctbal").desc(), "c_custkey"])


@query("personal_first", """
SELECT doc_id, email, row_number() OVER (PARTITION BY domain ORDER BY
  contains(split_part(email, '@', 1), '.') DESC, pos) AS rank
FROM (SELECT domain, min(doc_id) AS doc_id, min(doc_id) AS pos, lower(f) || '@' || domain AS email
      FROM (SELECT domain, doc_id, regexp_extract(text, 'Founded by (\\w+)', 1) AS f FROM cards)
      WHERE f <> '' GROUP BY domain, f)""", uses="cards")
def _(spark, sf):
    found = extract.card_emails(cards(spark, sf), "text", "domain", ["doc_id"])
    found = found.withColumn("pos", F.col("doc_id"))
    return rank.top_candidates(found, "domain", None, by="personal").select(
        "doc_id", "email", "rank")


@query("best_mail_host", """
SELECT domain, rtrim(arg_min(data, pref * 1000000 + hash_place), '.') AS mx_host FROM (
  SELECT domain, data, pref, row_number() OVER (PARTITION BY domain ORDER BY pref, data) AS hash_place
  FROM dns_answers WHERE rtype = 'MX') GROUP BY domain""", uses="dns_answers")
def _(spark, sf):
    from contactloom.operators.match import collapse_dns

    return collapse_dns(dns_answers(spark, sf)).where("has_mx").select("domain", "mx_host")


@query("distinct_in_order", """
SELECT conv_id, string_agg(role, ' ' ORDER BY first_turn) AS roles FROM (
  SELECT conv_id, role, min(turn) AS first_turn FROM conversations GROUP BY conv_id, role)
GROUP BY conv_id""")
def _(spark, sf):
    turns = read(spark, sf, "conversations").select("conv_id", "turn", "role")
    unique = rank.first_wins(turns, ["conv_id", "role"], ["turn"])
    listed = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return unique.groupBy("conv_id").agg(F.array_join(
        F.transform(listed, lambda s: s["role"]), " ").alias("roles"))


@query("first_mentions_joined", """
SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ', ' ORDER BY o_orderkey) AS items FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r
  FROM orders) WHERE r <= 10 GROUP BY o_custkey""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return rank.top_list(rows, "o_custkey", "o_orderkey", 10, ["o_orderkey"])


@query("sibling_addresses", """
SELECT o_custkey, o_orderkey, (SELECT string_agg(k, '; ' ORDER BY r) FROM (
    SELECT CAST(i.o_orderkey AS VARCHAR) AS k, row_number() OVER (ORDER BY i.o_orderkey) AS r
    FROM orders i WHERE i.o_custkey = o.o_custkey AND i.o_orderkey <> o.o_orderkey) WHERE r <= 3)
  AS secondary_email FROM orders o""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").cast("string")
                                            .alias("email"), F.col("o_orderkey").alias("pos"))
    out = rank.siblings(rows, "o_custkey", "email", 3)
    return out.select("o_custkey", F.col("pos").alias("o_orderkey"),
                      F.nullif("secondary_email", F.lit("")).alias("secondary_email"))


@query("sibling_rows", """
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rank
FROM orders""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return rank.sibling_rows(rows, "o_custkey", "o_orderkey", ["o_orderkey"])


# ------------------------------------------------------------------ set operations
@query("distinct_domains_across_sources", r"""
SELECT DISTINCT domain FROM (SELECT domain FROM site_pages UNION ALL SELECT domain FROM store
  UNION ALL SELECT domain FROM registry)""", uses="site_pages store registry")
def _(spark, sf):
    stacked = rank.union_sources(*[f(spark, sf).select("domain")
                                   for f in (site_pages, store, registry)])
    return rank.first_wins(stacked, ["domain"], ["source_prio"]).select("domain")


@query("except_present", """
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 450000""")
def _(spark, sf):
    big = read(spark, sf, "orders").where("o_totalprice > 450000").select(
        F.col("o_custkey").alias("c_custkey"))
    return rank.exclude_seen(read(spark, sf, "customer").select("c_custkey"), big, ["c_custkey"])


# ------------------------------------------------------------------ end-to-end flows
@query("registry_work_list", f"""
SELECT domain, niche, position, CAST((position - 1) % 10 AS INTEGER) AS slice FROM (
  SELECT domain, niche, row_number() OVER (ORDER BY r, place) AS position FROM (
    SELECT domain, niche, row_number() OVER (PARTITION BY niche ORDER BY source_prio, seq) AS r,
      list_position({sql_list([c for c, _ in rules.REGISTRY_KEYWORDS])}, niche) AS place
    FROM (SELECT * FROM (SELECT *, {_keywords('t', rules.REGISTRY_KEYWORDS)} AS niche
            FROM (SELECT *, {_REGISTRY_TEXT} AS t FROM registry)
            WHERE domain NOT IN (SELECT 'item-' || s_suppkey || '.com' FROM supplier))
          WHERE niche IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY domain ORDER BY source_prio, seq) = 1))
  WHERE r <= 200)""", uses="registry")
def _(spark, sf):
    seen = read(spark, sf, "supplier").select(F.concat(
        F.lit("item-"), F.col("s_suppkey").cast("string"), F.lit(".com")).alias("domain"))
    return flows.registry_to_work_list(registry(spark, sf), seen, 200, spill=False).select(
        "domain", "niche", "position", "slice")


@query("consolidated_master", f"""
SELECT email, company, website, first_name, last_name, title, mx_status,
  coalesce(nullif({_strict('t', GENERAL)}, {GENERAL}), {_keywords('t', rules.FALLBACK_KEYWORDS)},
    {GENERAL}) AS niche
FROM (SELECT email, company, website, first_name, 'Founder' AS last_name, title,
        'unknown' AS mx_status, lower(company || ' ' || website || ' ' || email) AS t
  FROM (SELECT email, company, CASE WHEN domain IS NULL THEN '' ELSE 'https://' || domain END
          AS website, upper(left(split_part(email, '@', 1), 1))
          || substr(split_part(email, '@', 1), 2) AS first_name,
          coalesce(title, 'Founder / Owner') AS title
        FROM ({_FILES_SQL})
        QUALIFY row_number() OVER (PARTITION BY email ORDER BY file_prio, seq) = 1))""",
       uses="store")
def _(spark, sf):
    return flows.consolidate(_contact_files(spark, sf)).select(
        "email", "company", "website", "first_name", "last_name", "title", "mx_status", "niche")


@query("evidence_first_by_tier", """
SELECT domain, first_name, source FROM evidence_rows
QUALIFY row_number() OVER (PARTITION BY domain ORDER BY tier, pos, first_name) = 1""",
       uses="evidence_rows")
def _(spark, sf):
    return rank.first_wins(evidence_rows(spark, sf), ["domain"], ["tier", "pos", "first_name"]
                           ).select("domain", "first_name", "source")
