"""Extraction operators over pages, documents and records derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from contactloom import patterns, rules
from contactloom.catalog.base import (FIRST, LAST, STOPS, cards, dns_answers, query, read,
                                      read_texts, site_pages, sql_any, sql_list, sql_pick, store)
from contactloom.catalog.columns import _valid_sql, MENTION_SQL
from contactloom.functions import emails, html
from contactloom.functions.text import snippet
from contactloom.session import materialise, spread
from contactloom.operators import extract, mentions, rank
from contactloom.operators.generate import pick


@query("email_mentions", f"""
SELECT doc_id, unnest(range(len(m))) AS pos, unnest(m) AS email
FROM (SELECT doc_id, {MENTION_SQL.format('text')} AS m FROM documents)""")
def _(spark, sf):
    return extract.extract_emails(read_texts(spark, sf, "documents"), "text", ["doc_id"])


@query("distinct_mentions_per_page", f"""
SELECT page_id, array_to_string(list_sort(list_distinct({MENTION_SQL.format('html')})), ' ')
  AS emails FROM site_pages""", uses="site_pages")
def _(spark, sf):
    found = extract.unique_mentions(site_pages(spark, sf), "html", ["page_id"])
    return found.select("page_id", F.array_join(F.array_sort("emails"), " ").alias("emails"))


@query("mail_links", r"""
SELECT page_id, unnest(range(len(m))) AS pos, lower(trim(unnest(m))) AS email FROM (
  SELECT page_id, regexp_extract_all(html, '(?i)href=["'']mailto:([^"''?\s]+)', 1) AS m
  FROM site_pages)""", uses="site_pages")
def _(spark, sf):
    return site_pages(spark, sf).select(
        "page_id", F.posexplode(extract.mailto_list("html")).alias("pos", "email"))


_PLAIN = r"'([a-zA-Z0-9][a-zA-Z0-9._%+-]{1,40}@[a-zA-Z0-9][a-zA-Z0-9.-]{1,40}\.[a-zA-Z]{2,10})'"


@query("hidden_email_sweep", f"""
SELECT page_id, email, arg_min(encoding, n) AS encoding FROM (
  SELECT page_id, domain, lower(unnest(regexp_extract_all(html,
    '(?i)mailto:([a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}})', 1))) AS email,
    'mailto' AS encoding, 1 AS n FROM site_pages
  UNION ALL
  SELECT page_id, domain, lower(list_aggregate(list_transform(range(1, len(h) // 2),
      lambda i: chr(xor(('0x' || substr(h, 2 * i + 1, 2))::INTEGER, 42))),
      'string_agg', '')), 'xor', 2
  FROM (SELECT page_id, domain, regexp_extract(html, 'data-cfemail="([0-9a-f]+)"', 1) AS h
        FROM site_pages) WHERE h <> ''
  UNION ALL
  SELECT page_id, domain, lower(unnest(regexp_extract_all(
      replace(replace(html, '&#64;', '@'), '&#46;', '.'), {_PLAIN}, 1))), 'entity', 4
  FROM site_pages
  UNION ALL
  SELECT page_id, domain, lower(unnest(regexp_extract_all(html, {_PLAIN}, 1))), 'plain', 3
  FROM site_pages)
WHERE split_part(email, '@', 2) = domain OR ends_with(split_part(email, '@', 2), '.' || domain)
  OR ends_with(domain, '.' || split_part(email, '@', 2))
GROUP BY page_id, email""", uses="site_pages")
def _(spark, sf):
    return extract.sweep_emails(site_pages(spark, sf), "html", "domain", ["page_id"])


_SCORED_SQL = f"""
SELECT page_id, domain, pos, email, CASE WHEN link THEN 100
    WHEN contains(email, split_part(domain, '.', 1))
      OR contains(domain, split_part(email, '@', 2)) THEN 100
    WHEN {sql_any('email', rules.CANDIDATE_WEIGHTS['worker'][1])} THEN 85 ELSE 60 END AS score
FROM (SELECT page_id, domain, unnest(range(len(all_m))) AS pos, unnest(all_m).e AS email,
        unnest(all_m).link AS link
      FROM (SELECT page_id, domain,
              list_concat(list_transform(l, lambda m: {{'e': lower(trim(m)), 'link': true}}),
                          list_transform(t, lambda m: {{'e': m, 'link': false}})) AS all_m
            FROM (SELECT page_id, domain,
                    regexp_extract_all(html, '(?i)href=["'']mailto:([^"''?\\s]+)', 1) AS l,
                    {MENTION_SQL.format('html')} AS t FROM site_pages)))
WHERE {_valid_sql('email', rules.BLOCK_TERMS)}"""


@query("scored_candidates", _SCORED_SQL, uses="site_pages")
def _(spark, sf):
    return extract.page_candidates(site_pages(spark, sf), "html", "domain",
                                   ["page_id", "domain"])


def _weights_sql(name: str) -> str:
    own, prefixes, role, info, other = rules.CANDIDATE_WEIGHTS[name]
    label = "split_part(replace(domain, 'www.', ''), '.', 1)"
    fits = f"contains(email, {label}) OR contains(domain, split_part(email, '@', 2))"
    if name == "crawl":
        fits += (" OR len(list_filter(string_split(domain, '.'), lambda p: length(p) > 3 "
                 "AND contains(email, p))) > 0")
    mid = f" WHEN contains(email, 'info@') THEN {info}" if info else ""
    return (f"CASE WHEN {fits} THEN {own} WHEN {sql_any('email', prefixes)} THEN {role}"
            f"{mid} ELSE {other} END")


@query("candidate_weights", f"""
SELECT page_id, pos, email, {_weights_sql('harvest')} AS harvest, {_weights_sql('crawl')} AS crawl
FROM (SELECT page_id, domain, unnest(range(len(m))) AS pos, unnest(m) AS email
      FROM (SELECT page_id, domain, {MENTION_SQL.format('html')} AS m FROM site_pages))""",
       uses="site_pages")
def _(spark, sf):
    found = extract.extract_emails(site_pages(spark, sf), "html", ["page_id", "domain"])
    return found.select(
        "page_id", "pos", "email",
        emails.score_candidate("email", "domain", "harvest").alias("harvest"),
        emails.score_candidate("email", "domain", "crawl").alias("crawl"))


@query("best_candidates_per_site", f"""
SELECT domain, email, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY score DESC, page_id, pos) AS rank
  FROM (SELECT * FROM ({_SCORED_SQL})
        QUALIFY row_number() OVER (PARTITION BY domain, email
                                   ORDER BY score DESC, page_id, pos) = 1))
WHERE rank <= 3""", uses="site_pages")
def _(spark, sf):
    found = extract.page_candidates(site_pages(spark, sf), "html", "domain",
                                    ["page_id", "domain"])
    placed = found.withColumn("pos", F.struct("page_id", "pos"))
    return rank.top_candidates(placed, "domain", 3).select("domain", "email", "score", "rank")


@query("crawl_candidates_in_order", f"""
SELECT domain, email, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY path_no, page_id, pos) AS rank FROM (
    SELECT * FROM (SELECT *, min(CASE WHEN score = 100 THEN path_no END)
        OVER (PARTITION BY domain) AS stop FROM (
      SELECT page_id, domain, path_no, pos, email, {_weights_sql('crawl')} AS score
      FROM (SELECT page_id, domain, path_no, unnest(range(len(m))) AS pos, unnest(m) AS email
            FROM (SELECT page_id, domain, path_no, {MENTION_SQL.format('html')} AS m FROM site_pages))
      WHERE NOT {sql_any('email', rules.CRAWL_BLOCK_TERMS)}))
    WHERE stop IS NULL OR path_no <= stop
    QUALIFY row_number() OVER (PARTITION BY domain, email ORDER BY path_no, page_id, pos) = 1))
""", uses="site_pages")
def _(spark, sf):
    found = extract.page_candidates(
        site_pages(spark, sf), "html", "domain", ["page_id", "domain", "path_no"], "crawl",
        rules.CRAWL_BLOCK_TERMS, mail_links=False, shape=False)
    kept = rank.stop_at_score(materialise(found), "domain")
    placed = kept.withColumn("pos", F.struct("path_no", "page_id", "pos"))
    return rank.top_candidates(placed, "domain", None, by="pos").select("domain", "email", "rank")


@query("page_links", """
SELECT page_id, unnest(range(len(m))) AS pos, trim(unnest(m)) AS href FROM (
  SELECT page_id, regexp_extract_all(html, '(?is)<a\\b[^>]*?\\shref=["'']([^"'']*)["'']', 1) AS m
  FROM pages)""".replace("\\\\", "\\"))
def _(spark, sf):
    return extract.page_links(read(spark, sf, "pages"), "html", ["page_id"])


def _first_link(marker: str, keep: str) -> str:
    return (f"list_filter(list_transform(links, lambda h: CASE WHEN {marker} THEN {keep} END), "
            "lambda x: x IS NOT NULL)[1]")


_SOCIAL_SQL = f"""
SELECT page_id, domain, path_no,
  {_first_link("contains(h, 'instagram.com/')", "'https://www.instagram.com/' || split_part(split_part(split_part(h, '?', 1), 'instagram.com/', 2), '/', 1)")} AS instagram,
  {_first_link("contains(h, 'facebook.com/') AND NOT contains(h, '/sharer') AND NOT contains(h, '/groups')", "'https://www.facebook.com/' || split_part(split_part(split_part(h, '?', 1), 'facebook.com/', 2), '/', 1)")} AS facebook,
  {_first_link("contains(h, 'linkedin.com/company/')", "rtrim(h, '/')")} AS linkedin,
  {_first_link("contains(h, 'tiktok.com/@')", "'https://www.tiktok.com/@' || split_part(split_part(h, '?', 1), 'tiktok.com/@', 2)")} AS tiktok,
  {_first_link("contains(h, 'x.com/')", "h")} AS twitter_x
FROM (SELECT page_id, domain, path_no,
  regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM site_pages)"""


@query("page_socials", _SOCIAL_SQL, uses="site_pages")
def _(spark, sf):
    return site_pages(spark, sf).select("page_id", "domain", "path_no",
                                        *extract.page_socials("html"))


@query("site_socials", "SELECT domain, " + ", ".join(
    f"arg_min({c}, page_id) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in extract.PLATFORM_COLUMNS.values()) + f" FROM ({_SOCIAL_SQL}) GROUP BY domain",
       uses="site_pages")
def _(spark, sf):
    rows = site_pages(spark, sf).select("page_id", "domain", *extract.page_socials("html"))
    return extract.site_socials(rows, "domain", ["page_id"])


@query("contact_links", """
SELECT page_id, CASE WHEN h IS NULL THEN NULL WHEN starts_with(h, 'http') THEN h
    ELSE 'https://' || domain || h END AS contact_url,
  CASE WHEN c THEN 'https://' || domain || '/pages/contact-us' END AS own_contact_url
FROM (SELECT page_id, domain, contains(html, '"/pages/contact-us"') AS c,
  list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x:
    (starts_with(x, 'http') OR starts_with(x, '/')) AND (contains(lower(x), 'contact')
    OR contains(lower(x), 'about') OR contains(lower(x), 'help') OR contains(lower(x), 'support')
    OR contains(lower(x), 'touch')))[1] AS h FROM site_pages)""", uses="site_pages")
def _(spark, sf):
    return site_pages(spark, sf).select(
        "page_id", extract.contact_link("html", "domain").alias("contact_url"),
        extract.contact_link("html", "domain", "own").alias("own_contact_url"))


_HINT = sql_any("lower(x)", rules.ABOUT_HINTS)
_SKIP = sql_any("lower(x)", rules.ABOUT_SKIPS)


@query("next_pages_to_read", f"""
SELECT page_id, pos, url FROM (
  SELECT page_id, unnest(range(1, len(u) + 1)) - 1 AS pos, unnest(u) AS url FROM (
    SELECT page_id, list_slice(list_transform(list_sort(list_transform(
        list_distinct(a), lambda x: {{'p': list_position(a, x), 'u': x}})), lambda s: s.u), 1, 8) AS u
    FROM (SELECT page_id, list_concat(
        list_transform(list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1),
          lambda x: {_HINT} AND NOT {_SKIP} AND (NOT starts_with(x, 'http') OR contains(x, domain))),
          lambda x: CASE WHEN starts_with(x, 'http') THEN x
            WHEN starts_with(x, '/') THEN 'https://' || domain || x
            ELSE 'https://' || domain || '/' || x END),
        list_transform({sql_list(rules.ABOUT_PATHS)}, lambda p: 'https://' || domain || p)) AS a
      FROM site_pages)))""", uses="site_pages")
def _(spark, sf):
    return site_pages(spark, sf).select("page_id", F.posexplode(
        extract.candidate_pages("html", "domain")).alias("pos", "url"))


@query("pages_chosen_per_site", f"""
SELECT domain, path, priority, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY priority, path) AS rank FROM (
    SELECT DISTINCT domain, path, 0 AS priority FROM (
      SELECT domain, '/pages/about/' || page_id AS path FROM site_pages
      UNION ALL SELECT domain, '/products/about-' || page_id FROM site_pages)
    WHERE NOT contains(path, '/products/')
    UNION ALL SELECT DISTINCT domain, '/pages/contact', {rules.ABOUT_PATHS.index('/pages/contact') + 1}
    FROM site_pages)) WHERE rank <= 4""", uses="site_pages")
def _(spark, sf):
    base = site_pages(spark, sf)
    number = F.col("page_id").cast("string")
    inventory = base.select("domain", F.explode(F.array(
        F.concat(F.lit("/pages/about/"), number), F.concat(F.lit("/products/about-"), number),
        F.lit("/pages/contact"))).alias("path"))
    return extract.select_pages(inventory, "domain", "path", 4).select(
        "domain", "path", "priority", "rank")


def _strip(expr: str) -> str:
    for tag in rules.CHROME_TAGS:
        expr = f"regexp_replace({expr}, '(?is)<{tag}\\b.*?</{tag}\\s*>', ' ', 'g')"
    expr = f"regexp_replace({expr}, '(?s)<!--.*?-->', ' ', 'g')"
    expr = f"regexp_replace({expr}, '(?s)<[^>]*>', ' ', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                         ("&#39;", "''"), ("&amp;", "&")):
        expr = f"replace({expr}, '{entity}', '{char}')"
    return f"trim(regexp_replace({expr}, '\\s+', ' ', 'g'))"


@query("visible_page_text", f"SELECT page_id, {_strip('html')} AS text FROM pages")
def _(spark, sf):
    return read_texts(spark, sf, "pages").select("page_id", html.visible_text("html").alias("text"))


@query("visible_page_text_parsed", f"SELECT page_id, {_strip('html')} AS text FROM pages")
def _(spark, sf):
    return read_texts(spark, sf, "pages").select("page_id", html.visible_text_dom("html").alias("text"))


# the sentence is the only pattern hit of most texts, so the expected person is known
_PERSON_SQL = f"""
SELECT doc_id, {sql_pick([x.title() for x in FIRST], 'doc_id')} AS first_name,
  {sql_pick([x.title() for x in LAST], 'doc_id // 2')} AS last_name
FROM documents"""


def _person_texts(spark, sf):
    d = read_texts(spark, sf, "documents")
    key = F.col("doc_id")
    name = F.concat_ws(" ", F.initcap(pick(FIRST, key)), F.initcap(pick(LAST, F.floor(key / 2))))
    kind = F.pmod(key, F.lit(6))
    lead = (F.when(kind == 0, F.concat(F.lit("Founded in 2015 by "), name, F.lit(".")))
            .when(kind == 1, F.concat(F.lit("Inhaber: "), name, F.lit(".")))
            .when(kind == 2, F.concat(F.lit("Impressum "), name, F.lit(".")))
            .when(kind == 3, F.concat(F.lit("Directeur de la publication: "), name, F.lit(".")))
            .when(kind == 4, F.concat(F.lit("Fundador: "), name, F.lit(".")))
            .otherwise(F.concat(F.lit("Eigenaar: "), name, F.lit("."))))
    return d.select("doc_id", F.lit("").alias("brand"), F.lit("").alias("domain"),
                    F.concat(lead, F.lit(" "), "text").alias("text"))


@query("person_mentions", _PERSON_SQL)
def _(spark, sf):
    found = extract.person_mentions(_person_texts(spark, sf), "text", "brand", "domain",
                                    ["doc_id"], FIRST, STOPS)
    return found.select("doc_id", "first_name", "last_name")


@query("page_step_person", f"""
SELECT doc_id, {sql_pick([x.title() for x in FIRST], 'doc_id')} AS first_name,
  {sql_pick([x.title() for x in LAST], 'doc_id // 2')} AS last_name FROM documents""")
def _(spark, sf):
    return extract.page_person(_launched(spark, sf), "text", ["doc_id"])


def _launched(spark, sf):
    key = F.col("doc_id")
    name = F.concat_ws(" ", F.initcap(pick(FIRST, key)), F.initcap(pick(LAST, F.floor(key / 2))))
    return read_texts(spark, sf, "documents").select("doc_id", F.concat(
        F.lit("Launched by "), name, F.lit(". "), F.col("text")).alias("text"))


def _page_pattern_sql() -> str:
    """Every match of the page patterns, one branch for each pattern."""
    name = (f"{sql_pick([x.title() for x in FIRST], 'doc_id')} || ' ' || "
            f"{sql_pick([x.title() for x in LAST], 'doc_id // 2')}")
    branches = []
    for number, (pattern, _) in enumerate(patterns.PAGE_PATTERNS, start=1):
        full = "'(?i)" + pattern.replace("'", "''") + "'"
        branches.append(f"""
  SELECT doc_id, {number} AS pat, hit - 1 AS hit, found[hit] AS whole,
    trim(regexp_extract(found[hit], {full}, 1)) AS cand
  FROM (SELECT doc_id, found, unnest(range(1, len(found) + 1)) AS hit
    FROM (SELECT doc_id, regexp_extract_all(text, {full}) AS found FROM texts))""")
    return (f"WITH texts AS (SELECT doc_id, 'Launched by ' || {name} || '. ' || text AS text "
            f"FROM documents){' UNION ALL '.join(branches)}")


@query("mentions_by_pattern_table", _page_pattern_sql())
def _(spark, sf):
    table = mentions.pattern_table(spark, patterns.PAGE_PATTERNS)
    return mentions.mentions_by_table(_launched(spark, sf), "doc_id", "text", table)


@query("answer_box_owner", f"""
SELECT doc_id, {sql_pick([x.title() for x in FIRST], 'doc_id')} AS first_name,
  CASE WHEN doc_id % 2 = 0 THEN {sql_pick([x.title() for x in LAST], 'doc_id // 2')} ELSE '' END
    AS last_name FROM documents""")
def _(spark, sf):
    key = F.col("doc_id")
    first, last = F.initcap(pick(FIRST, key)), F.initcap(pick(LAST, F.floor(key / 2)))
    lead = F.when(F.pmod(key, F.lit(2)) == 0, F.concat(
        F.lit("Owner: "), first, F.lit(" "), last, F.lit(". "))).otherwise(F.concat(
            F.lit("it was founded by "), first, F.lit(" & Zoe. ")))
    return read(spark, sf, "documents").select("doc_id", extract.answer_owner(
        F.concat(lead, "text")).alias("p")).select("doc_id", "p.first_name", "p.last_name")


@query("profile_bio_person", f"""
SELECT seq, split_part(owner, ' ', 1) AS first_name, split_part(owner, ' ', 2) AS last_name
FROM store""", uses="store")
def _(spark, sf):
    page = F.concat(F.lit('{"id":1,"biography":"Handmade\\n goods. Founder: '), F.col("owner"),
                    F.lit('"}'))
    rows = spread(store(spark, sf)).select("seq", extract.bio_text(page).alias("bio"),
                                           F.lit("").alias("b"), F.lit("").alias("d"))
    return extract.person_mentions(rows, "bio", "b", "d", ["seq"], FIRST, STOPS).select(
        "seq", "first_name", "last_name")


@query("schema_block_people", """
SELECT page_id, 'Anna' AS first_name, 'Miller' || page_id AS last_name, 0 AS pos
FROM site_pages WHERE page_id % 6 = 5
UNION ALL SELECT page_id, 'Peter', 'Weber', 1 FROM site_pages WHERE page_id % 6 = 5""",
       uses="site_pages")
def _(spark, sf):
    return extract.schema_candidates(site_pages(spark, sf), "html", ["page_id"]).select(
        "page_id", "first_name", "last_name", "pos")


@query("schema_person", """
SELECT page_id, 'Peter' AS first_name, 'Weber' AS last_name
FROM site_pages WHERE regexp_matches(html, 'application/ld\\+json')""".replace("\\\\", "\\"),
       uses="site_pages")
def _(spark, sf):
    return extract.schema_person(site_pages(spark, sf), "html", ["page_id"], FIRST, STOPS)


@query("feed_authors", """
SELECT seq, CASE WHEN seq % 2 = 0 THEN trim(email) END AS email,
  CASE WHEN seq % 3 < 2 THEN split_part(owner, ' ', 1) END AS first_name,
  CASE WHEN seq % 3 < 2 THEN split_part(owner, ' ', 2) END AS last_name FROM store""",
       uses="store")
def _(spark, sf):
    feed = F.concat(
        F.when(F.pmod("seq", F.lit(2)) == 0, F.concat(
            F.lit("<managingEditor> <email>"), "email", F.lit("</email></managingEditor>")))
        .otherwise(""),
        F.when(F.pmod("seq", F.lit(3)) < 2, F.concat(
            F.lit("<dc:creator> "), "owner", F.lit(" </dc:creator>"))).otherwise(""))
    return store(spark, sf).select("seq", extract.feed_author(feed).alias("a")).select(
        "seq", "a.*")


@query("api_authors", """
SELECT seq, split_part(owner, ' ', 1) AS first_name, split_part(owner, ' ', 2) AS last_name,
  CASE WHEN seq % 2 = 0 THEN 'author_api' ELSE 'author_api_slug' END AS source FROM store""",
       uses="store")
def _(spark, sf):
    first = F.split_part("owner", F.lit(" "), F.lit(1))
    last = F.split_part("owner", F.lit(" "), F.lit(2))
    named = F.pmod("seq", F.lit(2)) == 0
    body = F.to_json(F.array(F.struct(
        F.when(named, F.col("owner")).otherwise(first).alias("name"),
        F.lower(F.concat(first, F.lit("-"), last)).alias("slug"))))
    return store(spark, sf).select("seq", extract.api_author(body).alias("p")).select(
        "seq", "p.*")


@query("registration_people", """
SELECT seq, CASE WHEN seq % 3 = 0 THEN NULL ELSE owner END AS from_json,
  CASE WHEN seq % 4 = 0 THEN NULL ELSE owner END AS from_text FROM store""", uses="store")
def _(spark, sf):
    private = F.pmod("seq", F.lit(3)) == 0
    name = F.when(private, F.lit("Privacy Proxy")).otherwise(F.col("owner"))
    body = F.concat(
        F.lit('{"entities":[{"roles":["abuse"],"vcardArray":["vcard",[["fn",{},"text","No '
              'One"]]]},{"roles":["registrant"],"vcardArray":["vcard",[["version",{},"text",'
              '"4.0"],["fn",{},"text","'), name, F.lit('"]]]}]}'))
    text = F.concat(
        F.lit("Domain: x\nRegistrant Name: "),
        F.when(F.pmod("seq", F.lit(4)) == 0, F.lit("REDACTED FOR PRIVACY"))
        .otherwise(F.col("owner")), F.lit("\nAdmin Email: hidden"))
    return store(spark, sf).select(
        "seq", extract.registration_json_person(body).alias("from_json"),
        extract.registration_text_person(text).alias("from_text"))


@query("company_numbers", """
SELECT seq, CASE WHEN ends_with(domain, '.uk') OR seq % 5 = 0
  THEN lpad(CAST(seq AS VARCHAR), 8, '0') END AS number FROM store""", uses="store")
def _(spark, sf):
    text = F.concat(
        F.lit("<p>Company Registration No: "), F.lpad(F.col("seq").cast("string"), 8, "0"),
        F.when(F.pmod("seq", F.lit(5)) == 0, " registered in England").otherwise(" abroad"))
    return store(spark, sf).select("seq", extract.company_number(text, "domain").alias("number"))


@query("officer_names", """
SELECT seq, split_part(owner, ' ', 1) AS first_name, split_part(owner, ' ', 2) AS last_name
FROM store""", uses="store")
def _(spark, sf):
    from contactloom.functions.names import officer_name

    raw = F.concat(F.upper(F.split_part("owner", F.lit(" "), F.lit(2))), F.lit(", "),
                   F.split_part("owner", F.lit(" "), F.lit(1)), F.lit(" Maria"))
    return store(spark, sf).select("seq", officer_name(raw).alias("p")).select("seq", "p.*")


_GOOD_CARDS = f"""
SELECT *, CASE WHEN contains(url, '/RU=')
    THEN replace(replace(regexp_extract(url, '/RU=(.*?)/RK=', 1), '%3a', ':'), '%2f', '/')
    ELSE url END AS target FROM cards"""
_CARD_OK = f"""NOT contains(lower(target), '/pub/dir/') AND (contains(lower(target), domain)
    OR {sql_any('lower(target)', rules.TRUSTED_HOSTS)}
    OR NOT {sql_any('lower(target)', rules.DENIED_HOSTS)})
  AND (contains(lower(text), split_part(domain, '.', 1)) OR contains(lower(text), lower(brand)))"""


@query("ranked_cards", f"""
SELECT doc_id, domain, engine, target,
  row_number() OVER (PARTITION BY domain, engine ORDER BY pos) AS rank
FROM ({_GOOD_CARDS}) WHERE {_CARD_OK}""", uses="cards")
def _(spark, sf):
    return extract.rank_cards(cards(spark, sf), STOPS).select(
        "doc_id", "domain", "engine", "target", "rank")


_VOTES_SQL = f"""
SELECT domain, engine, engine_rank, regexp_extract(text, 'Founded by (\\w+) (\\w+)', 1)
    AS first_name, regexp_extract(text, 'Founded by (\\w+) (\\w+)', 2) AS last_name
FROM ({_GOOD_CARDS}) WHERE {_CARD_OK} AND starts_with(text, 'Welcome. Founded by')
QUALIFY row_number() OVER (PARTITION BY domain, engine ORDER BY pos) = 1"""


@query("card_votes", _VOTES_SQL, uses="cards")
def _(spark, sf):
    return extract.card_votes(cards(spark, sf), FIRST, STOPS).select(
        "domain", "engine", "engine_rank", "first_name", "last_name")


@query("profile_host_cards", """
SELECT domain, arg_min(regexp_extract(text, 'Founded by (\\w+)', 1), engine_rank) AS first_name,
  arg_min(regexp_extract(text, 'Founded by \\w+ (\\w+)', 1), engine_rank) AS last_name
FROM cards WHERE starts_with(text, 'Welcome. Founded by') GROUP BY domain""", uses="cards")
def _(spark, sf):
    listed = cards(spark, sf).withColumn("url", F.concat(
        F.lit("http://r/RU=https%3a%2f%2fwww.crunchbase.com%2f"), "domain", F.lit("/RK=1")))
    return extract.profile_cards(listed, FIRST, STOPS)


@query("profile_card_heads", """
SELECT seq, split_part(owner, ' ', 1) AS first_name, split_part(owner, ' ', 2) AS last_name
FROM store WHERE seq % 2 = 0""", uses="store")
def _(spark, sf):
    mark = F.when(F.pmod("seq", F.lit(2)) == 0, " - Founder at ").otherwise(" founder of ")
    rows = store(spark, sf).select("seq", extract.profile_head(F.concat(
        "owner", mark, "brand")).alias("p"))
    return rows.where("p IS NOT NULL").select("seq", "p.*")


@query("mention_snippets", f"""
SELECT doc_id, pos, email, trim(regexp_replace(substr(text, greatest(1, place - 100),
  place + 100 - greatest(1, place - 100)), '\\s+', ' ', 'g')) AS snippet
FROM (SELECT doc_id, text, unnest(range(len(m))) AS pos, unnest(m) AS email,
        instr(lower(text), unnest(m)) AS place
      FROM (SELECT doc_id, text, {MENTION_SQL.format('text')} AS m FROM documents))""")
def _(spark, sf):
    rows = read(spark, sf, "documents")
    low = F.lower("text")

    def shown(email):
        hit = F.substring(F.col("text"), F.instr(low, email), F.length(email))
        return F.struct(email.alias("email"), snippet("text", hit).alias("snippet"))

    found = F.transform(extract.mention_list("text"), shown)
    return rows.select("doc_id", F.posexplode(found).alias("pos", "m")).select(
        "doc_id", "pos", "m.*")


@query("card_addresses", """
SELECT doc_id, email, split_part(email, '@', 1) NOT IN ('info') AS is_personal FROM (
  SELECT doc_id, unnest(list_distinct(list_transform(regexp_extract_all(text,
    '([a-zA-Z0-9][a-zA-Z0-9._%+-]{1,30}@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,})', 1), lambda m: lower(m))))
    AS email, domain FROM cards)
WHERE ends_with(email, '@' || domain)""".replace("\\\\", "\\"), uses="cards")
def _(spark, sf):
    return extract.card_emails(cards(spark, sf), "text", "domain", ["doc_id"]).select(
        "doc_id", "email", "is_personal")


@query("dns_json_answers", """
SELECT domain, CASE WHEN pref % 3 = 0 THEN 10 ELSE pref END AS pref, rtrim(data, '.') AS host
FROM dns_answers WHERE rtype = 'MX'""", uses="dns_answers")
def _(spark, sf):
    value = F.when(F.pmod("pref", F.lit(3)) == 0, F.col("data")).otherwise(
        F.concat_ws(" ", F.col("pref").cast("string"), "data"))
    rows = dns_answers(spark, sf).where("rtype = 'MX'").select("domain", F.to_json(F.struct(
        F.array(F.struct(value.alias("data"))).alias("Answer"))).alias("body"))
    return extract.dns_json(rows, "body", ["domain"])


@query("archive_snapshots", """
SELECT seq, unnest([0, 1, 2]) AS pos,
  CAST(unnest([2018, 2019, 2020]) + seq % 5 AS VARCHAR) || '0101' AS taken_at,
  'https://' || domain || '/contact' AS original FROM store""", uses="store")
def _(spark, sf):
    link = F.concat(F.lit("https://"), "domain", F.lit("/contact"))
    years = F.transform(F.sequence(F.lit(2018), F.lit(2022)), lambda y: F.array(F.concat(
        (y + F.pmod("seq", F.lit(5))).cast("string"), F.lit("0101")), link))
    body = F.to_json(F.concat(F.array(F.array(F.lit("timestamp"), F.lit("original"))), years))
    rows = store(spark, sf).select("seq", body.alias("body"))
    return extract.snapshots(rows, "body", ["seq"])


@query("channel_handle_person", """
SELECT page_id, 'Anna' AS first_name, 'Miller' AS last_name FROM site_pages
WHERE contains(html, 'youtube.com/@')""", uses="site_pages")
def _(spark, sf):
    from contactloom.functions.names import handle_name

    handle = F.regexp_extract("html", patterns.VIDEO_HANDLE_PATTERN, 1)
    rows = site_pages(spark, sf).select("page_id", handle_name(handle).alias("p"))
    return rows.where("p IS NOT NULL").select("page_id", "p.*")


@query("conversation_mentions", f"""
SELECT conv_id, turn, role, len({MENTION_SQL.format('text')}) AS mentions FROM conversations""")
def _(spark, sf):
    return read(spark, sf, "conversations").select(
        "conv_id", "turn", "role", F.size(extract.mention_list("text")).alias("mentions"))
