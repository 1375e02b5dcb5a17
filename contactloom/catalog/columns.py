"""Column functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from contactloom import rules
from contactloom.catalog.base import (FIRST, INBOX_LABEL_SQL, LAST, STOPS, cards, dns_answers,
                                      query, read, site_pages, sql_any, sql_list, sql_pick,
                                      store)
from contactloom.functions import domains, emails, html, names, social
from contactloom.functions.text import capitalize, slug
from contactloom.operators import classify, extract, match

CLEAN_SQL = (r"split_part(regexp_replace(lower(trim({0})), "
             r"'^(https://)?(http://)?(www\.)?', ''), '/', 1)")


@query("clean_domain_prefix", f"""
SELECT page_id, {CLEAN_SQL.format('url')} AS domain FROM pages""")
def _(spark, sf):
    return read(spark, sf, "pages").select("page_id", domains.clean_domain("url").alias("domain"))


@query("clean_domain_anywhere", """
SELECT page_id,
  split_part(replace(replace(replace(lower(trim(url)), 'https://', ''), 'http://', ''),
    'www.', ''), '/', 1) AS no_www,
  split_part(replace(replace(lower(trim(url)), 'https://', ''), 'http://', ''), '/', 1)
    AS with_www
FROM pages""")
def _(spark, sf):
    return read(spark, sf, "pages").select(
        "page_id", domains.clean_domain("url", "anywhere").alias("no_www"),
        domains.clean_domain("url", "anywhere", www=False).alias("with_www"))


def _brand_sql(front: str, back: str) -> str:
    core = (f"regexp_replace(regexp_replace(l, '(?i)^({front})', ''), '(?i)({back})$', '')")
    return (f"upper(left(CASE WHEN length({core}) > 0 THEN {core} ELSE l END, 1)) || "
            f"lower(substr(CASE WHEN length({core}) > 0 THEN {core} ELSE l END, 2))")


@query("brand_from_domain", f"""
SELECT seq, {_brand_sql('shop|the|my|get|try|buy|store', 'shop|store|online|co|brand')} AS crawl,
  {_brand_sql('shop|the|my|get|try|buy|store|wear', 'shop|store|online|co|brand|official')}
    AS ranked
FROM (SELECT seq, split_part(domain, '.', 1) AS l FROM store)""", uses="store")
def _(spark, sf):
    return store(spark, sf).select(
        "seq", domains.brand_from_domain("domain", "crawl").alias("crawl"),
        domains.brand_from_domain("domain", "ranked").alias("ranked"))


@query("brand_default", """
SELECT page_id, upper(left(l, 1)) || lower(substr(l, 2)) AS label,
  list_aggregate(list_transform(string_split(replace(split_part(replace(domain, 'www.', ''),
    '.', 1), '-', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))),
    'string_agg', ' ') AS titled
FROM (SELECT page_id, domain, split_part(domain, '.', 1) AS l FROM site_pages)""",
       uses="site_pages")
def _(spark, sf):
    return site_pages(spark, sf).select(
        "page_id", domains.brand_or_default(F.lit(" "), "domain").alias("label"),
        domains.brand_or_default(F.lit(None).cast("string"), "domain", "title").alias("titled"))


@query("capitalize_names", """
SELECT p_partkey, upper(left(p_name, 1)) || lower(substr(p_name, 2)) AS name,
  upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS kind FROM part""")
def _(spark, sf):
    return read(spark, sf, "part").select(
        "p_partkey", capitalize("p_name").alias("name"), capitalize("p_type").alias("kind"))


@query("country_from_suffix", """
SELECT seq, domain, CASE WHEN ends_with(domain, '.com') OR ends_with(domain, '.us')
      THEN 'United States'
    WHEN ends_with(domain, '.uk') THEN 'United Kingdom' WHEN ends_with(domain, '.ca') THEN 'Canada'
    WHEN ends_with(domain, '.au') THEN 'Australia' WHEN ends_with(domain, '.in') THEN 'India'
    ELSE 'International' END AS label,
  CASE WHEN ends_with(domain, '.com') OR ends_with(domain, '.us') THEN 'United States'
    ELSE 'International' END AS two_way,
  CASE WHEN ends_with(domain, '.com') THEN 'United States' ELSE 'International' END AS com_only,
  CASE WHEN ends_with(domain, '.uk') THEN 'UK' WHEN ends_with(domain, '.au') THEN 'AU'
    WHEN ends_with(domain, '.ca') THEN 'CA'
    WHEN regexp_matches(domain, '\\.(com|net|org|io|co)$') THEN 'US' ELSE 'INTL' END AS code
FROM store""".replace("\\\\", "\\"), uses="store")
def _(spark, sf):
    return store(spark, sf).select(
        "seq", "domain", domains.country_from_tld("domain").alias("label"),
        domains.country_from_tld("domain", "binary").alias("two_way"),
        domains.country_from_tld("domain", "com_only").alias("com_only"),
        domains.country_from_tld("domain", "codes").alias("code"))


def _provider_sql(ruleset: str, host: str) -> str:
    *table, default = rules.PROVIDER_RULES[ruleset]
    return "CASE " + " ".join(f"WHEN {sql_any(f'lower({host})', terms)} THEN '{label}'"
                              for terms, label in table) + f" ELSE '{default}' END"


@query("provider_labels", f"""
SELECT domain, pref, data, {_provider_sql('inbox', 'data')} AS inbox,
  {_provider_sql('verifier', 'data')} AS verifier, {_provider_sql('harvest', 'data')} AS harvest,
  {_provider_sql('fingerprint', 'data')} AS fingerprint
FROM dns_answers WHERE rtype = 'MX'""", uses="dns_answers")
def _(spark, sf):
    mx = dns_answers(spark, sf).where("rtype = 'MX'")
    return mx.select("domain", "pref", "data", *[
        match.provider_of(F.col("data"), r).alias(r)
        for r in ("inbox", "verifier", "harvest", "fingerprint")])


_KNOWN_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.HARVEST_KNOWN_PROVIDERS.items())


@query("known_mail_domains", f"""
SELECT seq, split_part(email, '@', 2) AS mail_domain,
  CASE split_part(email, '@', 2) {_KNOWN_SQL} END AS provider FROM store""", uses="store")
def _(spark, sf):
    at = emails.mail_domain("email")
    return store(spark, sf).select(
        "seq", at.alias("mail_domain"),
        match.known_provider(at, rules.HARVEST_KNOWN_PROVIDERS).alias("provider"))


def _valid_sql(e: str, block, bounds: str = "length({0}) >= 6") -> str:
    dummy = " OR ".join(f"split_part({e}, '@', 2) = '{d}' OR ends_with({e}, '.{d}')"
                        for d in rules.DUMMY_DOMAINS)
    blocked = sql_any(e, block) if block else "FALSE"
    return (f"(regexp_matches({e}, '^[^@]+@[^@]*\\.\\p{{L}}{{2,12}}$') AND {bounds.format(e)} "
            f"AND NOT {blocked} AND NOT ({dummy}))")


MENTION_SQL = (r"list_transform(regexp_extract_all({0}, "
               r"'[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9.-]+'), "
               r"lambda m: lower(trim(m, '.')))")


@query("email_validity", f"""
SELECT doc_id, pos, email, {_valid_sql('email', rules.BLOCK_TERMS)} AS valid,
  {_valid_sql('email', rules.HARVEST_BLOCK_TERMS, 'length({0}) BETWEEN 6 AND 120')}
    AS valid_harvest,
  regexp_matches(email, '^[^@]+@[^@]*\\.\\p{{L}}{{2,12}}$') AND length(email) >= 6 AS well_formed
FROM (SELECT doc_id, unnest(m) AS email, unnest(range(len(m))) AS pos
      FROM (SELECT doc_id, {MENTION_SQL.format('text')} AS m FROM cards))""", uses="cards")
def _(spark, sf):
    found = extract.extract_emails(cards(spark, sf), "text", ["doc_id"])
    return found.select(
        "doc_id", "pos", "email", emails.is_valid_email("email").alias("valid"),
        emails.is_valid_email("email", rules.HARVEST_BLOCK_TERMS, bounds=(6, 120),
                              parts="last").alias("valid_harvest"),
        emails.is_valid_email("email", (), ()).alias("well_formed"))


@query("email_syntax", r"""
SELECT seq, email, regexp_matches(email, '^[A-Za-z0-9!#$%&''*+/=?^_`{|}~-]+(\.[A-Za-z0-9!#$%&''*+/=?^_`{|}~-]+)*@([A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z][A-Za-z0-9-]*$')
  AND length(split_part(email, '@', 1)) <= 64 AS ok FROM store""", uses="store")
def _(spark, sf):
    return store(spark, sf).select("seq", "email", emails.has_valid_syntax("email").alias("ok"))


def _role_sql(ruleset: str, field: int, rest: str) -> str:
    return "CASE " + " ".join(f"WHEN {sql_any('u', row[0])} THEN '{row[field]}'"
                              for row in rules.ROLE_RULES[ruleset]) + f" ELSE {rest} END"


_CAP = "upper(left({0}, 1)) || lower(substr({0}, 2))"


@query("role_from_local_part", f"""
SELECT seq, {_role_sql('worker', 1, "'Founder & Owner'")} AS title,
  {_role_sql('worker', 2, _CAP.format('p[1]'))} AS first_name,
  {_role_sql('worker', 3, f"coalesce({_CAP.format('p[2]')}, 'Founder')")} AS last_name,
  {_role_sql('crawl', 1, "'Founder & Owner'")} AS crawl_title
FROM (SELECT seq, u, string_split_regex(u, '[._-]') AS p
      FROM (SELECT seq, lower(split_part(trim(email), '@', 1)) AS u FROM store))""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).select("seq", F.trim("email").alias("email"))
    return rows.select("seq", emails.role_from_local("email").alias("r"),
                       emails.role_from_local("email", "crawl").alias("c")).select(
        "seq", "r.title", "r.first_name", "r.last_name", F.col("c.title").alias("crawl_title"))


@query("local_part_split", f"""
SELECT seq, {_CAP.format('p[1]')} AS first_name,
  coalesce({_CAP.format('p[2]')}, 'Owner') AS last_name
FROM (SELECT seq, string_split_regex(split_part(lower(trim(email)), '@', 1), '[._-]') AS p
      FROM store)""", uses="store")
def _(spark, sf):
    return store(spark, sf).select("seq", emails.split_local_name(
        emails.clean_email("email")).alias("n")).select("seq", "n.*")


@query("personal_inbox", f"""
SELECT seq, local NOT IN {tuple(rules.ROLE_INBOXES)} AND letters NOT IN {tuple(rules.ROLE_INBOXES)}
  AND (contains(local, '.') OR length(letters) >= 4) AS personal
FROM (SELECT seq, local, regexp_replace(local, '[^a-z]', '', 'g') AS letters
      FROM (SELECT seq, lower(split_part(trim(email), '@', 1)) AS local FROM store))""",
       uses="store")
def _(spark, sf):
    return store(spark, sf).select("seq", emails.is_personal(F.trim("email")).alias("personal"))


_N, _S = sql_list(FIRST), sql_list(STOPS)


@query("local_part_names", f"""
SELECT seq, CASE WHEN dotted THEN {_CAP.format('h[1]')}
    WHEN n IS NOT NULL THEN {_CAP.format('n')} WHEN alone THEN {_CAP.format('a')} END AS first_name,
  CASE WHEN dotted THEN {_CAP.format('h[2]')}
    WHEN n IS NOT NULL THEN {_CAP.format('substr(a, length(n) + 1)')}
    WHEN alone THEN '' END AS last_name,
  CASE WHEN dotted OR n IS NOT NULL THEN 'HIGH' WHEN alone THEN 'MEDIUM' END AS confidence
FROM (SELECT *,
    regexp_matches(local, '^[a-z]{{2,}}\\.[a-z]{{2,}}$')
      AND (list_contains({_N}, h[1]) OR length(h[1]) > 3) AS dotted,
    list_filter(list_sort({_N}), lambda x: length(x) >= 4 AND starts_with(a, x)
      AND length(a) - length(x) >= 3 AND NOT list_contains({_S}, substr(a, length(x) + 1)))[1] AS n,
    list_contains({_N}, a) AS alone
  FROM (SELECT seq, local, string_split(local, '.') AS h,
          regexp_replace(local, '[^a-z]', '', 'g') AS a
        FROM (SELECT seq, lower(split_part(trim(email), '@', 1)) AS local FROM store))
  WHERE a NOT IN {tuple(rules.ROLE_LOCAL_PARTS)})
WHERE dotted OR n IS NOT NULL OR alone""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).select("seq", names.parse_local_name(
        F.trim("email"), FIRST, STOPS).alias("p"))
    return rows.where("p IS NOT NULL").select("seq", "p.first_name", "p.last_name",
                                              "p.confidence")


@query("plausible_names", f"""
SELECT p_partkey, name, len(w) BETWEEN 1 AND 4
    AND (list_contains({_N}, lower(w[1])) OR length(w[1]) > 3)
    AND NOT list_has_any(list_transform(w, lambda x: lower(x)), {_S})
    AND NOT list_has_any(list_transform(w, lambda x: regexp_replace(lower(x), '(s|es|ed|ing|ers|er)$', '')), {_S})
    AND lower(w[len(w)]) <> lower(p_type)
    AND list_aggregate(list_transform(w, lambda x: regexp_matches(x, '^\\p{{L}}+$')), 'bool_and')
  AS plausible
FROM (SELECT p_partkey, p_type, name, string_split(name, ' ') AS w FROM (
  SELECT p_partkey, p_type,
    {sql_pick([x.title() for x in FIRST] + ['Shops', 'Bob2', 'Runner'], 'p_partkey')} || ' ' ||
    {sql_pick([x.title() for x in LAST] + ['Craft', 'Economy'], 'p_partkey // 3')} AS name
  FROM part))""")
def _(spark, sf):
    from contactloom.operators.generate import pick

    first = [x.title() for x in FIRST] + ["Shops", "Bob2", "Runner"]
    last = [x.title() for x in LAST] + ["Craft", "Economy"]
    rows = read(spark, sf, "part").select(
        "p_partkey", "p_type", F.concat_ws(" ", pick(first, F.col("p_partkey")), pick(
            last, F.floor(F.col("p_partkey") / 3))).alias("name"))
    return rows.select("p_partkey", "name", names.plausible_name(
        "name", FIRST, STOPS, brand=F.lower("p_type")).alias("plausible"))


@query("namesake_brands", f"""
SELECT seq, split_part(owner, ' ', 1) AS first_name, split_part(owner, ' ', 2) AS last_name
FROM (SELECT seq, owner, CASE WHEN seq % 3 = 0
        THEN lower(replace(owner, ' ', '')) || '.com' ELSE domain END AS site FROM store)
WHERE contains(split_part(site, '.', 1), lower(split_part(owner, ' ', 1)))
  AND contains(split_part(site, '.', 1), lower(split_part(owner, ' ', 2)))""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).withColumn("site", F.when(
        F.pmod("seq", F.lit(3)) == 0,
        F.concat(F.lower(F.replace("owner", F.lit(" "), F.lit(""))), F.lit(".com")))
        .otherwise(F.col("domain")))
    found = rows.select("seq", names.namesake("owner", "site", FIRST, STOPS).alias("p"))
    return found.where("p IS NOT NULL").select("seq", "p.first_name", "p.last_name")


@query("address_variants", """
SELECT seq, pos, email FROM (
  SELECT seq, unnest(v) AS email, unnest(range(len(v))) AS pos FROM (
    SELECT seq, [f || '@' || domain, f || '.' || l || '@' || domain, f || l || '@' || domain,
      left(f, 1) || l || '@' || domain, f || '.' || left(l, 1) || '@' || domain,
      l || '.' || f || '@' || domain, f || '_' || l || '@' || domain] AS v
    FROM (SELECT seq, domain, lower(split_part(owner, ' ', 1)) AS f,
            lower(split_part(owner, ' ', 2)) AS l FROM store)))""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).select("seq", names.address_variants(
        F.split_part("owner", F.lit(" "), F.lit(1)), F.split_part("owner", F.lit(" "), F.lit(2)),
        "domain").alias("v"))
    return rows.select("seq", F.posexplode("v").alias("pos", "email"))


@query("address_variants_older", """
SELECT seq, CASE seq % 3 WHEN 0 THEN f || '.' || l || '@' || domain
    WHEN 1 THEN f || '@' || domain ELSE 'founder@' || domain END AS first_form,
  CASE seq % 3 WHEN 0 THEN 6 WHEN 1 THEN 3 ELSE 4 END AS forms
FROM (SELECT seq, domain, lower(split_part(owner, ' ', 1)) AS f,
        lower(split_part(owner, ' ', 2)) AS l FROM store)""", uses="store")
def _(spark, sf):
    kind = F.pmod("seq", F.lit(3))
    first = F.when(kind < 2, F.split_part("owner", F.lit(" "), F.lit(1))).otherwise("")
    last = F.when(kind == 0, F.split_part("owner", F.lit(" "), F.lit(2))).otherwise("")
    rows = store(spark, sf).select("seq", names.address_variants(first, last, "domain", "older")
                                   .alias("v"))
    return rows.select("seq", F.get("v", F.lit(0)).alias("first_form"),
                       F.size("v").alias("forms"))


@query("email_hashes", """
SELECT seq, md5(lower(trim(email))) AS md5, sha256(lower(trim(email))) AS sha256,
  left(trim(email), 1) || '***@' || split_part(trim(email), '@', 2) AS masked
FROM store""", uses="store")
def _(spark, sf):
    return store(spark, sf).select(
        "seq", emails.email_hash("email").alias("md5"),
        emails.protect("email", "hash").alias("sha256"),
        emails.protect(F.trim("email"), "mask").alias("masked"))


@query("search_links", """
SELECT seq, 'https://www.facebook.com/ads/library/?active_status=active&ad_type=all&country=ALL&q='
    || replace(lower(owner), ' ', '%20') || '&search_type=keyword_unordered&media_type=all'
    AS keyword_url,
  'https://www.facebook.com/ads/library/?q=' || replace(owner, ' ', '%20') || '&type=all'
    AS short_url FROM store""", uses="store")
def _(spark, sf):
    return store(spark, sf).select("seq", domains.search_url("owner").alias("keyword_url"),
                                   domains.search_url("owner", "short").alias("short_url"))


def _case(column: str, table, default: str) -> str:
    def quote(v: str) -> str:
        return "'" + v.replace("'", "''") + "'"
    return (f"CASE {column} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}"
                                         for k, v in table.items())
            + f" ELSE {quote(default)} END")


_NICHE_SQL = sql_pick((*rules.CATEGORIES, "Other"), "seq")


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("category_texts", f"""
SELECT seq, replace(replace({_quote(rules.PHRASE_TEMPLATE)}, '{{phrase}}', phrase), '{{brand}}', owner)
    AS by_phrase, replace(template, '{{brand}}', owner) AS by_template
FROM (SELECT seq, owner, {_case('niche', rules.PHRASES, rules.PHRASE_DEFAULT)} AS phrase,
        {_case('niche', rules.TEMPLATES, rules.TEMPLATES[rules.GENERAL])} AS template
      FROM (SELECT seq, owner, {_NICHE_SQL} AS niche FROM store))""", uses="store")
def _(spark, sf):
    from contactloom.operators.generate import pick

    rows = store(spark, sf).withColumn("niche", pick((*rules.CATEGORIES, "Other"), F.col("seq")))
    return rows.select(
        "seq", classify.template_text(F.col("owner"), F.col("niche")).alias("by_phrase"),
        classify.template_text(F.col("owner"), F.col("niche"), "category")
        .alias("by_template"))


@query("page_platform", f"""
SELECT page_id, platform, platform <> 'Unknown' OR {sql_any('lower(html)', rules.SHOP_WORDS)}
    AS is_ecommerce, nullif(pixel, '') AS pixel_id,
  CASE WHEN pixel <> '' THEN '{rules.SIGNAL_HIGH}'
    WHEN {sql_any('html', rules.TRACKING_MARKERS)} THEN '{rules.SIGNAL_MEDIUM}'
    ELSE '{rules.SIGNAL_NONE}' END AS ad_signal
FROM (SELECT page_id, html, CASE WHEN {sql_any('html', rules.SHOP_MARKERS)} THEN 'Shopify'
    WHEN contains(html, 'wp-content') AND contains(html, 'woocommerce') THEN 'WooCommerce'
    WHEN contains(html, 'bigcommerce') THEN 'BigCommerce' ELSE 'Unknown' END AS platform,
  regexp_extract(html, 'fbq\\(\\s*[''"]init[''"]\\s*,\\s*[''"](\\d+)[''"]', 1) AS pixel
  FROM site_pages)""", uses="site_pages")
def _(spark, sf):
    return site_pages(spark, sf).select("page_id", html.platform_of("html").alias("p"),
                                        html.pixel_of("html").alias("x")).select(
        "page_id", "p.*", "x.*")


@query("page_titles", """
SELECT page_id, nullif(trim(regexp_extract(html, '(?i)<title[^>]*>([^<]{4,80})</title>', 1)), '')
  AS title FROM pages""")
def _(spark, sf):
    return read(spark, sf, "pages").select("page_id", html.title_of("html").alias("title"))


@query("page_title_lines", """
SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '(?i)<title[^>]*>([^<]{4,80})</title>', 1)),
  ''), 'Founder / Owner @ ' || domain) AS title FROM site_pages""", uses="site_pages")
def _(spark, sf):
    return site_pages(spark, sf).select("page_id", html.title_or_default("html", "domain")
                                        .alias("title"))


@query("plausible_names_older", f"""
SELECT seq, list_contains({_N}, lower(split_part(name, ' ', 1)))
  AND split_part(name, ' ', 2) NOT IN ('Shop', 'Team') AS plausible
FROM (SELECT seq, CASE seq % 3 WHEN 0 THEN owner WHEN 1 THEN split_part(owner, ' ', 1) || ' Shop'
  ELSE 'Q' || owner END AS name FROM store)""", uses="store")
def _(spark, sf):
    third = F.pmod("seq", F.lit(3))
    name = (F.when(third == 0, F.col("owner"))
            .when(third == 1, F.concat(F.split_part("owner", F.lit(" "), F.lit(1)),
                                       F.lit(" Shop")))
            .otherwise(F.concat(F.lit("Q"), "owner")))
    return store(spark, sf).select("seq", names.short_plausible_name(name, FIRST, STOPS)
                                   .alias("plausible"))


@query("deliverability_scores", f"""
SELECT domain, has_mx, 80 + CASE WHEN dmarc THEN 10 ELSE 0 END + CASE WHEN spf THEN 5 ELSE 0 END
    + CASE WHEN z = 1 THEN 5 ELSE 0 END AS inbox,
  least(100, 80 + CASE WHEN dmarc THEN 5 ELSE 0 END + CASE WHEN spf THEN 3 ELSE 0 END
    + CASE WHEN {INBOX_LABEL_SQL} IN ('Google Workspace', 'Microsoft 365') THEN 5 ELSE 0 END)
    AS candidate
FROM dns_flags""", uses="dns_flags")
def _(spark, sf):
    dns = match.collapse_dns(dns_answers(spark, sf))
    raw = dns_answers(spark, sf).groupBy("domain").agg(F.bool_or(
        (F.col("rtype") == "MX") & F.contains(F.col("data"), F.lit("zoho"))).alias("z"))
    return dns.join(raw, "domain").select(
        "domain", "has_mx",
        emails.deliverability("inbox", F.col("dmarc"), F.col("spf"), F.col("z")).alias("inbox"),
        emails.deliverability("candidate", F.col("dmarc"), F.col("spf"), base=F.lit(80),
                              provider=F.col("provider")).alias("candidate"))


@query("source_trust", f"""
SELECT doc_id, target, NOT contains(lower(target), '/pub/dir/') AND (
    contains(lower(target), domain) OR {sql_any('lower(target)', rules.TRUSTED_HOSTS)}
    OR NOT {sql_any('lower(target)', rules.DENIED_HOSTS)}) AS trusted,
  contains(lower(target), domain) OR {sql_any('lower(target)', rules.TRUSTED_HOSTS[:12])}
    AS strictly_trusted
FROM (SELECT doc_id, domain, CASE WHEN contains(url, '/RU=')
        THEN replace(replace(regexp_extract(url, '/RU=(.*?)/RK=', 1), '%3a', ':'), '%2f', '/')
        ELSE url END AS target FROM cards)""", uses="cards")
def _(spark, sf):
    rows = cards(spark, sf).withColumn("target", domains.unwrap("url"))
    return rows.select("doc_id", "target", domains.trusted("target", "domain").alias("trusted"),
                       domains.trusted("target", "domain", strict=True)
                       .alias("strictly_trusted"))


@query("card_grounding", """
SELECT doc_id, contains(lower(text), domain) OR contains(lower(text), split_part(domain, '.', 1))
    OR contains(lower(text), lower(brand)) AS grounded
FROM cards""", uses="cards")
def _(spark, sf):
    return cards(spark, sf).select("doc_id", domains.grounded("text", "domain", "brand", STOPS)
                                   .alias("grounded"))


@query("slugs", """
SELECT p_partkey, replace(replace(lower(p_name), ' & ', '_'), ' ', '_') AS slug FROM part""")
def _(spark, sf):
    return read(spark, sf, "part").select("p_partkey", slug("p_name").alias("slug"))


@query("category_tree_lookup", f"""
SELECT p.p_partkey, t.niche, t.sub_niche FROM part p
JOIN (SELECT unnest({sql_list([k for k, v in rules.CATEGORY_TREE.items() for _ in v])}) AS niche,
        unnest({sql_list([s for v in rules.CATEGORY_TREE.values() for s in v])}) AS sub_niche,
        unnest(range({sum(len(v) for v in rules.CATEGORY_TREE.values())})) AS n) t
  ON p.p_size % {sum(len(v) for v in rules.CATEGORY_TREE.values())} = t.n""")
def _(spark, sf):
    from contactloom.sources.readers import category_tree

    total = sum(len(v) for v in rules.CATEGORY_TREE.values())
    tree = category_tree(spark)
    starts, at = [], 0
    for subs in rules.CATEGORY_TREE.values():
        starts.append(at)
        at += len(subs)
    offset = F.element_at(F.array(*[F.lit(s) for s in starts]), F.col("niche_no") + 1)
    tree = tree.withColumn("n", offset + F.col("sub_no"))
    part = read(spark, sf, "part").withColumn("n", F.pmod("p_size", F.lit(total)))
    return part.join(F.broadcast(tree), "n").select("p_partkey", "niche", "sub_niche")


@query("address_cleanup", r"""
SELECT seq, lower(trim(trim(email), '.')) AS mention,
  regexp_replace(trim(email), '^/+', '') AS input
FROM (SELECT seq, CASE seq % 3 WHEN 0 THEN '//' || trim(email) WHEN 1 THEN trim(email) || '..'
  ELSE email END AS email FROM store)""", uses="store")
def _(spark, sf):
    raw = (F.when(F.pmod("seq", F.lit(3)) == 0, F.concat(F.lit("//"), F.trim("email")))
           .when(F.pmod("seq", F.lit(3)) == 1, F.concat(F.trim("email"), F.lit("..")))
           .otherwise(F.col("email")))
    return store(spark, sf).select("seq", emails.clean_email(raw).alias("mention"),
                                   emails.clean_email(raw, "input").alias("input"))


@query("brand_search_phrase", r"""
SELECT seq, CASE WHEN seq % 2 = 0 THEN owner ELSE brand END AS phrase,
  regexp_replace(owner, '[^a-zA-Z0-9]', '', 'g') AS key FROM store""", uses="store")
def _(spark, sf):
    even = F.pmod("seq", F.lit(2)) == 0
    raw = F.when(even, F.concat("owner", F.lit(" – official"))).otherwise(
        F.concat("brand", F.lit(" | shop")))
    return store(spark, sf).select(
        "seq", domains.brand_query(raw).alias("phrase"),
        domains.brand_key(F.concat("owner", F.lit(".store"))).alias("key"))


@query("handle_names", """
SELECT seq, CASE WHEN seq % 3 = 0 THEN NULL ELSE split_part(owner, ' ', 1) END AS first_name,
  CASE WHEN seq % 3 = 0 THEN NULL ELSE split_part(owner, ' ', 2) END AS last_name
FROM store""", uses="store")
def _(spark, sf):
    handle = F.replace("owner", F.lit(" "), F.lit(""))
    handle = F.when(F.pmod("seq", F.lit(3)) == 0, F.lower(handle)).otherwise(handle)
    return store(spark, sf).select("seq", names.handle_name(handle).alias("h")).select(
        "seq", "h.first_name", "h.last_name")


@query("canonical_socials", r"""
SELECT seq, CASE seq % 4 WHEN 0 THEN 'https://www.instagram.com/shop' || seq
    WHEN 1 THEN NULL WHEN 2 THEN 'https://x.com/shop' || seq ELSE NULL END AS link,
  CASE seq % 4 WHEN 0 THEN 'https://www.instagram.com/shop' || seq
    WHEN 1 THEN NULL WHEN 2 THEN 'https://x.com/shop' || seq ELSE NULL END AS harvest_link
FROM store""", uses="store")
def _(spark, sf):
    handle = F.concat(F.lit("shop"), F.col("seq").cast("string"))
    kind = F.pmod("seq", F.lit(4))
    link = (F.when(kind == 0, F.concat(F.lit("http://instagram.com/"), handle,
                                       F.lit("/?hl=en")))
            .when(kind == 1, F.lit("https://www.facebook.com/groups/1"))
            .when(kind == 2, F.concat(F.lit("https://www.twitter.com/"), handle))
            .otherwise(F.lit("https://www.tiktok.com/music/x")))
    rows = store(spark, sf).withColumn("raw", link)
    return rows.select(
        "seq", F.coalesce(*[social.canonical_social("raw", p) for p in rules.PLATFORMS])
        .alias("link"),
        F.coalesce(*[social.harvest_social("raw", p) for p in rules.PLATFORMS])
        .alias("harvest_link"))
