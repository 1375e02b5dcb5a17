"""Joins, DNS facts, person resolution, audit, reports and generated rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from contactloom import rules
from contactloom.catalog.base import (FIRST, INBOX_LABEL_SQL, LAST, NEEDS, STOPS, TABLES_SQL,
                                      cards, dns_answers, evidence_rows, query, read, registry,
                                      site_pages, sql_any, sql_list, sql_pick, store,
                                      store_domain, visits)
from contactloom.catalog.extraction import _VOTES_SQL
from contactloom.functions import emails, names
from contactloom.operators import (audit, contacts, extract, generate, match, people, rank,
                                   report)
from contactloom.operators.generate import pick
from contactloom.plans import flows

# --------------------------------------------------------------------------- lookups


@query("dns_facts", f"""
SELECT domain, has_mx, {INBOX_LABEL_SQL} AS provider, dmarc, spf, dmarc AND has_mx AS dmarc_gated,
  spf AND has_mx AS spf_gated FROM dns_flags""", uses="dns_flags")
def _(spark, sf):
    answers = dns_answers(spark, sf)
    plain = match.collapse_dns(answers)
    gated = match.collapse_dns(answers, gate=True).select(
        "domain", F.col("dmarc").alias("dmarc_gated"), F.col("spf").alias("spf_gated"))
    return plain.drop("mx_host").join(gated, "domain")


@query("dns_provider_sets", """
SELECT domain, CASE WHEN NOT has_mx THEN 'No MX' WHEN g = 1 THEN 'Google Workspace'
    WHEN m = 1 THEN 'Microsoft 365' WHEN z = 1 THEN 'Zoho Mail' WHEN c = 1 THEN 'Enterprise Gateway'
    ELSE 'Custom/Host MX' END AS verifier,
  CASE WHEN NOT has_mx THEN 'No MX' WHEN g = 1 THEN 'Google Workspace'
    WHEN m = 1 THEN 'Microsoft 365' WHEN z = 1 THEN 'Zoho Mail' WHEN c = 1 THEN 'Mimecast'
    ELSE 'Host MX' END AS harvest
FROM dns_flags""", uses="dns_flags")
def _(spark, sf):
    answers = dns_answers(spark, sf)
    one, two = (match.collapse_dns(answers, r).select("domain", F.col("provider").alias(r))
                for r in ("verifier", "harvest"))
    return one.join(two, "domain")


_KNOWN = "(" + ", ".join(f"'{d}'" for d in rules.KNOWN_PROVIDERS) + ")"

TABLES_SQL["contact_facts"] = f"""
SELECT seq, s.domain, email, mail_domain,
  CASE WHEN mail_domain IN {_KNOWN} THEN true ELSE coalesce(has_mx, false) END AS has_mx,
  CASE WHEN mail_domain IN {_KNOWN} THEN 'Google Workspace'
    WHEN has_mx IS NULL THEN 'No MX' ELSE {INBOX_LABEL_SQL} END AS provider,
  CASE WHEN mail_domain IN {_KNOWN} THEN true ELSE coalesce(dmarc, false) END AS dmarc,
  CASE WHEN mail_domain IN {_KNOWN} THEN true ELSE coalesce(spf, false) END AS spf
FROM (SELECT *, split_part(email, '@', 2) AS mail_domain FROM store) s
LEFT JOIN dns_flags d ON s.mail_domain = d.domain
"""
NEEDS["contact_facts"] = ("store", "dns_answers", "dns_flags")


def contact_facts(spark, sf):
    rows = store(spark, sf).select("seq", "domain", "email")
    return match.attach_dns(rows, match.collapse_dns(dns_answers(spark, sf))).drop("mx_host")


@query("contacts_with_dns", "SELECT * FROM contact_facts", uses="contact_facts")
def _(spark, sf):
    return contact_facts(spark, sf)


@query("deliverable_contacts", """
SELECT seq, email, 'Valid (' || provider || ')' AS mx_status,
  CASE WHEN dmarc THEN 'Configured (v=DMARC1)' ELSE 'Not Configured' END AS dmarc_status,
  CASE WHEN spf THEN 'Configured' ELSE 'None' END AS spf_status
FROM contact_facts WHERE has_mx""", uses="contact_facts")
def _(spark, sf):
    return match.status_texts(match.deliverable(contact_facts(spark, sf))).select(
        "seq", "email", "mx_status", "dmarc_status", "spf_status")


@query("directory_lookup", """
SELECT seq, CASE WHEN s_suppkey IS NOT NULL THEN s_name ELSE owner END AS owner,
  CASE WHEN s_suppkey IS NOT NULL THEN 'Director' ELSE 'Founder' END AS title
FROM store LEFT JOIN supplier ON seq = s_suppkey""", uses="store")
def _(spark, sf):
    dim = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("seq"),
                                             F.col("s_name").alias("owner"),
                                             F.lit("Director").alias("title"))
    rows = store(spark, sf).select("seq", "owner", F.lit("Founder").alias("title"))
    return match.directory(rows, dim, "seq", ["owner", "title"])


@query("result_reuse_per_domain", """
SELECT o_orderkey, o_custkey, n FROM orders
JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) USING (o_custkey)""")
def _(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey")

    def compute(keys):
        return orders.join(keys, "o_custkey", "left_semi").groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"))

    return match.reuse_per_key(orders, "o_custkey", compute)


@query("dictionary_semi_join", """
SELECT p_partkey, p_name FROM part WHERE list_has_any(string_split(p_name, ' '),
  (SELECT list(DISTINCT lower(p_type)) FROM part))""")
def _(spark, sf):
    part = read(spark, sf, "part").select("p_partkey", "p_name")
    dim = read(spark, sf, "part").select(F.lower("p_type").alias("word"))
    return match.match_terms(part, F.split("p_name", " "), dim, "word")


@query("dictionary_anti_join", """
SELECT p_partkey, p_name FROM part WHERE NOT list_has_any(string_split(p_name, ' '),
  (SELECT list(DISTINCT lower(p_type)) FROM part))""")
def _(spark, sf):
    part = read(spark, sf, "part").select("p_partkey", "p_name")
    dim = read(spark, sf, "part").select(F.lower("p_type").alias("word"))
    return match.match_terms(part, F.split("p_name", " "), dim, "word", "left_anti")


_FALLBACK_ROWS = [(t, i, c) for i, (c, terms) in enumerate(rules.FALLBACK_KEYWORDS)
                  for t in terms]


@query("classify_by_keyword_table", f"""
SELECT seq, coalesce((SELECT arg_min(k.niche, k.prio) FROM (
    SELECT unnest({sql_list([r[0] for r in _FALLBACK_ROWS])}) AS term,
      unnest({[r[1] for r in _FALLBACK_ROWS]}) AS prio,
      unnest({sql_list([r[2] for r in _FALLBACK_ROWS])}) AS niche) k
  WHERE list_contains(string_split(tags || ' ' || brand, ' '), k.term)), '{rules.GENERAL}') AS niche
FROM registry""", uses="registry")
def _(spark, sf):
    from contactloom.sources.readers import keyword_dim

    table = keyword_dim(spark).where("ruleset = 'fallback'")
    rows = registry(spark, sf).select("seq", "tags", "brand")
    return match.classify_by_table(rows, "seq", F.split(F.concat_ws(" ", "tags", "brand"), " "),
                                   table).select("seq", "niche")


@query("host_containment", f"""
SELECT doc_id, url FROM cards WHERE {sql_any('lower(url)', rules.DENIED_HOSTS)}""", uses="cards")
def _(spark, sf):
    from contactloom.functions.text import contains_any

    return cards(spark, sf).where(contains_any(F.lower("url"), rules.DENIED_HOSTS)).select(
        "doc_id", "url")


def _profiles(spark, sf):
    """Profiles of the stores' own addresses; some carry a name."""
    s = store(spark, sf)
    return s.select(emails.email_hash("email").alias("email_hash"), F.when(
        F.pmod("seq", F.lit(2)) == 0, F.col("owner")).otherwise("").alias("display_name"))


@query("confirmed_candidates", """
SELECT seq, email, pos, display_name FROM (
  SELECT seq, trim(email) AS email, CASE seq % 7 WHEN 1 THEN 1 WHEN 3 THEN 2 END AS pos,
    CASE WHEN seq % 2 = 0 THEN owner ELSE '' END AS display_name FROM store)
WHERE pos IS NOT NULL""", uses="store")
def _(spark, sf):
    persons = store(spark, sf).select(
        "seq", "domain", F.split_part("owner", F.lit(" "), F.lit(1)).alias("first_name"),
        F.split_part("owner", F.lit(" "), F.lit(2)).alias("last_name"))
    return match.confirm_candidates(persons, _profiles(spark, sf), "seq")


@query("company_matches", """
WITH site AS (SELECT DISTINCT domain, owner AS brand, lower(replace(owner, ' ', '')) AS b,
    split_part(domain, '.', 1) AS s, ends_with(domain, '.uk') AS home FROM store),
  company AS (SELECT 'C' || s_suppkey AS company_no, 'Shop' || s_suppkey
    || CASE s_suppkey % 3 WHEN 0 THEN ' Ltd.' WHEN 1 THEN '' ELSE ' Holding' END AS name
    FROM supplier),
  folded AS (SELECT *, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS c FROM company)
SELECT domain, brand, min(company_no) AS company_no, arg_min(name, company_no) AS name
FROM site JOIN folded ON CASE WHEN home
    THEN contains(c, b) AND length(b) >= 4 OR contains(b, c) AND length(c) >= 4
      OR contains(c, s) AND length(s) >= 4
    ELSE length(b) >= 5 AND length(s) >= 5 AND c IN (b, b || 'ltd', b || 'limited', s, s || 'ltd',
      s || 'limited') AND contains(c, s) END GROUP BY domain, brand""",
       uses="store")
def _(spark, sf):
    third = F.pmod("s_suppkey", F.lit(3))
    companies = read(spark, sf, "supplier").select(
        F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("company_no"),
        F.concat(F.lit("Shop"), F.col("s_suppkey").cast("string"),
                 F.when(third == 0, " Ltd.").when(third == 1, "").otherwise(" Holding"))
        .alias("name"))
    sites = store(spark, sf).select("domain", F.col("owner").alias("brand"))
    return match.match_company(sites, companies)


# ---------------------------------------------------------------------------- people
@query("name_votes", f"""
SELECT domain, first_name, last_name, votes, first_engine,
  CASE WHEN votes >= 2 THEN 'VERIFIED' ELSE 'HIGH' END AS conf FROM (
  SELECT domain, first_name, last_name, count(*) AS votes, min(engine_rank) AS first_engine
  FROM ({_VOTES_SQL}) GROUP BY domain, first_name, last_name)
QUALIFY row_number() OVER (PARTITION BY domain ORDER BY votes DESC, first_engine, first_name,
  last_name) = 1""", uses="cards")
def _(spark, sf):
    return people.vote(extract.card_votes(cards(spark, sf), FIRST, STOPS))


@query("votes_over_lineitem", f"""
SELECT domain, first_name, last_name, votes, first_engine,
  CASE WHEN votes >= 2 THEN 'VERIFIED' ELSE 'HIGH' END AS conf FROM (
  SELECT domain, first_name, last_name, count(*) AS votes, min(tier) AS first_engine
  FROM evidence_rows GROUP BY domain, first_name, last_name)
QUALIFY row_number() OVER (PARTITION BY domain ORDER BY votes DESC, first_engine, first_name,
  last_name) = 1""", uses="evidence_rows")
def _(spark, sf):
    return people.vote(evidence_rows(spark, sf), engine_rank="tier")


@query("evidence_waterfall", """
WITH f AS (SELECT domain, tier, source, min(pos) AS pos,
      arg_min([first_name, last_name, conf], [lpad(CAST(pos AS VARCHAR), 9, '0'), first_name, last_name,
          CASE conf WHEN 'VERIFIED' THEN '0' ELSE '1' END])
        FILTER (WHERE conf IN ('HIGH', 'VERIFIED')) AS s,
      min(pos) FILTER (WHERE conf IN ('HIGH', 'VERIFIED')) AS sp,
      arg_min([first_name, last_name, conf], [lpad(CAST(pos AS VARCHAR), 9, '0'), first_name, last_name,
          CASE conf WHEN 'VERIFIED' THEN '0' ELSE '1' END])
        FILTER (WHERE conf = 'MEDIUM') AS w
    FROM evidence_rows GROUP BY domain, tier, source),
  b AS (SELECT domain, min(tier) FILTER (WHERE s IS NOT NULL) AS st,
      arg_min(s, tier) FILTER (WHERE s IS NOT NULL) AS s,
      arg_min(source, tier) FILTER (WHERE s IS NOT NULL) AS ss,
      min(tier) FILTER (WHERE w IS NOT NULL) AS wt,
      arg_min(w, tier) FILTER (WHERE w IS NOT NULL) AS w,
      arg_min(source, tier) FILTER (WHERE w IS NOT NULL) AS ws FROM f GROUP BY domain)
SELECT f.domain, coalesce(any_value(b.s)[1], any_value(b.w)[1]) AS first_name,
  coalesce(any_value(b.s)[2], any_value(b.w)[2]) AS last_name,
  coalesce(any_value(b.s)[3], any_value(b.w)[3]) AS confidence,
  coalesce(any_value(b.ss), any_value(b.ws)) AS source,
  coalesce(any_value(b.st), any_value(b.wt)) AS tier,
  string_agg(f.source, '|' ORDER BY f.tier) FILTER (WHERE b.st IS NULL OR f.tier <= b.st)
    AS source_chain
FROM f JOIN b USING (domain) GROUP BY f.domain""", uses="evidence_rows")
def _(spark, sf):
    return people.waterfall(evidence_rows(spark, sf))


@query("confidence_order", """
SELECT domain, CASE WHEN bool_or(conf = 'VERIFIED') THEN 'VERIFIED' WHEN bool_or(conf = 'HIGH')
  THEN 'HIGH' ELSE 'MEDIUM' END AS best FROM evidence_rows GROUP BY domain""",
       uses="evidence_rows")
def _(spark, sf):
    return evidence_rows(spark, sf).groupBy("domain").agg(
        F.max_by("conf", names.confidence_rank("conf")).alias("best"))


@query("stronger_of_two", """
SELECT domain, tier, pos, source, CASE WHEN conf = 'VERIFIED' THEN 'VERIFIED' ELSE 'HIGH' END AS best
FROM evidence_rows""", uses="evidence_rows")
def _(spark, sf):
    return evidence_rows(spark, sf).select("domain", "tier", "pos", "source",
                                           names.max_confidence("conf", F.lit("HIGH"))
                                           .alias("best"))


def _people_inputs(spark, sf):
    return store(spark, sf).select("domain", F.col("owner").alias("brand"), "email",
                                   F.lit("").alias("secondary_email"), "seq")


@query("address_evidence", f"""
SELECT domain, CASE k WHEN 6 THEN l ELSE f END AS first_name,
  CASE k WHEN 6 THEN f WHEN 5 THEN '' ELSE l END AS last_name,
  CASE k WHEN 5 THEN 'MEDIUM' ELSE 'HIGH' END AS conf
FROM (SELECT domain, seq % 7 AS k, split_part(owner, ' ', 1) AS f, split_part(owner, ' ', 2) AS l
      FROM store)
WHERE k IN (1, 3, 5, 6)""", uses="store")
def _(spark, sf):
    rows = _people_inputs(spark, sf).withColumn("brand", F.lit(""))
    return people.address_evidence(rows, ["email", "secondary_email"], FIRST, STOPS).select(
        "domain", "first_name", "last_name", "conf")


@query("people_per_store", f"""
WITH base AS (SELECT seq, domain, seq % 7 AS k, split_part(owner, ' ', 1) AS f,
    split_part(owner, ' ', 2) AS l, s_suppkey FROM store LEFT JOIN supplier ON seq = s_suppkey)
SELECT seq, domain,
  CASE WHEN k = 6 THEN l WHEN k IN (1, 3, 5) THEN f WHEN s_suppkey IS NOT NULL THEN 'Grace'
    ELSE '' END AS first_name,
  CASE WHEN k = 6 THEN f WHEN k IN (1, 3) THEN l WHEN s_suppkey IS NOT NULL THEN 'Tanaka'
    ELSE '' END AS last_name,
  CASE WHEN k IN (1, 3, 6) THEN 'HIGH' WHEN s_suppkey IS NOT NULL THEN 'HIGH'
    WHEN k = 5 THEN 'MEDIUM' ELSE 'STANDARD' END AS confidence
FROM base WHERE NOT (k = 5 AND s_suppkey IS NOT NULL)
UNION ALL SELECT seq, domain, 'Grace', 'Tanaka', 'HIGH' FROM base
  WHERE k = 5 AND s_suppkey IS NOT NULL""", uses="store")
def _(spark, sf):
    inputs = _people_inputs(spark, sf).withColumn("brand", F.lit(""))
    registered = read(spark, sf, "supplier").select(
        "s_suppkey", F.lit("Grace").alias("first_name"), F.lit("Tanaka").alias("last_name"))
    joined = inputs.join(registered, inputs.seq == registered.s_suppkey)
    tier = people.evidence(joined, 4.0, "registry", "HIGH")
    return flows.enrich_people(inputs, [tier], FIRST, STOPS).select(
        "seq", "domain", "first_name", "last_name", "confidence")


@query("people_from_all_sources", """
WITH base AS (SELECT seq, domain, brand, trim(email) AS email, seq % 7 AS k, s_suppkey,
    split_part(owner, ' ', 1) AS f, split_part(owner, ' ', 2) AS l, nation, balance FROM store
    LEFT JOIN supplier ON seq = s_suppkey)
SELECT seq, domain, CASE src WHEN 'address' THEN CASE WHEN k = 6 THEN l ELSE f END
    WHEN 'registration' THEN 'Grace' WHEN 'profile' THEN f WHEN 'address1' THEN f
    WHEN 'author' THEN 'Laura' WHEN 'site' THEN 'Sofia' ELSE '' END AS first_name,
  CASE src WHEN 'address' THEN CASE WHEN k = 6 THEN f ELSE l END WHEN 'registration' THEN 'Tanaka'
    WHEN 'profile' THEN l WHEN 'author' THEN 'Lindqvist' WHEN 'site' THEN 'Okafor' ELSE '' END
    AS last_name,
  CASE src WHEN 'none' THEN 'STANDARD' WHEN 'address1' THEN 'MEDIUM' ELSE 'HIGH' END AS confidence,
  email AS person_email, profile_found
FROM (SELECT *, CASE WHEN nation = 1 THEN 'author' WHEN k IN (1, 3, 6) THEN 'address'
    WHEN nation = 2 THEN 'site' WHEN s_suppkey IS NOT NULL THEN 'registration'
    WHEN k = 5 THEN 'address1' WHEN profile_found THEN 'profile' ELSE 'none' END AS src
  FROM (SELECT *, balance > 4000 AS profile_found FROM base))""", uses="store")
def _(spark, sf):
    s = store(spark, sf)
    inputs = s.select("seq", "domain", "email", F.lit("").alias("brand"),
                      F.lit("").alias("secondary_email"))
    api = s.where("nation = 1").select("domain", F.lit('[{"name":"Laura Lindqvist"}]')
                                       .alias("body"))
    about = s.where("nation = 2").select(
        "domain", F.lit(0).alias("path_no"),
        F.lit("<nav>Founder: Peter Nowhere</nav><p>Founded by Sofia Okafor.</p>").alias("html"))
    registered = read(spark, sf, "supplier").select(
        store_domain(F.col("s_suppkey")).alias("domain"), F.lit("text").alias("kind"),
        F.lit("Domain: x\nRegistrant Name: Grace Tanaka\n").alias("body"))
    profiles = s.where("balance > 4000").select(emails.email_hash("email").alias("email_hash"),
                                             F.col("owner").alias("display_name"))
    out = flows.people_from_sources(inputs, FIRST, STOPS, profiles, author_api=api, pages=about,
                                    registrations=registered)
    return out.select("seq", "domain", "first_name", "last_name", "confidence", "person_email",
                      "profile_found")


# ----------------------------------------------------------------------------- audit
TABLES_SQL["visit_candidates"] = """
SELECT domain, lower(trim(email)) AS email, 85 AS score, 0 AS pos FROM store
WHERE segment <> 'MACHINERY'
UNION ALL SELECT domain, 'sales@' || domain, 100, 1 FROM store WHERE segment = 'BUILDING'
"""
NEEDS["visit_candidates"] = ("store",)


def visit_candidates(spark, sf):
    s = store(spark, sf)
    one = s.where("segment <> 'MACHINERY'").select(
        "domain", F.lower(F.trim("email")).alias("email"), F.lit(85).alias("score"),
        F.lit(0).alias("pos"))
    two = s.where("segment = 'BUILDING'").select(
        "domain", F.concat(F.lit("sales@"), "domain").alias("email"),
        F.lit(100).alias("score"), F.lit(1).alias("pos"))
    return one.unionByName(two)


TABLES_SQL["fresh_offers"] = f"""
SELECT domain, email, place, provider, has_mx FROM (
  SELECT u.domain, u.email,
    row_number() OVER (PARTITION BY u.domain ORDER BY score DESC, pos, u.email) AS place,
    split_part(u.email, '@', 2) IN {_KNOWN} OR coalesce(has_mx, false) AS has_mx,
    CASE WHEN split_part(u.email, '@', 2) IN {_KNOWN} THEN 'Google Workspace'
      WHEN has_mx IS NULL THEN 'No MX' ELSE {INBOX_LABEL_SQL} END AS provider
  FROM visit_candidates u LEFT JOIN dns_flags f ON f.domain = split_part(u.email, '@', 2)
  WHERE u.email NOT IN (SELECT 'info@shop' || s_suppkey || '.com' FROM supplier)
    AND u.email NOT IN (SELECT lower(trim(email)) FROM store WHERE nation = 3)
  QUALIFY row_number() OVER (PARTITION BY u.domain, u.email ORDER BY score DESC, pos) = 1)
"""
NEEDS["fresh_offers"] = ("store", "visit_candidates", "dns_answers", "dns_flags")
# Sites one after another by their first readable visit, with the addresses taken so far.
TABLES_SQL["site_turns"] = """
SELECT domain, min(seq) AS turn, row_number() OVER (ORDER BY min(seq)) AS k FROM visits
WHERE html IS NOT NULL AND http_status <> '429' AND contains(domain, '.')
  AND domain NOT IN (SELECT domain FROM store WHERE balance > 9000)
GROUP BY domain
"""
NEEDS["site_turns"] = ("visits", "store")
TABLES_SQL["site_offers"] = """
SELECT k, turn, domain, list({'email': email, 'provider': provider, 'has_mx': has_mx}
    ORDER BY place) AS offers
FROM site_turns JOIN fresh_offers USING (domain) GROUP BY ALL
"""
NEEDS["site_offers"] = (*NEEDS["site_turns"], *NEEDS["fresh_offers"], "site_turns",
                        "fresh_offers")
TABLES_SQL["numbered_offers"] = """
SELECT *, row_number() OVER (ORDER BY k) AS n FROM site_offers
"""
NEEDS["numbered_offers"] = (*NEEDS["site_offers"], "site_offers")
TABLES_SQL["in_turn"] = """
SELECT 0::BIGINT AS n, NULL::VARCHAR AS domain, NULL::BIGINT AS turn,
  NULL::STRUCT(email VARCHAR, provider VARCHAR, has_mx BOOLEAN) AS pick, []::VARCHAR[] AS taken
UNION ALL
SELECT n, domain, turn, pick, CASE WHEN pick.has_mx THEN list_append(taken, pick.email)
    ELSE taken END
FROM (SELECT o.n, o.domain, o.turn, taken,
    list_filter(offers, lambda x: NOT list_contains(taken, x.email))[1] AS pick
  FROM in_turn JOIN numbered_offers o ON o.n = in_turn.n + 1)
"""
NEEDS["in_turn"] = (*NEEDS["numbered_offers"], "numbered_offers")
TABLES_SQL["audited"] = """
SELECT v.seq, v.domain, v.http_status,
  CASE WHEN why = '' OR why LIKE 'no_mx:%' OR why LIKE 'duplicate_email%' THEN emails_found END
    AS emails_found,
  CASE WHEN why = '' OR why LIKE 'no_mx:%' THEN pick.email END AS primary_email,
  CASE WHEN why = '' OR why LIKE 'no_mx:%' THEN pick.provider END AS mx_provider,
  CASE WHEN why = '' THEN 'YES' ELSE 'NO' END AS qualified, why AS rejection_reason
FROM (SELECT v.*, c.emails_found, t.pick,
    CASE WHEN NOT contains(v.domain, '.') THEN 'invalid_domain'
      WHEN v.domain IN (SELECT domain FROM store WHERE balance > 9000)
        OR t.pick.has_mx AND v.seq > t.turn THEN 'duplicate_domain'
      WHEN html IS NULL AND http_status = 'timeout' THEN 'timeout'
      WHEN html IS NULL THEN 'no_html:' || http_status
      WHEN emails_found IS NULL THEN 'no_email_found'
      WHEN t.pick IS NULL THEN 'duplicate_email'
      WHEN NOT t.pick.has_mx THEN 'no_mx:' || split_part(t.pick.email, '@', 2) ELSE '' END
      AS why
  FROM visits v
  LEFT JOIN (SELECT domain, string_agg(email, ', ' ORDER BY pos) AS emails_found
    FROM visit_candidates GROUP BY domain) c ON v.domain = c.domain
  LEFT JOIN in_turn t ON v.domain = t.domain
  WHERE v.http_status <> '429') v
"""
NEEDS["audited"] = (*NEEDS["in_turn"], "in_turn")


def audited(spark, sf):
    s = store(spark, sf)
    seen_emails = (s.where("nation = 3").select(F.lower(F.trim("email")).alias("email"))
                   .unionByName(read(spark, sf, "supplier").select(F.concat(
                       F.lit("info@shop"), F.col("s_suppkey").cast("string"), F.lit(".com"))
                       .alias("email"))))
    return audit.audit(
        visits(spark, sf).select("seq", "domain", "http_status", "html"),
        visit_candidates(spark, sf), match.collapse_dns(dns_answers(spark, sf)),
        s.where("balance > 9000").select("domain"), seen_emails, rules.KNOWN_PROVIDERS)


@query("visit_audit", "SELECT * FROM audited", uses="audited")
def _(spark, sf):
    return audited(spark, sf).select("seq", "domain", "http_status", "emails_found",
                                     "primary_email", "mx_provider", "qualified",
                                     "rejection_reason")


@query("audit_totals", """
SELECT count(*) AS visited, count(*) FILTER (WHERE qualified = 'YES') AS qualified,
  count(*) FILTER (WHERE qualified = 'NO') AS rejected,
  count(*) FILTER (WHERE rejection_reason LIKE 'no_mx%') AS no_mx FROM audited""", uses="audited")
def _(spark, sf):
    return report.qualified_totals(audited(spark, sf))


@query("rejection_breakdown", """
SELECT rejection_reason, count(*) AS n FROM audited WHERE qualified = 'NO' GROUP BY 1
ORDER BY n DESC, rejection_reason LIMIT 20""", uses="audited")
def _(spark, sf):
    return report.rejection_report(audited(spark, sf))


@query("sites_without_mx", """
SELECT seq, domain, rejection_reason FROM audited WHERE rejection_reason LIKE 'no_mx%'
ORDER BY seq LIMIT 500""", uses="audited")
def _(spark, sf):
    return report.no_mx_rows(audited(spark, sf), 500, ["seq"]).select(
        "seq", "domain", "rejection_reason")


@query("retry_queue", """
SELECT seq, CASE WHEN http_status = '429' AND attempt < 3 THEN attempt + 1 ELSE attempt END AS attempt,
  http_status = '429' AND attempt < 3 AS again FROM visits""", uses="visits")
def _(spark, sf):
    queued, final = audit.retry_split(visits(spark, sf))
    return (queued.withColumn("again", F.lit(True))
            .unionByName(final.withColumn("again", F.lit(False)))
            .select("seq", "attempt", "again"))


# --------------------------------------------------------------------------- reports
@query("rows_per_category", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    return report.count_by(read(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("confidence_mix", """
SELECT count(*) AS rows, count(*) FILTER (WHERE conf = 'VERIFIED') AS verified,
  count(*) FILTER (WHERE conf = 'HIGH') AS high, count(*) FILTER (WHERE conf = 'MEDIUM') AS medium,
  0 AS standard, count(*) FILTER (WHERE last_name <> '') AS named,
  round(100.0 * count(*) FILTER (WHERE last_name <> '') / count(*), 2) AS named_pct
FROM evidence_rows""", uses="evidence_rows")
def _(spark, sf):
    return report.confidence_mix(evidence_rows(spark, sf).select(
        F.col("conf").alias("confidence"), F.col("last_name").alias("full_name")))


@query("coverage_counts", """
SELECT count(*) AS rows, count(*) FILTER (WHERE dmarc) AS dmarc, count(*) FILTER (WHERE spf) AS spf,
  count(*) FILTER (WHERE provider <> '') AS provider FROM contact_facts""", uses="contact_facts")
def _(spark, sf):
    return report.coverage(contact_facts(spark, sf), ["dmarc", "spf", "provider"])


@query("distinct_contact_counts", """
SELECT count(DISTINCT l_partkey) AS n_l_partkey, count(DISTINCT l_suppkey) AS n_l_suppkey,
  count(DISTINCT l_orderkey) AS n_l_orderkey FROM lineitem""")
def _(spark, sf):
    return report.distinct_counts(read(spark, sf, "lineitem"),
                                  ["l_partkey", "l_suppkey", "l_orderkey"])


@query("worker_progress", """
SELECT sum(scanned)::BIGINT AS scanned, sum(found)::BIGINT AS found,
  round(sum(scanned) / 120.0, 4) AS speed, round(100.0 * sum(scanned) / 200000, 4) AS pct,
  round(greatest(0, 200000 - sum(scanned)) / (sum(scanned) / 120.0) / 60, 4) AS eta_min
FROM (SELECT user_id, count(*) AS scanned, count(*) FILTER (WHERE event_type = 'purchase') AS found
      FROM events GROUP BY user_id)""")
def _(spark, sf):
    workers = read(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("event_type") == "purchase").alias("found"))
    return report.progress(workers, F.lit(200000), F.lit(120.0))


@query("quality_report", """
SELECT count(*) AS rows, count(*) FILTER (WHERE known AND ok) AS known_pass,
  round(100.0 * count(*) FILTER (WHERE known AND ok) / count(*) FILTER (WHERE known), 4) AS accuracy,
  count(*) FILTER (WHERE err) AS errors, count(*) FILTER (WHERE issues > 0) AS with_issues,
  round(avg(seconds), 4) AS mean_seconds, CASE WHEN count(*) FILTER (WHERE err) > 0 THEN 'fix errors'
    WHEN 100.0 * count(*) FILTER (WHERE known AND ok) / count(*) FILTER (WHERE known) >= 70
    THEN 'ready' ELSE 'review' END AS verdict
FROM (SELECT l_linenumber <= 4 AS known, l_returnflag = 'X' AS err,
  l_discount > 0.02 OR l_linenumber > 5 AS ok, CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END AS issues,
  l_tax AS seconds FROM lineitem)""")
def _(spark, sf):
    li = read(spark, sf, "lineitem")
    answer = F.when(F.col("l_discount") > 0.02, "Anna Weber").otherwise("Nobody")
    rows = li.select(
        F.when(F.col("l_linenumber") <= 5, F.array(F.lit("WEBER"), F.lit("rossi")))
        .alias("expected"), answer.alias("answer"),
        F.when(F.col("l_returnflag") == "X", "error").alias("error"),
        F.when(F.col("l_quantity") > 40, 1).otherwise(0).alias("issues"),
        F.col("l_tax").alias("seconds"), (F.col("l_linenumber") <= 4).alias("known"))
    return report.quality_report(rows)


@query("field_issues", """
SELECT seq, CASE WHEN trim(email) = '' THEN 1 ELSE 0 END
  + CASE WHEN brand = 'Machinery' THEN 1 ELSE 0 END AS issues FROM store""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).withColumn("name", F.concat_ws(" ", "owner", "brand"))
    return report.field_issues(rows, ["email", "domain"], "name", ("machinery",)).select(
        "seq", "issues")


# ---------------------------------------------------------------------- default fill
@query("filled_defaults", """
SELECT seq, CASE seq % 2 WHEN 0 THEN brand ELSE upper(left(l, 1)) || substr(l, 2) END AS company,
  'https://' || domain AS website, upper(left(u, 1)) || lower(substr(u, 2)) AS first_name,
  'Founder' AS last_name, 'Founder / Owner' AS title, 'unknown' AS mx_status, 'unknown' AS score
FROM (SELECT seq, brand, domain, split_part(domain, '.', 1) AS l,
        split_part(trim(email), '@', 1) AS u FROM store)""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).select(
        "seq", F.trim("email").alias("email"),
        F.when(F.pmod("seq", F.lit(2)) == 0, F.col("brand")).otherwise(" ").alias("company"),
        F.concat(F.lit("https://"), "domain").alias("website"), F.lit("").alias("mx_status"))
    return contacts.fill_defaults(rows).select("seq", "company", "website", "first_name",
                                               "last_name", "title", "mx_status", "score")


@query("filled_inbox_defaults", f"""
SELECT seq, 'Founder' AS first_name, coalesce(nullif(split_part(owner, ' ', 2), ''), 'Team')
  AS last_name, 'Founder / Marketing Lead' AS title, 'United States' AS country,
  CASE WHEN seq % 6 < 5 THEN {sql_pick((*rules.CATEGORIES, 'Other'), 'seq')}
    ELSE 'Fashion & Apparel' END AS niche FROM store""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).select(
        "seq", F.lit("").alias("first_name"),
        F.split_part("owner", F.lit(" "), F.lit(2)).alias("last_name"),
        pick((*rules.CATEGORIES, "Other"), F.col("seq")).alias("niche"))
    return contacts.fill_inbox_defaults(rows)


# ------------------------------------------------------------------------- end to end
@query("contacts_from_pages", f"""
WITH cand AS (SELECT page_id, domain, path_no, CASE page_id % 6 WHEN 0 THEN 'info@' || domain
      WHEN 1 THEN 'owner' || page_id || '@mail' || page_id || '.net'
      WHEN 2 THEN 'hello@partner' || page_id || '.org' END AS email,
    CASE page_id % 6 WHEN 0 THEN 100 WHEN 1 THEN 60 WHEN 2 THEN 85 END AS score, 0 AS ord
    FROM site_pages
  UNION ALL SELECT page_id, domain, path_no, 'sales@' || domain, 100, 1 FROM site_pages
    WHERE page_id % 6 = 0)
SELECT DISTINCT email, 'https://' || domain AS website FROM cand
WHERE email IS NOT NULL AND NOT contains(email, 'example.com')
  AND split_part(email, '@', 2) IN (SELECT domain FROM site_pages WHERE status = 200)""",
       uses="site_pages")
def _(spark, sf):
    base = site_pages(spark, sf)
    answers = base.select(
        "domain", F.when(F.col("status") == 200, "MX").otherwise("TXT").alias("rtype"), F.lit(10).alias("pref"),
        F.lit("mx.zoho.eu").alias("data"))
    stores = rank.first_wins(base, ["domain"], ["page_id"]).select(
        "domain", F.lit(None).cast("string").alias("brand"), F.lit("Jewelry").alias("niche"))
    return flows.pages_to_contacts(base, stores, answers).select("email", "website")


# --------------------------------------------------------------------- generated rows
_WORDS = {"first": [x.title() for x in FIRST], "last": [x.title() for x in LAST],
          "prefix": ["Botanic", "Flora", "Craft", "Earth"], "suffix": ["Living", "Home", "Studio"],
          "title": ["Founder", "Owner"], "country": ["United States", "Canada", "Germany"]}


@query("generated_rows", f"""
SELECT p_partkey AS i, {sql_pick(_WORDS['first'], 'p_partkey')} AS first_name,
  {sql_pick(_WORDS['last'], '(p_partkey * 7 + 3)')} AS last_name, p || ' ' || s AS company,
  lower(p) || lower(s) || '.example' AS domain, true AS synthetic, 'unknown' AS mx_status
FROM (SELECT p_partkey, {sql_pick(_WORDS['prefix'], 'p_partkey')} AS p,
        {sql_pick(_WORDS['suffix'], 'p_partkey // 4')} AS s FROM part)""")
def _(spark, sf):
    numbered = read(spark, sf, "part").select(F.col("p_partkey").alias("i"))
    return generate.label_rows(numbered, "i", _WORDS).select(
        "i", "first_name", "last_name", "company", "domain", "synthetic", "mx_status")


@query("top_up_to_target", """
SELECT segment, seq, source_prio FROM (
  SELECT segment, seq, source_prio, row_number() OVER (PARTITION BY segment
    ORDER BY source_prio, seq) AS r FROM (
    SELECT segment, seq, source_prio FROM (
      SELECT segment, seq, lower(trim(email)) AS email, 0 AS source_prio FROM store
        WHERE nation < 5
      UNION ALL SELECT segment, seq, lower(trim(email)), 1 FROM store)
    QUALIFY row_number() OVER (PARTITION BY email ORDER BY source_prio, seq) = 1))
WHERE r <= 120""", uses="store")
def _(spark, sf):
    rows = store(spark, sf).select("segment", "seq", "nation",
                                   F.lower(F.trim("email")).alias("email"))
    return generate.top_up(rows.where("nation < 5"), rows, 120, "segment", ["seq"]).select(
        "segment", "seq", "source_prio")
