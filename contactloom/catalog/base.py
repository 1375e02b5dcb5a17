"""Registry of queries and their SQL counterparts, and the tables they read.

The driver tables hold no store registry, DNS answers, contact files or social links.
The inputs of those operators are derived here, row by row, from the whole driver tables;
each derivation exists twice, as Spark columns and as a SQL common table expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.functions.domains import clean_domain, stem
from contactloom.operators.generate import pick
from contactloom.session import importable, spread

Runner = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Runner] = {}
ORACLES: dict[str, str] = {}

FIRST = ("anna", "james", "maria", "peter", "laura", "david", "sofia", "thomas")
LAST = ("miller", "novak", "garcia", "weber", "rossi")
STOPS = ("shop", "store", "team", "brand", "number", "press", "market", "run", "craft")
TLDS = (".com", ".co.uk", ".de", ".in", ".com.au", ".ca", ".us", ".shop")
TAGS = ("vitamin c", "gold chain", "leather wallet", "skin serum", "denim shirt", "steel",
        "tea pot", "running shoe", "herbal mix", "pet bed", "watch strap", "none")
ENGINES = ("yahoo", "ddg", "bing")


def query(name: str, sql: str | None = None, uses: str = "") -> Callable[[Runner], Runner]:
    """Register a runner; ``uses`` names the derived tables its SQL reads."""
    def add(run: Runner) -> Runner:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql, uses)
        return run

    return add


def with_tables(sql: str, uses: str) -> str:
    names: list[str] = []
    for name in uses.split():
        for needed in [*NEEDS.get(name, ()), name]:
            if needed not in names:
                names.append(needed)
    if not names:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({TABLES_SQL[n].strip()})" for n in names)
    body = sql.strip()
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(head):
            return f"WITH RECURSIVE {ctes},\n{body[len(head):]}"
    return f"WITH RECURSIVE {ctes}\n{body}"


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf}/{name}.parquet")


def read_texts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of long texts, spread over the cores if it has too few splits."""
    return spread(read(spark, sf, name))


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_pick(values, index: str) -> str:
    return f"({sql_list(values)})[1 + ({index}) % {len(values)}]"


def sql_any(text: str, terms) -> str:
    """Any of the terms occurs in the text, without regular expressions."""
    return "(" + " OR ".join(
        "contains({}, '{}')".format(text, t.replace("'", "''")) for t in terms) + ")"


TABLES_SQL: dict[str, str] = {}
NEEDS: dict[str, tuple[str, ...]] = {}


# ------------------------------------------------------------------ stores, contacts
def store_domain(key: Column) -> Column:
    return F.concat(F.lit("shop"), key.cast("string"), pick(TLDS, key))


def store(spark: SparkSession, sf: str) -> DataFrame:
    """customer as stores with one contact each."""
    c = read(spark, sf, "customer")
    key = F.col("c_custkey")
    first, last, domain = pick(FIRST, key), pick(LAST, key), store_domain(key)
    kind = F.pmod(key, F.lit(7))
    email = (F.when(kind == 0, F.concat(F.lit("info@"), domain))
             .when(kind == 1, F.concat(first, F.lit("."), last, F.lit("@"), domain))
             .when(kind == 2, F.concat(F.lit(" Support@"), domain))
             .when(kind == 3, F.concat(first, last, F.lit("@"), domain))
             .when(kind == 4, F.concat(F.lit("press-team@"), domain))
             .when(kind == 5, F.concat(first, key.cast("string"), F.lit("@gmail.com")))
             .otherwise(F.concat(last, F.lit("."), first, F.lit("@mail"), key.cast("string"),
                                 F.lit(".net"))))
    return c.select(
        key.alias("seq"), domain.alias("domain"), email.alias("email"),
        F.concat_ws(" ", F.initcap(first), F.initcap(last)).alias("owner"),
        F.initcap("c_mktsegment").alias("brand"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))


TABLES_SQL["store"] = f"""
SELECT seq, domain, owner, brand, segment, nation, balance,
  CASE seq % 7 WHEN 0 THEN 'info@' || domain
    WHEN 1 THEN f || '.' || l || '@' || domain
    WHEN 2 THEN ' Support@' || domain
    WHEN 3 THEN f || l || '@' || domain
    WHEN 4 THEN 'press-team@' || domain
    WHEN 5 THEN f || seq || '@gmail.com'
    ELSE l || '.' || f || '@mail' || seq || '.net' END AS email
FROM (SELECT c_custkey AS seq, 'shop' || c_custkey || {sql_pick(TLDS, 'c_custkey')} AS domain,
        {sql_pick(FIRST, 'c_custkey')} AS f, {sql_pick(LAST, 'c_custkey')} AS l,
        {sql_pick([x.title() for x in FIRST], 'c_custkey')} || ' '
          || {sql_pick([x.title() for x in LAST], 'c_custkey')} AS owner,
        upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS brand,
        c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS balance
      FROM customer)
"""


def dns_answers(spark: SparkSession, sf: str) -> DataFrame:
    """orders as DNS answer rows of the stores' domains."""
    o = read(spark, sf, "orders")
    prio = F.substring("o_orderpriority", 1, 1)
    mx = (F.when(prio == "1", "ASPMX.L.google.com.")
          .when(prio == "2", "x.mail.protection.outlook.com.").when(prio == "3", "mx.zoho.eu")
          .when(prio == "4", F.concat(F.lit("mx"), F.col("o_orderkey").cast("string"),
                                      F.lit(".hosting.example")))
          .otherwise("us-smtp.mimecast.com"))
    spf = (F.when(prio < "3", "V=SPF1 include:x").when(prio == "3", "v=spf1 -all")
           .otherwise("site-verification=1"))
    dmarc = (F.when(prio < "3", "v=DMARC1; p=none").when(prio == "3", "v=dmarc1; p=none")
             .otherwise("none"))
    return o.select(
        store_domain(F.col("o_custkey")).alias("domain"),
        F.when(F.col("o_orderstatus") == "F", "MX").when(F.col("o_orderstatus") == "O", "TXT")
        .otherwise("DMARC_TXT").alias("rtype"),
        F.pmod("o_orderkey", F.lit(50)).cast("int").alias("pref"),
        F.when(F.col("o_orderstatus") == "F", mx).when(F.col("o_orderstatus") == "O", spf)
        .otherwise(dmarc).alias("data"))


TABLES_SQL["dns_answers"] = f"""
SELECT 'shop' || o_custkey || {sql_pick(TLDS, 'o_custkey')} AS domain,
  CASE o_orderstatus WHEN 'F' THEN 'MX' WHEN 'O' THEN 'TXT' ELSE 'DMARC_TXT' END AS rtype,
  CAST(o_orderkey % 50 AS INTEGER) AS pref,
  CASE o_orderstatus WHEN 'F' THEN CASE left(o_orderpriority, 1)
      WHEN '1' THEN 'ASPMX.L.google.com.' WHEN '2' THEN 'x.mail.protection.outlook.com.'
      WHEN '3' THEN 'mx.zoho.eu' WHEN '4' THEN 'mx' || o_orderkey || '.hosting.example'
      ELSE 'us-smtp.mimecast.com' END
    WHEN 'O' THEN CASE WHEN left(o_orderpriority, 1) < '3' THEN 'V=SPF1 include:x'
      WHEN left(o_orderpriority, 1) = '3' THEN 'v=spf1 -all' ELSE 'site-verification=1' END
    ELSE CASE WHEN left(o_orderpriority, 1) < '3' THEN 'v=DMARC1; p=none'
      WHEN left(o_orderpriority, 1) = '3' THEN 'v=dmarc1; p=none' ELSE 'none' END END AS data
FROM orders
"""

TABLES_SQL["dns_flags"] = """
SELECT domain, max(CASE WHEN rtype = 'MX' THEN 1 ELSE 0 END) = 1 AS has_mx,
  max(CASE WHEN rtype = 'MX' AND contains(lower(data), 'google') THEN 1 ELSE 0 END) AS g,
  max(CASE WHEN rtype = 'MX' AND (contains(lower(data), 'outlook')
      OR contains(lower(data), 'microsoft')) THEN 1 ELSE 0 END) AS m,
  max(CASE WHEN rtype = 'MX' AND contains(lower(data), 'zoho') THEN 1 ELSE 0 END) AS z,
  max(CASE WHEN rtype = 'MX' AND contains(lower(data), 'mimecast') THEN 1 ELSE 0 END) AS c,
  max(CASE WHEN rtype = 'DMARC_TXT' AND contains(data, 'v=DMARC1') THEN 1 ELSE 0 END) = 1
    AS dmarc,
  max(CASE WHEN rtype = 'TXT' AND contains(lower(data), 'v=spf1') THEN 1 ELSE 0 END) = 1 AS spf
FROM dns_answers GROUP BY domain
"""
NEEDS["dns_flags"] = ("dns_answers",)
INBOX_LABEL_SQL = ("CASE WHEN NOT has_mx THEN 'No MX' WHEN g = 1 THEN 'Google Workspace' "
                   "WHEN m = 1 THEN 'Microsoft 365' WHEN z = 1 THEN 'Zoho Mail' "
                   "ELSE 'Host MX' END")


# ------------------------------------------------------------------------ registry
def registry(spark: SparkSession, sf: str) -> DataFrame:
    """part as registry rows; every domain comes from two sources."""
    p = read(spark, sf, "part")
    half = F.floor(F.col("p_partkey") / 2).cast("string")
    return p.select(
        F.concat(F.lit("item-"), half, F.lit(".com")).alias("domain"),
        F.col("p_name").alias("brand"),
        F.concat_ws(" ", "p_type", pick(TAGS, F.col("p_size"))).alias("tags"),
        F.col("p_brand").alias("tech"), F.lit("11-50").alias("employees"),
        F.pmod("p_partkey", F.lit(2)).cast("int").alias("source_prio"),
        F.col("p_partkey").alias("seq"))


TABLES_SQL["registry"] = f"""
SELECT 'item-' || (p_partkey // 2) || '.com' AS domain, p_name AS brand,
  p_type || ' ' || {sql_pick(TAGS, 'p_size')} AS tags, p_brand AS tech, '11-50' AS employees,
  CAST(p_partkey % 2 AS INTEGER) AS source_prio, p_partkey AS seq
FROM part
"""


# ---------------------------------------------------------------------------- pages
def site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """pages with a contact block at the end; the block varies with the page."""
    p = read_texts(spark, sf, "pages").select(
        "page_id", "url", "html", clean_domain("url").alias("domain"))
    number = F.col("page_id").cast("string")
    domain, label = F.col("domain"), stem("domain")
    hidden = F.array_join(F.transform(
        F.split(F.concat(F.lit("mail@"), domain), ""),
        lambda c: F.lpad(F.lower(F.hex(F.ascii(c).bitwiseXOR(F.lit(42)))), 2, "0")), "")

    def block(*pieces) -> Column:
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in pieces])

    kind = F.pmod("page_id", F.lit(6))
    extra = (
        F.when(kind == 0, block(
            '<a href="mailto:Info@', domain, '?subject=Hi">Mail</a> sales@', domain,
            '. <a href="https://www.instagram.com/', label, '/?hl=en">ig</a>'))
        .when(kind == 1, block(
            '<a href="https://www.facebook.com/sharer/sharer.php?u=x">s</a>'
            '<a href="https://facebook.com/groups/x">g</a><a href="https://www.facebook.com/',
            label, '">f</a> Write to owner', number, '@mail', number,
            '.net or logo@2x.png'))
        .when(kind == 2, block(
            '<a href="/pages/contact-us">Contact</a><a href="https://twitter.com/intent/tweet">'
            't</a><a href="https://x.com/', label, '_x">x</a> hello@partner', number, '.org'))
        .when(kind == 3, block(
            'team&#64;', F.replace(domain, F.lit("."), F.lit("&#46;")),
            ' <a href="https://www.tiktok.com/@', label, '.tok?lang=en">t</a>'
            "<script>fbq('init', '", number, "');</script>"))
        .when(kind == 4, block(
            '<span data-cfemail="2a', hidden, '"></span><script src="https://cdn.shopify.com/x">'
            '</script> <a href="https://facebook.com/tr?id=', number, '">p</a>'))
        .otherwise(block(
            '<a href="https://www.linkedin.com/company/', label, '/">l</a>'
            '<a href="https://www.youtube.com/@AnnaMiller">y</a>'
            '<script type="application/ld+json">{"@type":["Organization"],"founder":'
            '[{"name":"Anna Miller', number, '"},{"name":"Peter Weber"}]}</script>')))
    return p.select(
        "page_id", "url", "domain", F.pmod("page_id", F.lit(4)).cast("int").alias("path_no"),
        F.when(F.pmod("page_id", F.lit(11)) == 0, 429)
        .when(F.pmod("page_id", F.lit(11)) == 1, 404).otherwise(200).alias("status"),
        F.concat("html", extra).alias("html"))


TABLES_SQL["site_pages"] = r"""
SELECT page_id, url, domain, CAST(page_id % 4 AS INTEGER) AS path_no,
  CASE page_id % 11 WHEN 0 THEN 429 WHEN 1 THEN 404 ELSE 200 END AS status,
  html || CASE page_id % 6
    WHEN 0 THEN '<a href="mailto:Info@' || domain || '?subject=Hi">Mail</a> sales@' || domain
      || '. <a href="https://www.instagram.com/' || label || '/?hl=en">ig</a>'
    WHEN 1 THEN '<a href="https://www.facebook.com/sharer/sharer.php?u=x">s</a><a href="https://facebook.com/groups/x">g</a><a href="https://www.facebook.com/'
      || label || '">f</a> Write to owner' || page_id || '@mail' || page_id
      || '.net or logo@2x.png'
    WHEN 2 THEN '<a href="/pages/contact-us">Contact</a><a href="https://twitter.com/intent/tweet">t</a><a href="https://x.com/'
      || label || '_x">x</a> hello@partner' || page_id || '.org'
    WHEN 3 THEN 'team&#64;' || replace(domain, '.', '&#46;')
      || ' <a href="https://www.tiktok.com/@' || label
      || '.tok?lang=en">t</a><script>fbq(''init'', ''' || page_id || ''');</script>'
    WHEN 4 THEN '<span data-cfemail="2a' || list_aggregate(list_transform(
        string_split('mail@' || domain, ''),
        lambda c: printf('%02x', xor(ascii(c), 42))), 'string_agg', '')
      || '"></span><script src="https://cdn.shopify.com/x"></script> <a href="https://facebook.com/tr?id='
      || page_id || '">p</a>'
    ELSE '<a href="https://www.linkedin.com/company/' || label
      || '/">l</a><a href="https://www.youtube.com/@AnnaMiller">y</a><script type="application/ld+json">{"@type":["Organization"],"founder":[{"name":"Anna Miller'
      || page_id || '"},{"name":"Peter Weber"}]}</script>' END AS html
FROM (SELECT *, split_part(domain, '.', 1) AS label FROM (SELECT page_id, url, html,
  split_part(regexp_replace(lower(trim(url)), '^(https://)?(http://)?(www\.)?', ''), '/', 1)
    AS domain FROM pages))
"""


# ------------------------------------------------------------------------- evidence
SOURCES = ("author_api", "email", "namesake", "site", "search", "registry", "profile")
TIERS = (0.0, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0)


def evidence_rows(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as evidence about the order's domain."""
    li = read(spark, sf, "lineitem")
    tier = F.element_at(F.array(*[F.lit(t) for t in TIERS]), F.col("l_linenumber"))
    return li.select(
        F.concat(F.lit("site"), F.col("l_orderkey").cast("string"), F.lit(".com"))
        .alias("domain"), tier.alias("tier"),
        F.pmod("l_partkey", F.lit(3)).cast("long").alias("pos"),
        F.when(F.col("l_returnflag") == "R", "HIGH").when(F.col("l_returnflag") == "A", "MEDIUM")
        .when(F.col("l_quantity") > 45, "VERIFIED").otherwise("MEDIUM").alias("conf"),
        F.initcap(pick(FIRST, F.col("l_suppkey"))).alias("first_name"),
        F.when(F.col("l_returnflag") == "A", F.lit(""))
        .otherwise(F.initcap(pick(LAST, F.col("l_partkey")))).alias("last_name"),
        F.element_at(F.array(*[F.lit(s) for s in SOURCES]), F.col("l_linenumber"))
        .alias("source"))


TABLES_SQL["evidence_rows"] = f"""
SELECT 'site' || l_orderkey || '.com' AS domain,
  ([{', '.join(str(t) for t in TIERS)}])[l_linenumber]::DOUBLE AS tier, l_partkey % 3 AS pos,
  CASE WHEN l_returnflag = 'R' THEN 'HIGH' WHEN l_returnflag = 'A' THEN 'MEDIUM'
    WHEN l_quantity > 45 THEN 'VERIFIED' ELSE 'MEDIUM' END AS conf,
  {sql_pick([x.title() for x in FIRST], 'l_suppkey')} AS first_name,
  CASE WHEN l_returnflag = 'A' THEN ''
    ELSE {sql_pick([x.title() for x in LAST], 'l_partkey')} END AS last_name,
  ({sql_list(SOURCES)})[l_linenumber] AS source
FROM lineitem
"""


# --------------------------------------------------------------------------- visits
def visits(spark: SparkSession, sf: str) -> DataFrame:
    """events as visits to the stores' sites."""
    e = read(spark, sf, "events")
    user = F.col("user_id")
    domain = F.when(F.pmod("event_id", F.lit(97)) == 0, "localhost").otherwise(
        store_domain(user))
    kind = F.col("event_type")
    status = (F.when(kind == "purchase", "429")
              .when((kind == "error") & (F.col("value") < 10), "timeout")
              .when(kind == "error", "503").otherwise("200"))
    return e.select(
        F.col("event_id").alias("seq"), domain.alias("domain"), status.alias("http_status"),
        F.when(status == "200", "<html>page</html>").alias("html"),
        (F.pmod("event_id", F.lit(4)) + 1).cast("int").alias("attempt"),
        F.col("ts").cast("timestamp").alias("visited_at"))


TABLES_SQL["visits"] = f"""
SELECT *, CASE WHEN http_status = '200' THEN '<html>page</html>' END AS html FROM (
  SELECT event_id AS seq, CASE WHEN event_id % 97 = 0 THEN 'localhost'
      ELSE 'shop' || user_id || {sql_pick(TLDS, 'user_id')} END AS domain,
    CASE WHEN event_type = 'purchase' THEN '429'
      WHEN event_type = 'error' AND value < 10 THEN 'timeout'
      WHEN event_type = 'error' THEN '503' ELSE '200' END AS http_status,
    CAST(event_id % 4 + 1 AS INTEGER) AS attempt, ts AS visited_at
  FROM events)
"""


# ---------------------------------------------------------------------------- cards
def cards(spark: SparkSession, sf: str) -> DataFrame:
    """documents as search cards, three engines per site."""
    d = read_texts(spark, sf, "documents")
    key = F.col("doc_id")
    site = F.floor(key / 3).cast("string")
    domain = F.concat(F.lit("craftsite"), site, F.lit(".com"))
    first = F.initcap(pick(FIRST, F.floor(key / 2)))
    last = F.initcap(pick(LAST, F.floor(key / 2)))
    kind = F.pmod(key, F.lit(5))
    url = (F.when(kind == 0, F.concat(F.lit("https://"), domain, F.lit("/about")))
           .when(kind == 1, F.concat(F.lit("https://www.linkedin.com/in/x"), site))
           .when(kind == 2, F.concat(F.lit("https://r.search.example/RU=https%3a%2f%2fnews"),
                                     site, F.lit(".example%2fp/RK=2/RS=x")))
           .when(kind == 3, F.concat(F.lit("https://whois.example/"), domain))
           .otherwise("https://en.wikipedia.org/wiki/Craft"))
    lead = F.when(F.pmod(key, F.lit(4)) == 3, "").otherwise(F.concat(
        F.lit("Welcome. Founded by "), first, F.lit(" "), last, F.lit(". Write to "),
        F.lower(first), F.lit("@"), domain, F.lit(" now. ")))
    return d.select(
        key.alias("doc_id"), domain.alias("domain"),
        F.concat(F.lit("Craftsite "), site).alias("brand"),
        pick(ENGINES, key).alias("engine"),
        F.pmod(key, F.lit(3)).cast("int").alias("engine_rank"), key.alias("pos"),
        url.alias("url"), F.concat(lead, F.col("text")).alias("text"))


TABLES_SQL["cards"] = f"""
SELECT doc_id, domain, 'Craftsite ' || site AS brand, {sql_pick(ENGINES, 'doc_id')} AS engine,
  CAST(doc_id % 3 AS INTEGER) AS engine_rank, doc_id AS pos,
  CASE doc_id % 5 WHEN 0 THEN 'https://' || domain || '/about'
    WHEN 1 THEN 'https://www.linkedin.com/in/x' || site
    WHEN 2 THEN 'https://r.search.example/RU=https%3a%2f%2fnews' || site || '.example%2fp/RK=2/RS=x'
    WHEN 3 THEN 'https://whois.example/' || domain
    ELSE 'https://en.wikipedia.org/wiki/Craft' END AS url,
  CASE WHEN doc_id % 4 = 3 THEN '' ELSE 'Welcome. Founded by ' || f || ' ' || l
    || '. Write to ' || lower(f) || '@' || domain || ' now. ' END || text AS text
FROM (SELECT doc_id, text, CAST(doc_id // 3 AS VARCHAR) AS site,
  'craftsite' || (doc_id // 3) || '.com' AS domain,
  {sql_pick([x.title() for x in FIRST], 'doc_id // 2')} AS f,
  {sql_pick([x.title() for x in LAST], 'doc_id // 2')} AS l FROM documents)
"""
