"""Lookups, dictionary matches, mail-domain facts, company names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import domains, emails, names
from contactloom.functions.text import alnum_fold, contains_any
from contactloom.operators.join import lookup


def collapse_dns(answers: DataFrame, ruleset: str = "inbox",
                 gate: bool = False) -> DataFrame:
    """One row per mail domain: MX flag, best host, provider, DMARC and SPF flags.

    Input rows: domain, rtype (MX, TXT, DMARC_TXT), pref, data. Provider rules look at all
    MX hosts of the domain at once, so each rule becomes one flag and nothing is
    collected. ``gate=True`` reports DMARC and SPF only where there is an MX.
    """
    is_mx = F.col("rtype") == "MX"
    host = F.lower("data")
    *table, default = rules.PROVIDER_RULES[ruleset]
    flags = [F.bool_or(is_mx & contains_any(host, terms)).alias(f"_p{i}")
             for i, (terms, _) in enumerate(table)]
    if ruleset == "fingerprint":  # judged by the best host alone
        flags = []
    folded = answers.groupBy("domain").agg(
        F.bool_or(is_mx).alias("has_mx"),
        F.min_by(F.when(is_mx, F.regexp_replace("data", r"\.$", "")),
                 F.when(is_mx, F.struct("pref", "data"))).alias("mx_host"),
        F.bool_or((F.col("rtype") == "DMARC_TXT")
                  & F.contains(F.col("data"), F.lit("v=DMARC1"))).alias("dmarc"),
        F.bool_or((F.col("rtype") == "TXT") & F.contains(host, F.lit("v=spf1"))).alias("spf"),
        *flags)
    label = F.lit(default)
    for i, (terms, name) in reversed(list(enumerate(table))):
        hit = (contains_any(F.lower("mx_host"), terms) if ruleset == "fingerprint"
               else F.col(f"_p{i}"))
        label = F.when(hit, F.lit(name)).otherwise(label)
    mx = F.coalesce(F.col("has_mx"), F.lit(False))

    def gated(flag: str) -> Column:
        value = F.coalesce(F.col(flag), F.lit(False))
        return (value & mx) if gate else value

    return folded.select("domain", mx.alias("has_mx"), "mx_host",
                         F.when(mx, label).otherwise(rules.NO_MX).alias("provider"),
                         gated("dmarc").alias("dmarc"), gated("spf").alias("spf"))


def provider_of(host: Column, ruleset: str) -> Column:
    """Provider label of one MX host text."""
    *table, default = rules.PROVIDER_RULES[ruleset]
    out = F.lit(default)
    for terms, label in reversed(table):
        out = F.when(contains_any(F.lower(host), terms), F.lit(label)).otherwise(out)
    return out


def known_provider(domain: Column, table: dict[str, str]) -> Column:
    """Label of a well-known mail domain, else NULL."""
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[domain]


def attach_dns(contacts: DataFrame, dns: DataFrame, email: str = "email",
               known: dict[str, str] = rules.KNOWN_PROVIDERS) -> DataFrame:
    """Contacts with the facts of their mail domain.

    Well-known mail domains, which hold the largest groups of addresses, are answered from
    the rule table; the others are joined to the collapsed DNS table. Adds
    mail_domain, has_mx, mx_host, provider, dmarc, spf.
    """
    rows = contacts.withColumn("mail_domain", emails.mail_domain(F.col(email)))
    listed = F.coalesce(F.col("mail_domain").isin(*known), F.lit(False))
    facts = dns.select(F.col("domain").alias("mail_domain"), "has_mx", "mx_host", "provider",
                       "dmarc", "spf")
    joined = lookup(rows, facts, "mail_domain", skip=listed)
    label = known_provider(F.col("mail_domain"), known)

    def flag(c: str) -> Column:
        return (listed | F.coalesce(F.col(c), F.lit(False))).alias(c)

    return joined.select(
        *rows.columns, flag("has_mx"), "mx_host",
        F.coalesce(label, "provider", F.lit(rules.NO_MX)).alias("provider"),
        flag("dmarc"), flag("spf"))


def deliverable(df: DataFrame) -> DataFrame:
    """Rows whose mail domain takes mail (after ``attach_dns``)."""
    return df.where("has_mx")


def status_texts(df: DataFrame) -> DataFrame:
    """Export texts of the DNS facts; no evidence reads ``unknown``, never valid."""
    return df.select(
        "*",
        F.when(F.col("has_mx"), F.concat(F.lit("Valid ("), F.col("provider"), F.lit(")")))
        .otherwise("unknown").alias("mx_status"),
        F.when(F.col("dmarc"), rules.DMARC_ON).otherwise(rules.DMARC_OFF).alias("dmarc_status"),
        F.when(F.col("spf"), rules.SPF_ON).otherwise(rules.SPF_OFF).alias("spf_status"))


def directory(df: DataFrame, dim: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Curated values of a directory table where it knows the key, else the row's own."""
    extra = dim.select(on, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = lookup(df, extra, on)
    keep = [c for c in df.columns if c not in columns]
    return joined.select(*keep, *[F.coalesce(f"_{c}", c).alias(c) for c in columns])


def reuse_per_key(df: DataFrame, key: str, compute) -> DataFrame:
    """Compute a costly result once per distinct key and hand it to all rows of the key."""
    return lookup(df, compute(df.select(key).distinct()), key)


def match_terms(df: DataFrame, words: Column, dim: DataFrame, term: str,
                how: str = "left_semi") -> DataFrame:
    """Rows of which one word is (``left_semi``) or none is (``left_anti``) in a dictionary.

    ``words`` is an array column. This is the way for dictionaries too large to travel
    inside the plan: words and dictionary meet in an ordinary equi-join.
    """
    keyed = df.withColumn("_words", F.array_distinct(words))
    vocabulary = keyed.select(F.explode("_words").alias("_w")).distinct()
    known = vocabulary.join(dim.select(F.col(term).alias("_w")).distinct(), "_w", "left_semi")
    ids = [F.xxhash64(*df.columns).alias("_h1"), F.hash(*df.columns).alias("_h2")]
    exploded = keyed.select(*ids, F.explode("_words").alias("_w"))
    found = lookup(exploded, known.withColumn("_hit", F.lit(True)), "_w").where("_hit")
    hits = found.select("_h1", "_h2").distinct()
    return df.select("*", *ids).join(hits, ["_h1", "_h2"], how).select(*df.columns)


def classify_by_table(df: DataFrame, key: str, words: Column, table: DataFrame,
                      default: str = rules.GENERAL) -> DataFrame:
    """Category by whole words out of a keyword table (term, prio, niche), first prio wins.

    For keyword lists that are data rather than rules: words and terms meet in an
    equi-join, whatever the size of the table. ``key`` identifies a row.
    """
    terms = table.groupBy("term").agg(F.min(F.struct("prio", "niche")).alias("_rule"))
    found = df.select(key, F.explode(F.array_distinct(words)).alias("term"))
    found = lookup(found, terms, "term")
    best = (found.where("_rule IS NOT NULL").groupBy(key)
            .agg(F.min("_rule")["niche"].alias("niche")))
    joined = lookup(df, best, key)
    return joined.withColumn("niche", F.coalesce("niche", F.lit(default)))


def confirm_candidates(people: DataFrame, profiles: DataFrame, key: str, k: int = 4,
                       form: str = "standard", given: str | None = None) -> DataFrame:
    """First of a person's top k address variants that was observed, per key.

    Input: key, first_name, last_name, domain. ``profiles``: email_hash, display_name.
    ``given`` names a column with an address that is tried before the variants. One with a
    display name goes before one without. Persons without a hit are not returned.
    """
    variants = names.address_variants("first_name", "last_name", "domain", form)
    if given is not None:
        first = F.coalesce(F.col(given), F.lit(""))
        variants = F.when((first == "") | F.array_contains(variants, first), variants).otherwise(
            F.concat(F.array(first), variants))
    rows = people.select(key, F.posexplode(F.slice(variants, 1, k)).alias("pos", "email"))
    rows = rows.withColumn("email_hash", emails.email_hash("email"))
    seen = profiles.groupBy("email_hash").agg(F.min("display_name").alias("display_name"))
    hits = lookup(rows, seen.withColumn("_hit", F.lit(True)), "email_hash").where("_hit")
    named = F.coalesce(F.col("display_name"), F.lit("")) != ""
    order = F.struct((~named).alias("unnamed"), F.col("pos").alias("pos"))
    best = hits.groupBy(key).agg(F.min_by(F.struct("email", "pos", "display_name"), order)
                                 .alias("b"))
    return best.select(key, "b.*")


def match_company(sites: DataFrame, companies: DataFrame, least: int = 4) -> DataFrame:
    """First company of a register (by number) that carries a site's brand or label.

    Abroad the folded company name must equal brand or label, plain or with a legal
    suffix, both of five letters at least. At home (uk) one name must contain the other, on
    at least ``least`` letters. Containment runs as an equi-join on the shorter name's rarest piece;
    the names that share it are compared.
    """
    site = sites.select("domain", "brand").distinct().select(
        "domain", "brand", alnum_fold("brand").alias("b"),
        alnum_fold(domains.stem("domain")).alias("s"),
        (F.endswith(F.lower(F.col("domain")), F.lit(".uk"))
         | (domains.country_from_tld("domain", "codes") == "UK")).alias("home"))
    first = F.min(F.struct("company_no", "name")).alias("hit")
    folded = companies.select("company_no", "name", alnum_fold("name").alias("c"))
    suffixes = F.array(F.lit(""), F.lit("ltd"), F.lit("limited"))

    def forms(x: str) -> Column:
        return F.transform(suffixes, lambda e: F.concat(F.col(x), e))

    away = site.where("NOT home AND length(b) >= 5 AND length(s) >= 5").select(
        "domain", "brand", "s",
        F.explode(F.array_distinct(F.concat(forms("b"), forms("s")))).alias("g"))
    away = away.where(F.contains("g", F.col("s"))).drop("s")
    whole = folded.groupBy(F.col("c").alias("g")).agg(first)
    equal = away.join(whole, "g").select("domain", "brand", "hit")

    # containment: the shorter name is found by its rarest piece of ``least`` letters, all of
    # which the longer one has; a name offers as many pieces as it has letters
    offered = folded.select("company_no", "name", "c", F.explode(_pieces("c", least)).alias("g"))
    count = offered.groupBy("g").agg(F.count("*").alias("n"))
    hit = F.struct("company_no", "name").alias("hit")

    def rarest(df: DataFrame, keys: list[str]) -> DataFrame:
        known = lookup(df, count, "g")
        return known.groupBy(*keys).agg(F.min_by("g", F.struct(
            F.coalesce("n", F.lit(0)).alias("n"), F.col("g").alias("t"))).alias("g"))

    near = site.where("home")
    own = near.select("domain", "brand", F.explode(F.array_distinct(F.filter(
        F.array("b", "s"), lambda x: F.length(x) >= least))).alias("own"))
    own = own.select("*", F.explode(_pieces("own", least)).alias("g"))
    inside = (rarest(own, ["domain", "brand", "own"]).join(offered, "g")
              .where(F.contains("c", F.col("own"))).select("domain", "brand", hit))
    longer = near.select("domain", "brand", "b", F.explode(_pieces("b", least)).alias("g"))
    around = (longer.join(rarest(offered, ["company_no", "name", "c"]), "g")
              .where(F.contains("b", F.col("c"))).select("domain", "brand", hit))
    return (equal.unionByName(inside).unionByName(around).groupBy("domain", "brand")
            .agg(F.min("hit").alias("hit")).select("domain", "brand", "hit.*"))


def _pieces(name: str, least: int) -> Column:
    """All distinct substrings of ``least`` letters."""
    text = F.col(name)
    starts = F.sequence(F.lit(1), F.length(text) - least + 1)
    return F.array_distinct(F.when(F.length(text) >= least, F.transform(
        starts, lambda i: F.substr(text, i, F.lit(least)))))
