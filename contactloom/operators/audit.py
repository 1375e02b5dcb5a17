"""Visit audit: one row per visited site, one reason at most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions import emails
from contactloom.functions.text import blank_to_null
from contactloom.operators import match, rank
from contactloom.operators.join import lookup
from contactloom.session import materialise


def retry_split(visits: DataFrame, status: str = "http_status", attempts: int = 3,
                attempt: str = "attempt") -> tuple[DataFrame, DataFrame]:
    """Throttled visits to queue again, and those that are final. None is lost."""
    again = F.coalesce((F.col(status) == "429") & (F.col(attempt) < attempts), F.lit(False))
    queued = visits.where(again).withColumn(attempt, F.col(attempt) + 1)
    return queued, visits.where(~again)


def ok_pages(pages: DataFrame, floor: int = 0, exact: bool = False, status: str = "status",
             markup: str = "html") -> DataFrame:
    """Pages that came back well (status below 400, or 200 only) and are long enough."""
    fine = F.col(status) == 200 if exact else F.col(status) < 400
    return pages.where(fine & (F.length(markup) > floor))


def ranked_fresh(candidates: DataFrame, seen_emails: DataFrame, key: str = "domain"
                 ) -> DataFrame:
    """New addresses of each site with their place, best first: ``key, email, score, place``."""
    unique = rank.first_wins(candidates, [key, "email"], [F.col("score").desc(), F.col("pos")])
    fresh = rank.exclude_seen(unique, seen_emails, ["email"])
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), "pos", "email")
    return fresh.withColumn("place", F.row_number().over(order)).drop("pos")


def accept_in_turn(offers: DataFrame) -> DataFrame:
    """The address that each site ends with when sites choose one after another.

    ``offers``: domain, turn, email, place, has_mx and what else is known of the address.
    Sites come in the order of ``turn``; each takes its first address that no earlier one has
    accepted, and accepts it if its domain takes mail. Rather than site by site this is
    settled in rounds: each site names its first address, an address stays with the earliest
    site that names it, the others go on to their next. As all addresses prefer the earlier
    site, the rounds end with the outcome of the sequence. A site left without an address has
    no row.
    """
    offers = materialise(offers)
    refused = None
    while True:
        left = offers if refused is None else offers.join(refused, ["domain", "email"],
                                                          "left_anti")
        named = rank.first_wins(left, ["domain"], ["place"])
        held = named.where("has_mx").groupBy("email").agg(F.min("turn").alias("_first"))
        late = (named.where("has_mx").join(held, "email").where(F.col("turn") > F.col("_first"))
                .select("domain", "email"))
        late = materialise(late)
        if late.isEmpty():
            return named
        refused = late if refused is None else materialise(refused.union(late))


def reason(domain: Column, duplicate: Column, blank: Column, status: Column, found: Column,
           primary: Column, has_mx: Column, error: Column | None = None) -> Column:
    """The first thing that stopped a visit; blank for a qualified one."""
    none = F.lit(None).cast("string")
    out = (F.when(~F.contains(F.coalesce(domain, F.lit("")), F.lit(".")), "invalid_domain")
           .when(duplicate, "duplicate_domain")
           .when(blank & (F.coalesce(status, F.lit("timeout")) == "timeout"), "timeout")
           .when(blank, F.concat(F.lit("no_html:"), status))
           .when(F.coalesce(found, F.lit("")) == "", "no_email_found")
           .when(primary.isNull(), "duplicate_email")
           .when(~F.coalesce(has_mx, F.lit(False)),
                 F.concat(F.lit("no_mx:"), emails.mail_domain(primary)))
           .otherwise(""))
    error = none if error is None else error
    return F.when(error.isNotNull(), F.concat(F.lit("exception:"), error)).otherwise(out)


def audit(visits: DataFrame, candidates: DataFrame, dns: DataFrame, seen_domains: DataFrame,
          seen_emails: DataFrame, known: dict[str, str]) -> DataFrame:
    """One audited row per final visit, as if the visits came one after another by ``seq``.

    ``visits``: domain, html, http_status, seq and what else the caller keeps; throttled ones
    (429) are to be queued again and have no row here. ``candidates``: domain, email, score,
    pos. A domain that is stored, or has qualified before, reads ``duplicate_domain``; an
    address that is stored, or was accepted before, is not accepted again, and a site with no
    other reads ``duplicate_email``. So there are as many qualified rows as qualified domains
    and as accepted addresses.
    """
    final = visits.where(~F.coalesce(F.col("http_status") == "429", F.lit(False)))
    slim = final.withColumn("_blank", blank_to_null("html").isNull()).drop("html")
    stored = seen_domains.select("domain").distinct().withColumn("_stored", F.lit(True))
    slim = lookup(slim, stored, "domain")
    open_sites = (slim.where(~F.col("_blank") & F.col("_stored").isNull()
                             & F.contains(F.coalesce("domain", F.lit("")), F.lit(".")))
                  .groupBy("domain").agg(F.min("seq").alias("turn")))
    offers = match.attach_dns(ranked_fresh(candidates, seen_emails).join(open_sites, "domain"),
                              dns, "email", known)
    chosen = accept_in_turn(offers).withColumnRenamed("email", "primary_email")
    found = rank.top_list(candidates, "domain", "email", 10, ["pos"], name="emails_found")
    facts = lookup(lookup(slim, found, "domain"), chosen.drop("place", "score"), "domain")
    duplicate = F.coalesce(F.col("_stored"), F.lit(False)) | F.coalesce(
        F.col("has_mx") & (F.col("seq") > F.col("turn")), F.lit(False))
    why = reason(F.col("domain"), duplicate, F.col("_blank"), F.col("http_status"),
                 F.col("emails_found"), F.col("primary_email"), F.col("has_mx"))
    read = F.col("_why").isin("") | F.col("_why").rlike("^(no_mx:|duplicate_email|no_email)")
    dns_read = F.col("_why").isin("") | F.col("_why").rlike("^no_mx:")

    rows = facts.withColumn("_why", why)
    yes_no = {n: F.when(dns_read, F.when(F.col(n), "YES").otherwise("NO"))
              for n in ("has_mx", "dmarc", "spf")}
    return rows.select(
        *[c for c in visits.columns if c != "html"],
        F.when(read, F.col("emails_found")).alias("emails_found"),
        F.when(dns_read, F.col("primary_email")).alias("primary_email"),
        F.when(dns_read, F.col("mail_domain")).alias("email_domain"),
        yes_no["has_mx"].alias("mx_valid"),
        F.when(dns_read, F.col("provider")).alias("mx_provider"),
        yes_no["dmarc"].alias("dmarc"), yes_no["spf"].alias("spf"),
        F.when(F.col("_why") == "", "YES").otherwise("NO").alias("qualified"),
        F.col("_why").alias("rejection_reason"))
