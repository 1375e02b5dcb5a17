"""Contact rows: defaults, export profiles, item mapping, filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import domains, emails
from contactloom.functions.text import blank_to_null, capitalize
from contactloom.functions.text import words as tokens

UNKNOWN = "unknown"
PII_COLUMNS = {"email": "email", "secondary_email": "email", "first_name": "name",
               "last_name": "name"}


def require(df: DataFrame, email: str = "email") -> DataFrame:
    """Rows with a usable contact key, brought to its canonical form."""
    return (df.withColumn(email, F.lower(F.trim(F.col(email))))
            .where(F.contains(F.col(email), F.lit("@"))))


def require_domain(df: DataFrame, domain: str = "domain") -> DataFrame:
    return df.where((F.col(domain) != "") & F.contains(F.col(domain), F.lit(".")))


def has_keyword(df: DataFrame, columns: Sequence[str], terms: Sequence[str]) -> DataFrame:
    from contactloom.functions.text import contains_any
    from contactloom.operators.classify import joined_text

    return df.where(contains_any(joined_text(*columns), terms))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Blank fields from the fields that are there; statuses stay ``unknown``."""
    have = set(df.columns)

    def value(c: str) -> Column:
        return blank_to_null(c) if c in have else F.lit(None).cast("string")

    # a NULL site gives a NULL brand, so the chain ends in a blank
    site_brand = capitalize(F.split_part(F.replace(
        F.coalesce(value("website"), F.lit("")), F.lit("https://"), F.lit("")),
        F.lit("."), F.lit(1)))
    first = value("first_name")
    return df.withColumns({
        "company": F.coalesce(value("company"), site_brand),
        "website": F.coalesce(value("website"),
                              F.concat(F.lit("https://"), value("domain")), F.lit("")),
        "first_name": F.coalesce(first, capitalize(emails.local_part("email"))),
        "last_name": F.when(first.isNull(), "Founder").otherwise(
            F.coalesce(value("last_name"), F.lit(""))),
        "title": F.coalesce(value("title"), F.lit("Founder / Owner")),
        "mx_status": F.coalesce(value("mx_status"), F.lit(UNKNOWN)),
        "score": F.coalesce(value("score"), F.lit(UNKNOWN)),
    })


def fill_inbox_defaults(df: DataFrame) -> DataFrame:
    """Defaults of the inbox step: role name, title, country, category; texts never NULL."""
    have = set(df.columns)

    def value(c: str) -> Column:
        return blank_to_null(c) if c in have else F.lit(None).cast("string")

    niche = value("niche")
    filled = {c: F.coalesce(value(c), F.lit(d)) for c, d in rules.INBOX_DEFAULTS.items()}
    filled["niche"] = F.when(niche.isin(*rules.CATEGORIES), niche).otherwise(
        rules.INBOX_DEFAULT_CATEGORY)
    return df.withColumns(filled)


def score_label(score: Column) -> Column:
    """Export text of a score; no score reads ``unknown``."""
    return F.coalesce(F.concat(score.cast("string"), F.lit("%")), F.lit(UNKNOWN))


def project_profile(df: DataFrame, profile: str, pii: str = "clear",
                    headers: bool = True) -> DataFrame:
    """Columns of a named export, in order; missing values become blank texts."""
    out = []
    for header in rules.PROFILES[profile]:
        name = rules.HEADER_COLUMNS[header]
        value = F.col(name).cast("string") if name in df.columns else F.lit("")
        if name in PII_COLUMNS and name in df.columns:
            value = emails.protect(value, pii, PII_COLUMNS[name])
        out.append(F.coalesce(value, F.lit("")).alias(header if headers else name))
    return df.select(*out)


def protect_columns(df: DataFrame, pii: str = "clear") -> DataFrame:
    """Personal columns that are there, in their output form."""
    return df.withColumns({c: emails.protect(c, pii, kind) for c, kind in PII_COLUMNS.items()
                           if c in df.columns})


def append_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """All input columns in their order, then the new ones."""
    return df.select("*", *[c.alias(n) for n, c in columns.items()])


def with_category(df: DataFrame, column: str = "niche",
                  default: str = rules.GENERAL) -> DataFrame:
    """Unknown categories become the default one."""
    return df.withColumn(column, F.when(F.col(column).isin(*rules.CATEGORIES), F.col(column))
                         .otherwise(default))


def items_to_contacts(items: DataFrame) -> DataFrame:
    """Nested items of a collector to contact rows.

    Input (all optional but one of domain/website): domain, website, email,
    contact_email, founder_name, brand_name, title, niche, country. An address that was
    not observed stays NULL and such rows are dropped: no address is made up.
    """
    have = set(items.columns)

    def value(c: str) -> Column:
        return blank_to_null(c) if c in have else F.lit(None).cast("string")

    domain = domains.clean_domain(F.coalesce(value("domain"), value("website")), "anywhere")
    person = tokens(F.coalesce(value("founder_name"), F.lit("")))
    rows = items.select(
        "*", domain.alias("_domain"), person.alias("_person"),
        F.coalesce(value("email"), value("contact_email")).alias("_email"))
    rows = rows.where(emails.has_valid_syntax("_email"))
    return rows.select(
        F.coalesce(F.get("_person", F.lit(0)), F.lit("Founder")).alias("first_name"),
        F.array_join(F.filter("_person", lambda w, i: i > 0), " ").alias("last_name"),
        F.col("_email").alias("email"),
        F.coalesce(value("brand_name"), domains.brand_from_domain("_domain", "label"))
        .alias("company"),
        F.concat(F.lit("https://"), F.col("_domain")).alias("website"),
        F.coalesce(value("title"), F.lit("Founder / CEO")).alias("title"),
        F.coalesce(value("niche"), F.lit("DTC Ecommerce")).alias("niche"),
        F.coalesce(value("country"), F.lit("United States")).alias("country"))
