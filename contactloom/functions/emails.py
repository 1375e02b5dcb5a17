"""Address columns: clean-up, validity, roles, hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions.text import any_of, capitalize, col, contains_any


def clean_email(c: Column | str, form: str = "mention") -> Column:
    """``mention``: blanks and outer dots off; ``input``: blanks and leading slashes off."""
    c = F.trim(col(c))
    if form == "mention":
        return F.lower(F.trim(F.regexp_replace(c, r"^\.+|\.+$", "")))
    if form == "input":
        return F.regexp_replace(c, "^/+", "")
    raise ValueError(f"unknown form {form}")


def local_part(c: Column | str) -> Column:
    return F.split_part(col(c), F.lit("@"), F.lit(1))


def mail_domain(c: Column | str) -> Column:
    return F.split_part(col(c), F.lit("@"), F.lit(2))


def is_valid_email(c: Column | str, block: Sequence[str] = rules.BLOCK_TERMS,
                   dummy: Sequence[str] = rules.DUMMY_DOMAINS,
                   bounds: tuple[int, int | None] = (6, None),
                   parts: str = "one") -> Column:
    """Shape, length, TLD, block terms anywhere in the address, dummy domains.

    ``parts='one'`` wants exactly one @; ``'last'`` splits at the last one.
    """
    c = col(c)
    low, high = bounds
    head = r"^[^@]+@" if parts == "one" else r"^.+@"
    ok = c.rlike(head + r"[^@]*\.\p{L}{2,12}$") & (F.length(c) >= low)
    if high is not None:
        ok = ok & (F.length(c) <= high)
    if block:
        ok = ok & ~contains_any(c, block)
    if dummy:
        ok = ok & ~c.rlike(rf"[@.](?:{any_of(dummy)})$")
    return F.coalesce(ok, F.lit(False))


def has_valid_syntax(c: Column | str) -> Column:
    """Plain syntax check: dot-atom local part, domain labels, no deliverability."""
    c = col(c)
    atom = r"[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+"
    label = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
    return F.coalesce(
        c.rlike(rf"^{atom}(?:\.{atom})*@(?:{label}\.)+{label}$")
        & (F.length(local_part(c)) <= 64) & (F.length(c) <= 254)
        & c.rlike(r"\.[A-Za-z][A-Za-z0-9-]*$"), F.lit(False))


def role_from_local(c: Column | str, ruleset: str = "worker") -> Column:
    """Title and first/last name guessed from the local part, as a struct."""
    local = F.lower(local_part(c))
    pieces = F.split(local, "[._-]")
    out = F.struct(
        F.lit(rules.ROLE_DEFAULT_TITLE).alias("title"),
        capitalize(F.get(pieces, F.lit(0))).alias("first_name"),
        F.coalesce(capitalize(F.get(pieces, F.lit(1))), F.lit("Founder")).alias("last_name"))
    for terms, title, first, last in reversed(rules.ROLE_RULES[ruleset]):
        fixed = F.struct(F.lit(title).alias("title"), F.lit(first).alias("first_name"),
                         F.lit(last).alias("last_name"))
        out = F.when(contains_any(local, terms), fixed).otherwise(out)
    return out


def split_local_name(c: Column | str, last_default: str = "Owner") -> Column:
    """First and second token of the local part as a struct."""
    pieces = F.split(local_part(c), "[._-]")
    return F.struct(
        capitalize(F.get(pieces, F.lit(0))).alias("first_name"),
        F.coalesce(capitalize(F.get(pieces, F.lit(1))), F.lit(last_default)).alias("last_name"))


def is_personal(c: Column | str, roles: Sequence[str] = rules.ROLE_INBOXES) -> Column:
    """Personal inbox as opposed to a role or generic one."""
    local = F.lower(local_part(c))
    letters = F.regexp_replace(local, "[^a-z]", "")
    return F.coalesce(
        F.contains(col(c), F.lit("@")) & ~letters.isin(*roles) & ~local.isin(*roles)
        & (F.contains(local, F.lit(".")) | (F.length(letters) >= 4)), F.lit(False))


def email_hash(c: Column | str, algo: str = "md5") -> Column:
    key = F.lower(F.trim(col(c)))
    return F.md5(key) if algo == "md5" else F.sha2(key, 256)


def protect(c: Column | str, pii: str = "clear", kind: str = "email") -> Column:
    """Output form of a personal value: as it is, hashed, or masked."""
    c = col(c)
    if pii == "clear":
        return c
    if pii == "hash":
        return F.when(c != "", F.sha2(F.lower(F.trim(c)), 256)).otherwise(c)
    if pii == "mask":
        if kind == "email":
            return F.regexp_replace(c, r"^(.)[^@]*(@.*)$", "$1***$2")
        return F.regexp_replace(c, r"^(.).*$", "$1***")
    raise ValueError(f"unknown pii form {pii}")


def belongs_to(c: Column | str, domain: Column | str) -> Column:
    """Address at the domain, at one of its sub-domains or at a parent of it."""
    at, dom = mail_domain(c), F.lower(col(domain))
    return ((at == dom) | F.endswith(at, F.concat(F.lit("."), dom))
            | F.endswith(dom, F.concat(F.lit("."), at)))


def score_candidate(c: Column | str, domain: Column | str, weights: str = "worker") -> Column:
    """How well an address found on a page fits the site it was found on."""
    own, prefixes, role, info, other = rules.CANDIDATE_WEIGHTS[weights]
    c, domain = col(c), col(domain)
    host = F.replace(domain, F.lit("www."), F.lit("")) if weights == "harvest" else domain
    fits = (F.contains(c, F.split_part(host, F.lit("."), F.lit(1)))
            | F.contains(domain, mail_domain(c)))
    if weights == "crawl":
        labels = F.filter(F.split(domain, r"\."), lambda p: F.length(p) > 3)
        fits = fits | F.exists(labels, lambda p: F.contains(c, p))
    rest = F.lit(other)
    if info is not None:
        rest = F.when(F.contains(c, F.lit("info@")), info).otherwise(rest)
    return F.when(fits, own).when(contains_any(c, prefixes), role).otherwise(rest)


def deliverability(formula: str, dmarc: Column, spf: Column, extra: Column | None = None,
                   base: Column | None = None, provider: Column | None = None) -> Column:
    """Score after the DNS step.

    ``inbox``: 80, +10 DMARC, +5 SPF, +5 ``extra`` (a social or a profile hit).
    ``candidate``: ``base`` +5 DMARC, +3 SPF, +5 for the two big providers, at most 100.
    """
    def bonus(flag: Column, points: int) -> Column:
        return F.when(flag, points).otherwise(0)

    if formula == "inbox":
        return F.lit(80) + bonus(dmarc, 10) + bonus(spf, 5) + bonus(extra, 5)
    if formula == "candidate":
        big = provider.isin("Google Workspace", "Microsoft 365")
        return F.least(F.lit(100), base + bonus(dmarc, 5) + bonus(spf, 3) + bonus(big, 5))
    raise ValueError(f"unknown formula {formula}")
