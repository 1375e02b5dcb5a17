"""Domain, brand and country columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions.text import any_of, blank_to_null, capitalize, col, contains_any
from contactloom.functions.text import let, render, title_case


def clean_domain(c: Column | str, mode: str = "prefix", www: bool = True) -> Column:
    """Bare host of a URL or domain text.

    ``prefix`` drops each of the leading tokens once and in order; ``anywhere`` removes
    the tokens wherever they stand.
    """
    low = F.lower(F.trim(col(c)))
    if mode == "prefix":
        pattern = r"^(https://)?(http://)?" + (r"(www\.)?" if www else "")
        bare = F.regexp_replace(low, pattern, "")
    elif mode == "anywhere":
        bare = low
        for token in ("https://", "http://") + (("www.",) if www else ()):
            bare = F.replace(bare, F.lit(token), F.lit(""))
    else:
        raise ValueError(f"unknown mode {mode}")
    return F.trim(F.split_part(bare, F.lit("/"), F.lit(1)))


def stem(c: Column | str) -> Column:
    """First label of a domain."""
    return F.split_part(F.lower(col(c)), F.lit("."), F.lit(1))


def brand_from_domain(c: Column | str, style: str = "crawl") -> Column:
    """Display name from a domain.

    ``crawl`` and ``ranked`` strip shop-like affixes; ``label`` capitalises the first
    label; ``title`` turns hyphens into spaces and title-cases.
    """
    c = col(c)
    label = F.split_part(c, F.lit("."), F.lit(1))
    if style == "label":
        return capitalize(label)
    if style == "title":
        head = F.split_part(F.replace(c, F.lit("www."), F.lit("")), F.lit("."), F.lit(1))
        return title_case(F.replace(head, F.lit("-"), F.lit(" ")))
    front, back = rules.BRAND_TOKENS[style]
    core = F.regexp_replace(F.regexp_replace(label, front, ""), back, "")
    return capitalize(F.when(F.length(core) > 0, core).otherwise(label))


def brand_or_default(brand: Column | str, domain: Column | str, style: str = "label") -> Column:
    return F.coalesce(blank_to_null(brand), brand_from_domain(domain, style))


def country_from_tld(c: Column | str, ruleset: str = "labels") -> Column:
    low = F.lower(col(c))
    if ruleset == "codes":
        last = F.try_element_at(F.split(low, r"\."), F.lit(-1))
        two = F.regexp_extract(low, r"\.([^.]+\.[^.]+)$", 1)
        two_level = F.create_map(*[F.lit(x) for kv in rules.TWO_LEVEL_CODES.items() for x in kv])
        one_level = F.create_map(*[F.lit(x) for kv in rules.ONE_LEVEL_CODES.items() for x in kv])
        return F.coalesce(two_level[two], one_level[last], F.lit(rules.OTHER_CODE))
    *groups, default = rules.COUNTRY_RULES[ruleset]
    out = F.lit(default)
    for suffixes, label in reversed(groups):
        out = F.when(ends_with_any(low, suffixes), F.lit(label)).otherwise(out)
    return out


def ends_with_any(c: Column | str, suffixes) -> Column:
    return col(c).rlike(f"(?:{any_of(suffixes)})$")


def brand_query(c: Column | str) -> Column:
    """Brand as a search phrase: the part before a dash or bar, unless that is too short."""
    c = col(c)
    head = F.trim(F.regexp_replace(c, r"(?s)\s*[-–—|].*$", ""))
    return F.when(F.length(head) < 3, c).otherwise(head)


def brand_key(c: Column | str) -> Column:
    """Brand without a TLD-like ending and without punctuation."""
    return F.regexp_replace(
        F.regexp_replace(col(c), r"(?i)\.(com|net|org|store|shop|co|io)$", ""),
        "[^a-zA-Z0-9]", "")


def search_url(c: Column | str, style: str = "keyword") -> Column:
    """Library search link with the percent-encoded query (blank as %20, slash kept)."""
    query = F.lower(col(c)) if style == "keyword" else col(c)
    encoded = F.url_encode(query)
    for token, plain in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(token), F.lit(plain))
    return render(F.lit(rules.SEARCH_URLS[style]), query=encoded)


def unwrap(c: Column | str) -> Column:
    """Target inside a redirect link; the link itself if there is none or it is broken."""
    from contactloom.patterns import REDIRECT_PATTERN

    href = col(c)
    inner = F.regexp_extract(href, REDIRECT_PATTERN, 1)
    decoded = F.try_url_decode(F.replace(inner, F.lit("+"), F.lit("%2B")))
    return F.when(inner != "", F.coalesce(decoded, href)).otherwise(href)


def trusted(url: Column | str, domain: Column | str, strict: bool = False) -> Column:
    """Is this page a source we believe about the domain?"""
    low = F.lower(col(url))
    own = F.contains(low, F.lower(col(domain)))
    if strict:
        return own | contains_any(low, rules.STRICT_TRUSTED_HOSTS)
    return (~F.contains(low, F.lit(rules.DIRECTORY_PAGE))
            & (own | contains_any(low, rules.TRUSTED_HOSTS)
               | ~contains_any(low, rules.DENIED_HOSTS)))


def grounded(text: Column | str, domain: Column | str, brand: Column | str,
             stop=(), strict: bool = True) -> Column:
    """Does the text speak about this very business?

    ``strict=False`` is the older rule: stem of four letters or enough brand tokens.
    """
    dom = F.lower(col(domain))
    head = stem(dom)
    parts = F.filter(F.split(F.lower(col(brand)), "[^a-z0-9]+"), lambda t: t != "")

    def is_stop(t: Column) -> Column:
        return F.regexp_replace(t, "[^a-z]", "").isin(*stop) if stop else F.lit(False)

    def older(low: Column) -> Column:
        tokens = F.filter(parts, lambda t: (F.length(t) >= 3) & ~t.isin(
            "the", "and", "shop", "store", "online", "inc", "llc", "ltd"))
        hits = F.size(F.filter(tokens, lambda t: F.contains(low, t)))
        return (((F.length(head) >= 4) & F.contains(low, head))
                | ((F.size(tokens) > 0) & (hits >= F.least(F.lit(2), F.size(tokens)))))

    def current(low: Column) -> Column:
        full = F.contains(low, dom)
        distinctive = head.rlike("[0-9-]") | (F.length(head) >= 8)
        by_stem = distinctive & ~is_stop(head) & F.contains(low, head)
        lead = F.filter(parts, lambda t: (F.length(t) >= 2)
                        & ~t.isin(*rules.GROUNDING_PREFIX_STOPS))
        by_prefix = (F.size(lead) >= 2) & F.contains(
            low, F.concat_ws(" ", F.get(lead, F.lit(0)), F.get(lead, F.lit(1))))
        tokens = F.filter(parts, lambda t: (F.length(t) >= 4)
                          & ~t.isin(*rules.GROUNDING_TOKEN_STOPS)
                          & (~t.isin(*stop) if stop else F.lit(True)))
        hits = F.size(F.filter(tokens, lambda t: F.contains(low, t)))
        single = F.get(tokens, F.lit(0))
        by_single = ((F.size(tokens) == 1) & (F.length(single) >= 6) & ~is_stop(single)
                     & (single.rlike("[0-9-]") | (F.length(single) >= 8)) & (hits >= 1))
        by_many = (F.size(tokens) >= 2) & (hits >= 2)
        return full | ((F.length(head) >= 6)
                       & F.coalesce(by_stem | by_prefix | by_single | by_many, F.lit(False)))

    # the lower-case text is bound once for all tests
    return let(F.lower(col(text)), current if strict else older)
