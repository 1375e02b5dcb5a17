"""Keyword classification: the first rule whose terms occur and whose excludes do not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions.text import any_contains, blank_to_null, col, contains_any
from contactloom.functions.text import contains_token, let

RULESETS = ("strict", "strict_fallback", "strict_initial", "harvest", "turbo", "inline",
            "page", "ranked_page", "registry", "ranked")


def joined_text(*cols: Column | str) -> Column:
    """Lower-case concatenation the rules are tested against; NULL counts as blank."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(col(c), F.lit("")) for c in cols]))


def _tester(match: str):
    return {"substring": any_contains, "token": contains_token}[match]


def _first(text: Column, table, match: str = "substring") -> Column:
    """Category of the first keyword rule that matches, else NULL."""
    test = _tester(match)
    out = F.lit(None).cast("string")
    for category, terms in reversed(table):
        out = F.when(test(text, terms), F.lit(category)).otherwise(out)
    return out


def _strict(text: Column, match: str = "substring") -> Column:
    """Brand overrides, then include/exclude groups, else NULL."""
    test = _tester(match)
    out = F.lit(None).cast("string")
    for category, includes, excludes in reversed(rules.STRICT_RULES):
        out = F.when(test(text, includes) & ~test(text, excludes),
                     F.lit(category)).otherwise(out)
    for category, terms in reversed(rules.BRAND_OVERRIDES):
        out = F.when(any_contains(text, terms), F.lit(category)).otherwise(out)
    return out


def classify(text: Column, ruleset: str, current: Column | None = None,
             match: str = "substring") -> Column:
    """Category of a lower-case text under a named rule set.

    ``strict``: overrides, include/exclude groups, default.
    ``strict_fallback``: strict; if that gives the default, keywords, then ``current`` if
    it is a known category, then the default.
    ``strict_initial``: strict; if that gives the default, ``current``.
    ``harvest``: keywords, then ``current``. ``turbo``: keywords, then ``current`` if known.
    ``inline``: short keyword list. ``registry`` and ``ranked``: NULL if nothing matches.
    ``match='token'`` wants whole words; ``substring`` finds "ring" in "spring".
    """
    default = F.lit(rules.GENERAL)
    current = F.lit(None).cast("string") if current is None else blank_to_null(current)
    known = F.when(current.isin(*rules.CATEGORIES), current)

    def special(t: Column) -> Column:
        return F.nullif(_strict(t, match), default)

    # the text is evaluated once; every rule then tests that value
    if ruleset == "strict":
        return F.coalesce(let(text, lambda t: _strict(t, match)), default)
    if ruleset == "strict_fallback":
        return F.coalesce(let(text, lambda t: F.coalesce(
            special(t), _first(t, rules.FALLBACK_KEYWORDS, match))), known, default)
    if ruleset == "strict_initial":
        return F.coalesce(let(text, special), current, default)
    if ruleset in ("harvest", "turbo"):
        found = let(text, lambda t: _first(t, rules.HARVEST_KEYWORDS, match))
        return F.coalesce(found, current if ruleset == "harvest" else known, default)
    if ruleset == "inline":
        return F.coalesce(let(text, lambda t: _first(t, rules.INLINE_KEYWORDS, match)), default)
    if ruleset == "registry":
        return let(text, lambda t: _first(t, rules.REGISTRY_KEYWORDS, match))
    if ruleset == "ranked":
        return let(text, lambda t: F.coalesce(
            _first(t, rules.RANKED_KEYWORDS, match),
            F.when(any_contains(t, rules.RANKED_INDICATORS), default)))
    raise ValueError(f"unknown rule set {ruleset}")


def classify_page(text: Column, ruleset: str = "page",
                  default: Column | None = None) -> Column:
    """Category and sub-category of a page text plus domain, as a struct."""
    if ruleset == "page":
        table = rules.PAGE_KEYWORDS
        last = F.struct(F.lit(rules.PAGE_DEFAULT[0]).alias("niche"),
                        F.lit(rules.PAGE_DEFAULT[1]).alias("sub_niche"))
    elif ruleset == "ranked_page":
        table = rules.RANKED_PAGE_KEYWORDS
        last = F.struct(default.alias("niche"),
                        F.concat(default, F.lit(" Goods")).alias("sub_niche"))
    else:
        raise ValueError(f"unknown rule set {ruleset}")

    def first(t: Column) -> Column:
        out = last
        for category, sub, terms in reversed(table):
            fixed = F.struct(F.lit(category).alias("niche"), F.lit(sub).alias("sub_niche"))
            out = F.when(any_contains(t, terms), fixed).otherwise(out)
        return out

    return let(text, first)


def registry_matches(text: Column) -> dict[str, Column]:
    """One test per category, in the order in which rows try them."""
    return {category: contains_any(text, terms)
            for category, terms in rules.REGISTRY_KEYWORDS}


def ranked_domain_ok(domain: Column | str) -> Column:
    """Domain filter of the ranked list: denied suffixes and terms out."""
    from contactloom.functions.domains import ends_with_any

    low = F.lower(F.trim(col(domain)))
    return (~ends_with_any(low, rules.RANKED_DENIED_SUFFIXES)
            & ~contains_any(low, rules.RANKED_DENIED_TERMS))


def template_text(brand: Column, niche: Column, style: str = "phrase") -> Column:
    """Category text for an export row, with the default text for other categories."""
    from contactloom.functions.text import render

    if style == "phrase":
        phrase = F.lit(rules.PHRASE_DEFAULT)
        for category, value in rules.PHRASES.items():
            phrase = F.when(niche == category, F.lit(value)).otherwise(phrase)
        return render(F.lit(rules.PHRASE_TEMPLATE), phrase=phrase, brand=brand)
    if style == "niche":
        return render(F.lit(rules.PHRASE_TEMPLATE), phrase=niche, brand=brand)
    template = F.lit(rules.TEMPLATES[rules.GENERAL])
    for category, value in rules.TEMPLATES.items():
        template = F.when(niche == category, F.lit(value)).otherwise(template)
    return render(template, brand=brand)
