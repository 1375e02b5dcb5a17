"""String helpers shared by the column functions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICTIONARY_LIMIT = 20_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Name a value inside an expression, so it is written and evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(F.trim(c) != "", c)


def capitalize(c: Column | str) -> Column:
    """First letter up, the rest down (``initcap`` works per word instead)."""
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def title_case(c: Column | str) -> Column:
    """Capitalise every run of letters, also after a digit or a hyphen."""
    runs = F.regexp_extract_all(col(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, capitalize), "")


def slug(c: Column | str) -> Column:
    return F.replace(F.replace(F.lower(col(c)), F.lit(" & "), F.lit("_")), F.lit(" "), F.lit("_"))


def alnum_fold(c: Column | str) -> Column:
    """Lower case, ASCII letters and digits only."""
    return F.regexp_replace(F.lower(col(c)), "[^a-z0-9]", "")


def any_of(terms: Sequence[str]) -> str:
    """Regex that finds any of the literal terms."""
    return "|".join(re.escape(t) for t in terms)


def shortest(terms: Sequence[str]) -> list[str]:
    """Terms without those that hold another one: the same any-match with fewer tests."""
    unique = list(dict.fromkeys(terms))
    return [t for t in unique if not any(o != t and o in t for o in unique)]


def text_array(values: Sequence[str]) -> Column:
    """Constant array of texts, written as one literal."""
    return F.split(F.lit("\u0001".join(values)), "\u0001")


def any_contains(c: Column, terms: Sequence[str]) -> Column:
    """Substring tests, in order and up to the first hit, on a value already at hand."""
    return F.exists(text_array(shortest(terms)), lambda t: F.contains(c, t))


def contains_any(c: Column | str, terms: Sequence[str]) -> Column:
    """True if one of the literal terms occurs anywhere in ``c``.

    Longer lists run as plain substring tests on the text evaluated once: on page-sized
    texts these are several times faster than one pattern with many alternatives.
    """
    terms = shortest(terms)
    if not terms:
        return F.lit(False)
    if len(terms) <= 4:
        return col(c).rlike(any_of(terms))
    return let(col(c), lambda t: any_contains(t, terms))


def contains_token(c: Column | str, terms: Sequence[str]) -> Column:
    """As ``contains_any`` but the term must stand alone between non-word characters."""
    if not terms:
        return F.lit(False)
    return col(c).rlike(rf"\b(?:{any_of(terms)})\b")


def words(c: Column | str) -> Column:
    """Whitespace tokens; an empty array for a blank text."""
    c = F.trim(F.regexp_replace(col(c), r"\s+", " "))
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(c, " "))


def render(template: Column, **values: Column) -> Column:
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def snippet(text: Column | str, hit: Column | str, width: int = 100) -> Column:
    """Text from ``width`` characters before the hit to ``width`` after its start."""
    text, hit = col(text), col(hit)
    at = F.instr(text, hit)
    start = F.greatest(F.lit(1), at - width)
    window = F.substring(text, start, at + width - start)
    return F.when(at > 0, F.trim(F.regexp_replace(window, r"\s+", " ")))


def load_words(dim: DataFrame, column: str, limit: int = DICTIONARY_LIMIT) -> tuple[str, ...]:
    """Distinct lower-case entries of a small dictionary table.

    The table travels inside the plan, so its size is checked first. A dictionary beyond
    the limit belongs in a join: see ``operators.match.match_terms``.
    """
    entries = (dim.select(F.lower(F.trim(F.col(column))).alias("w")).where("w <> ''")
               .distinct().limit(limit + 1).collect())
    if len(entries) > limit:
        raise ValueError(f"dictionary '{column}' has more than {limit} entries; use a join")
    return tuple(sorted(r.w for r in entries))
