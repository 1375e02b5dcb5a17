"""Person names: plausibility, parsing from addresses and handles, address variants.

``names`` (given names) and ``stop`` (words no name contains) are small dictionaries of
lower-case entries; ``text.load_words`` reads them from a table and checks their size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions.emails import local_part
from contactloom.functions.text import alnum_fold, any_of, capitalize, col, let
from contactloom.functions.text import text_array, words

# ---------------------------------------------------------------- fixed values
# Word endings and what replaces them
# -----------------------------------------------------------------------------
ENDINGS = ("ies>y", "es>", "s>", "ed>", "ed>e", "ing>", "ing>e", "ers>", "ers>er", "er>",
           "er>e")
# One capitalised word, or two to four words of which the first and last are capitalised
NAME_SHAPE = r"^\p{Lu}\p{L}+(?:(?: \p{L}+){0,2} \p{Lu}\p{L}{1,29})?$"

PERSON = "struct<first_name:string,last_name:string,source:string,confidence:string>"


def _member(c: Column, entries: Sequence[str]) -> Column:
    return F.array_contains(text_array(entries), c) if entries else F.lit(False)


def word_stems(token: Column) -> Column:
    """The lower-case token and what remains of it without a common ending."""
    low = F.lower(token)

    def cut(rule: Column) -> Column:
        ending = F.split_part(rule, F.lit(">"), F.lit(1))
        rest = F.left(low, F.length(low) - F.length(ending))
        return F.when(F.endswith(low, ending),
                      F.concat(rest, F.split_part(rule, F.lit(">"), F.lit(2))))

    return F.array_compact(F.array_append(F.transform(text_array(ENDINGS), cut), low))


def plausible_name(name: Column | str, names: Sequence[str], stop: Sequence[str],
                   brand: Column | None = None, domain: Column | None = None,
                   strict: bool = False) -> Column:
    """Can this text be a person's name? (one to four capitalised words)

    Short or lone given names must be known ones, ``strict`` wants that of all. No word, nor
    its stem, may be a stop word; the name must not be the brand or the domain label.
    """
    def check(whole: Column) -> Column:
        first = F.substring_index(whole, " ", 1)
        last = F.when(F.contains(whole, F.lit(" ")), F.substring_index(whole, " ", -1))
        size = F.length(first)
        known = _member(F.lower(first), names)
        ok = whole.rlike(NAME_SHAPE) & F.when(
            last.isNull(), known & (size >= 3)).otherwise(known | (size > 3))
        ok = ok & ~whole.rlike(f"(?i) (?:{any_of(rules.SURNAME_PARTICLES)})$")
        if strict:
            ok = ok & known
        if stop:
            stems = F.flatten(F.transform(F.split(whole, " "), word_stems))
            ok = ok & ~F.arrays_overlap(stems, text_array(stop))
        if brand is not None:
            tokens = F.split(F.lower(brand), "[^a-z0-9]+")
            clash = (F.contains(alnum_fold(brand), alnum_fold(whole))
                     | ((F.length(last) >= 4) & F.array_contains(tokens, F.lower(last))))
            ok = ok & ~((brand != "") & F.coalesce(clash, F.lit(False)))
        if domain is not None:
            head = F.split_part(F.lower(domain), F.lit("."), F.lit(1))
            clash = head.isin(F.lower(first), F.lower(last))
            ok = ok & ~((domain != "") & F.coalesce(clash, F.lit(False)))
        return ok

    whole = F.trim(F.regexp_replace(col(name), r"\s+", " "))
    return F.coalesce(let(whole, check), F.lit(False))


def short_plausible_name(name: Column | str, names: Sequence[str],
                         stop: Sequence[str]) -> Column:
    """The older rule: one to three words and a known given name."""
    parts = words(name)
    n = F.size(parts)
    first, last = F.get(parts, F.lit(0)), F.when(n > 1, F.get(parts, n - 1))
    ok = ((n >= 1) & (n <= 3) & _member(F.lower(first), names) & first.rlike(r"^\p{Lu}\p{L}+$")
          & ~_member(F.lower(first), stop))
    ok = ok & (last.isNull() | (last.rlike(r"^\p{Lu}\p{L}{1,21}$")
                                & ~_member(F.lower(last), stop)))
    return F.coalesce(ok, F.lit(False))


def person(first: Column, last: Column | None, source: str, confidence: str) -> Column:
    last = F.lit("") if last is None else last
    return F.struct(first.alias("first_name"), last.alias("last_name"),
                    F.lit(source).alias("source"),
                    F.lit(confidence).alias("confidence")).cast(PERSON)


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def parse_local_name(email: Column | str, names: Sequence[str], stop: Sequence[str],
                     brand: Column | None = None, domain: Column | None = None) -> Column:
    """Person hidden in the local part: ``first.last``, ``firstlast`` or ``first``.

    Of several given names the local part starts with, the longest whose remainder can be
    a surname wins. Role inboxes give NULL.
    """
    long_names = [w for w in names if len(w) >= 4]

    def dotted(local: Column) -> Column:
        halves = F.split(local, r"\.")
        first, last = capitalize(F.get(halves, F.lit(0))), capitalize(F.get(halves, F.lit(1)))
        ok = local.rlike(r"^\p{L}{2,}\.\p{L}{2,}$") & plausible_name(
            full_name(first, last), names, stop, brand, domain)
        return F.when(ok, person(first, last, "email_first_last", "HIGH"))

    def joined(letters: Column) -> Column:
        # lengths a given name at the front can have, longest first
        lengths = F.when(F.length(letters) >= 7,
                         F.sequence(F.length(letters) - 3, F.lit(4), F.lit(-1)))

        def splits(n: Column) -> Column:
            head, tail = F.left(letters, n), F.substr(letters, n + 1)
            return (_member(head, long_names) & ~_member(tail, stop)
                    & plausible_name(full_name(capitalize(head), capitalize(tail)), names,
                                     stop, brand, domain))

        return let(F.get(F.filter(lengths, splits), F.lit(0)), lambda n: F.when(
            n.isNotNull(), person(capitalize(F.left(letters, n)),
                                  capitalize(F.substr(letters, n + 1)), "email_concat",
                                  "HIGH")))

    def alone(letters: Column) -> Column:
        ok = _member(letters, names) & ~_member(letters, stop) & (F.length(letters) >= 3)
        return F.when(ok, person(capitalize(letters), None, "email_first", "MEDIUM"))

    def parse(local: Column) -> Column:
        return let(F.regexp_replace(local, "[^a-z]", ""), lambda letters: F.when(
            ~letters.isin(*rules.ROLE_LOCAL_PARTS),
            F.coalesce(dotted(local), joined(letters), alone(letters))))

    local = F.regexp_replace(F.lower(local_part(email)), "^/+", "")
    return F.when(F.contains(col(email), F.lit("@")), let(local, parse))


def namesake(brand: Column | str, domain: Column | str, names: Sequence[str],
             stop: Sequence[str]) -> Column:
    """Brand named after its founder: two words, both inside the domain's first label."""
    brand, domain = col(brand), col(domain)

    def check(parts: Column) -> Column:
        first = capitalize(F.get(parts, F.lit(0)))
        last = capitalize(F.get(parts, F.lit(1)))
        head = F.split_part(F.lower(domain), F.lit("."), F.lit(1))
        ok = ((F.size(parts) == 2) & (F.length(first) >= 3) & (F.length(last) >= 3)
              & ~_member(F.lower(first), stop) & ~_member(F.lower(last), stop)
              & F.contains(head, F.lower(first)) & F.contains(head, F.lower(last))
              & plausible_name(full_name(first, last), names, stop, domain=domain,
                               strict=True))
        return F.when(ok, person(first, last, "namesake_brand", "HIGH"))

    return let(words(F.regexp_replace(brand, r"[^A-Za-z\s]", "")), check)


def address_variants(first: Column | str, last: Column | str, domain: Column | str,
                     form: str = "standard") -> Column:
    """Ordered distinct addresses a person may have at a domain.

    They are join keys for a confirmation against observed addresses, never contacts.
    ``standard`` has seven forms, ``older`` three to six with role fallbacks, ``single``
    the given name only.
    """
    first, last = F.lower(col(first)), F.lower(F.coalesce(col(last), F.lit("")))
    domain = col(domain)

    def at(*pieces: Column) -> Column:
        return F.concat(*pieces, F.lit("@"), domain)

    def initial(c: Column) -> Column:
        return F.substring(c, 1, 1)

    dot, bar = F.lit("."), F.lit("_")
    if form == "single":
        return F.array(at(first))
    if form == "standard":
        both = F.array(at(first), at(first, dot, last), at(first, last),
                       at(initial(first), last), at(first, dot, initial(last)),
                       at(last, dot, first), at(first, bar, last))
        return F.array_distinct(F.when(last != "", both).otherwise(F.array(at(first))))
    if form == "older":
        first = F.regexp_replace(first, "[^a-z]", "")
        last = F.regexp_replace(last, "[^a-z]", "")
        both = F.array(at(first, dot, last), at(first), at(first, last),
                       at(initial(first), last), at(first, bar, last),
                       at(initial(first), dot, last))
        one = F.array(at(first), at(F.lit("founder")), at(F.lit("hello")))
        none = F.array(*[at(F.lit(w)) for w in ("founder", "ceo", "marketing", "hello")])
        return (F.when((first != "") & (last != ""), both).when(first != "", one)
                .otherwise(none))
    raise ValueError(f"unknown form {form}")


def handle_name(handle: Column | str) -> Column:
    """Two names out of a camel-case handle, as a struct; NULL for other handles."""
    runs = F.regexp_extract_all(col(handle), F.lit("([A-Z][a-z]+)"), F.lit(1))
    return F.when(F.size(runs) == 2, F.struct(
        F.get(runs, F.lit(0)).alias("first_name"), F.get(runs, F.lit(1)).alias("last_name")))


def officer_name(c: Column | str) -> Column:
    """``SURNAME, Given Middle`` to first and last name."""
    c = col(c)
    given = words(F.regexp_extract(c, r"^[^,]*,(.*)$", 1))
    return F.when(F.contains(c, F.lit(",")) & (F.size(given) > 0), F.struct(
        capitalize(F.get(given, F.lit(0))).alias("first_name"),
        capitalize(F.trim(F.split_part(c, F.lit(","), F.lit(1)))).alias("last_name")))


def max_confidence(*levels: Column | str) -> Column:
    """The strongest of several confidence labels; the first one on a tie."""
    ranked = [F.struct(confidence_rank(c).alias("rank"), (-F.lit(i)).alias("pos"),
                       col(c).alias("label")) for i, c in enumerate(levels)]
    return F.greatest(*ranked)["label"] if len(ranked) > 1 else ranked[0]["label"]


def confidence_rank(c: Column | str) -> Column:
    out = F.lit(0)
    for label, rank in rules.CONFIDENCE_RANK.items():
        out = F.when(col(c) == label, rank).otherwise(out)
    return out
