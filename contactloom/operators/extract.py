"""Contacts, links and evidence out of page, document and record texts.

Every operator keeps the caller's key columns, explodes inside the row and needs no
shuffle, unless its description says otherwise.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom import patterns, rules
from contactloom.functions import domains, emails, html, names, social
from contactloom.functions.text import any_of, capitalize, col, contains_any, let
from contactloom.functions.text import text_array, words

PLATFORM_COLUMNS = {"instagram": "instagram", "facebook": "facebook", "linkedin": "linkedin",
                    "tiktok": "tiktok", "twitter": "twitter_x"}


# --------------------------------------------------------------------- addresses
def mention_list(text: Column | str, pattern: str = rules.EMAIL_PATTERN,
                 group: int = 0) -> Column:
    """Cleaned address mentions of a text in order, repeats included."""
    return F.transform(F.regexp_extract_all(col(text), F.lit(pattern), F.lit(group)),
                       lambda m: emails.clean_email(m))


def mailto_list(markup: Column | str) -> Column:
    """Addresses of mail links, query part cut off."""
    return F.transform(
        F.regexp_extract_all(col(markup), F.lit(rules.MAILTO_HREF_PATTERN), F.lit(1)),
        lambda m: F.lower(F.trim(m)))


def extract_emails(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """One row per address mention: keys, position from 0, address."""
    return df.select(*keys, F.posexplode(mention_list(text)).alias("pos", "email"))


def unique_mentions(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """One row per text with its distinct mentions in order of appearance."""
    return df.select(*keys, F.array_distinct(mention_list(text)).alias("emails"))


def sweep_list(markup: Column | str, domain: Column | str, own_only: bool = True) -> Column:
    """Distinct addresses hidden in a page in any of four ways, as (email, encoding) structs.

    Encodings, first one found: ``mailto``, ``xor`` (hex attribute), ``plain``, ``entity`` (@
    and dot as entities). With ``own_only`` just the site's own, parent and sub-domains stay.
    """
    page, domain = col(markup), col(domain)

    def all_of(pattern: str, source: Column) -> Column:
        return F.regexp_extract_all(source, F.lit(pattern), F.lit(1))

    def tag(found: Column, name: str) -> Column:
        return F.transform(found, lambda m: F.struct(
            F.lower(m).alias("email"), F.lit(name).alias("encoding")))

    # what is plain text is found by the entity reading too: plain goes first
    hidden = F.filter(F.transform(all_of(rules.XOR_ATTRIBUTE_PATTERN, page), html.decode_xor),
                      lambda m: F.contains(m, F.lit("@")))
    found = let(F.concat(
        tag(all_of(rules.MAILTO_ANY_PATTERN, page), "mailto"), tag(hidden, "xor"),
        tag(all_of(rules.SWEEP_EMAIL_PATTERN, page), "plain"),
        tag(all_of(rules.SWEEP_EMAIL_PATTERN, html.decode_mail_entities(page)), "entity")),
        _first_per_email)
    if not own_only:
        return found
    return F.filter(found, lambda m: (F.size(F.split(m["email"], "@")) == 2)
                    & emails.belongs_to(m["email"], domain))


def sweep_emails(df: DataFrame, markup: str, domain: str, keys: Sequence[str],
                 own_only: bool = True) -> DataFrame:
    """One row per address of ``sweep_list``; repeats fall inside the row, no shuffle."""
    return df.select(*keys, F.inline(sweep_list(markup, domain, own_only)))


def _first_per_email(found: Column) -> Column:
    seen = F.transform(found, lambda m: m["email"])
    return F.filter(found, lambda m, i: F.array_position(seen, m["email"]) == i + 1)


def candidate_list(markup: Column | str, domain: Column | str, weights: str = "worker",
                   mail_links: bool = True) -> Column:
    """Addresses of a page with their scores: mail links first, then text mentions."""
    links = F.transform(mailto_list(markup), lambda m: F.struct(
        m.alias("email"), F.lit(rules.MAILTO_SCORE).alias("score")))
    texts = F.transform(mention_list(markup), lambda m: F.struct(
        m.alias("email"), emails.score_candidate(m, col(domain), weights).alias("score")))
    return F.concat(links, texts) if mail_links else texts


def page_candidates(df: DataFrame, markup: str, domain: str, keys: Sequence[str],
                    weights: str = "worker", block: Sequence[str] = rules.BLOCK_TERMS,
                    bounds: tuple[int, int | None] = (6, None), parts: str = "one",
                    mail_links: bool = True, shape: bool = True) -> DataFrame:
    """Scored address candidates of a page: mail links first, then text mentions.

    ``shape=False`` tests the block terms only, not the form of the address.
    """
    found = candidate_list(markup, domain, weights, mail_links)
    rows = df.select(*keys, F.posexplode(found).alias("pos", "c"))
    rows = rows.select(*keys, "pos", "c.email", "c.score")
    if not shape:
        return rows.where(~contains_any("email", block))
    return rows.where(emails.is_valid_email("email", block=block, bounds=bounds, parts=parts))


def card_emails(df: DataFrame, text: str, domain: str, keys: Sequence[str]) -> DataFrame:
    """Distinct addresses at the row's domain in a snippet; personal ones rank first."""
    rows = df.select(*keys, domain, F.posexplode(F.array_distinct(F.transform(
        F.regexp_extract_all(col(text), F.lit(
            r"([a-zA-Z0-9][a-zA-Z0-9._%+-]{1,30}@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,})"), F.lit(1)),
        lambda m: F.lower(m)))).alias("pos", "email"))
    own = F.endswith("email", F.concat(F.lit("@"), F.lower(F.col(domain))))
    return rows.where(own).withColumn("is_personal", emails.is_personal("email"))


# ------------------------------------------------------------------------- links
def page_links(df: DataFrame, markup: str, keys: Sequence[str]) -> DataFrame:
    """One row per anchor: keys, position from 0, link target."""
    return df.select(*keys, F.posexplode(html.hrefs(markup)).alias("pos", "href"))


def _social_reader(platform: str):
    return lambda h: social.canonical_social(h, platform)


def page_socials(markup: Column | str) -> list[Column]:
    """First profile link per platform, as one column each."""
    links = html.hrefs(markup)
    out = []
    for platform, name in PLATFORM_COLUMNS.items():
        hits = F.transform(links, _social_reader(platform))
        out.append(F.get(F.array_compact(hits), F.lit(0)).alias(name))
    return out


def site_socials(df: DataFrame, site: str, order: Sequence[str]) -> DataFrame:
    """First profile link per platform over all pages of a site (wide, one row per site).

    Input has one row per page with the platform columns. Shuffles by site; every
    platform is a partial minimum, so a site with very many pages is folded map-side.
    """
    rank = F.struct(*order)
    return df.groupBy(site).agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c)
        for c in PLATFORM_COLUMNS.values()])


def contact_link(markup: Column | str, domain: Column | str, style: str = "worker") -> Column:
    """First link that looks like a contact page, as an absolute URL.

    ``worker`` takes http and rooted links; ``relative`` resolves any link but mail and
    phone ones; ``own`` wants a contact path on the site itself.
    """
    domain = col(domain)
    base = F.concat(F.lit("https://"), domain)
    if style == "own":
        # the site's own host is compared per link, so the pattern stays a constant
        path = (r"(/pages/[^\"'\s>#]*contact[^\"'\s>#]*|/contact[^\"'\s>#]*"
                r"|/pages/[^\"'\s>#]*reach-us[^\"'\s>#]*)")
        host = F.replace(F.lower(domain), F.lit("www."), F.lit(""))
        links = F.regexp_extract_all(col(markup), F.lit(r"""(?i)href=["']([^"']*)["']"""),
                                     F.lit(1))

        def own_path(link: Column) -> Column:
            lead = F.lower(F.regexp_extract(link, r"(?i)^https?://(?:www\.)?([^/]+)/", 1))
            rest = F.regexp_replace(link, r"(?i)^https?://(?:www\.)?[^/]+", "")
            hit = F.regexp_extract(rest, "(?i)^" + path + "$", 1)
            return F.when(((lead == "") | (lead == host)) & (hit != ""), hit)

        first = F.get(F.array_compact(F.transform(links, own_path)), F.lit(0))
        return F.concat(base, first)
    links = html.hrefs(markup)
    if style == "relative":
        def resolve(h: Column) -> Column:
            low = F.lower(h)
            wanted = (contains_any(low, rules.CONTACT_HINTS_RELATIVE)
                      & ~low.rlike("^(mailto:|tel:)"))
            full = (F.when(h.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
                    .when(F.startswith(h, F.lit("//")), F.concat(F.lit("https:"), h))
                    .when(F.startswith(h, F.lit("/")), F.concat(base, h))
                    .otherwise(F.concat(base, F.lit("/"), h)))
            return F.when(wanted, full)
    else:
        def resolve(h: Column) -> Column:
            wanted = contains_any(F.lower(h), rules.CONTACT_HINTS)
            full = (F.when(F.startswith(h, F.lit("http")), h)
                    .when(F.startswith(h, F.lit("/")), F.concat(base, h)))
            return F.when(wanted, full)
    return F.get(F.array_compact(F.transform(links, resolve)), F.lit(0))


def candidate_pages(markup: Column | str, domain: Column | str, k: int = 8,
                    paths: Sequence[str] = rules.ABOUT_PATHS) -> Column:
    """URLs worth reading next: hinted links of the page, then standard paths, first k."""
    base = F.concat(F.lit("https://"), col(domain))

    def hinted(a: Column) -> Column:
        h = a["href"]
        # hints may stand in the link or in its text, skipped sections only in the link
        both = F.lower(F.concat_ws("\n", h, a["text"]))
        wanted = (contains_any(both, rules.ABOUT_HINTS)
                  & ~contains_any(F.lower(h), rules.ABOUT_SKIPS))
        full = (F.when(F.startswith(h, F.lit("http")), h)
                .when(F.startswith(h, F.lit("/")), F.concat(base, h))
                .otherwise(F.concat(base, F.lit("/"), h)))
        return F.when(wanted & F.contains(full, col(domain)), full)

    links = F.array_compact(F.transform(html.anchors(markup), hinted))
    standard = F.array(*[F.concat(base, F.lit(p)) for p in paths])
    return F.slice(F.array_distinct(F.concat(links, standard)), 1, k)


def select_pages(pages: DataFrame, site: str, path: str, k: int = 8,
                 paths: Sequence[str] = rules.ABOUT_PATHS) -> DataFrame:
    """The first k pages per site by hint, then by standard path (pages held as a table).

    ``priority`` is 0 for a hinted path and the place of a standard path otherwise.
    Ranking shuffles by site; the k-limit is applied before the shuffle as well.
    """
    low = F.lower(F.col(path))
    hinted = contains_any(low, rules.ABOUT_HINTS) & ~contains_any(low, rules.ABOUT_SKIPS)
    place = F.array_position(F.array(*[F.lit(p) for p in paths]), F.col(path))
    ranked = pages.withColumn("priority", F.when(hinted, 0).when(place > 0, place.cast("int")))
    order = Window.partitionBy(site).orderBy("priority", path)
    return (ranked.where("priority IS NOT NULL").dropDuplicates([site, path])
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))


# ------------------------------------------------------------------------ people
PATTERN_ROWS = "array<struct<pat:int,pattern:string,needs:array<string>>>"


def pattern_rows(table=patterns.SITE_PATTERNS, flags: str = "(?i)") -> list[tuple]:
    """A list of (pattern, required literals) as rows (pat, pattern, needs), numbered from 1.

    Literals are lower-case; a text that has none of a pattern's cannot match it.
    """
    def full(pattern: str) -> str:
        # only patterns with letters beyond ASCII pay for Unicode case folding
        foreign = any(c.isalpha() and not c.isascii() for c in pattern)
        return (flags.replace(")", "u)") if foreign else flags) + pattern

    return [(number, full(pattern), list(needs))
            for number, (pattern, needs) in enumerate(table, start=1)]


def pattern_hits(text: Column, row: Column) -> Column:
    """All hits of a pattern that is itself a value, by position."""
    pattern = row["pattern"]
    return F.transform(
        F.call_function("regexp_extract_all", text, pattern, F.lit(0)), lambda w: F.struct(
            row["pat"].alias("pat"), w.alias("whole"),
            F.trim(F.call_function("regexp_extract", w, pattern, F.lit(1))).alias("cand")))


def mention_candidates(text: Column, low: Column, table=patterns.SITE_PATTERNS,
                       flags: str = "(?i)") -> Column:
    """All pattern hits of a text, by pattern number and then by position.

    The patterns are one constant array, so the plan does not grow with their number. Each
    literal a pattern needs is looked for once; patterns without theirs are skipped.
    """
    numbered = pattern_rows(table, flags)
    literals = list(dict.fromkeys(n for _, _, needs in numbered for n in needs))
    held = F.from_json(F.lit(json.dumps([
        {"pat": number, "pattern": pattern, "needs": needs}
        for number, pattern, needs in numbered])), PATTERN_ROWS)

    def run(found: Column) -> Column:
        possible = F.filter(held, lambda p: F.arrays_overlap(found, p["needs"]))
        return F.flatten(F.transform(possible, lambda p: pattern_hits(text, p)))

    # bound outside the lambda: the lower-case text is made once, not once per literal
    return let(low, lambda known: let(
        F.filter(text_array(literals), lambda n: F.contains(known, n)), run))


def _reading(first: Column, last: Column, kind: str, *single: Column) -> Column:
    """One way to read a candidate, with the texts that must be plausible names."""
    checked = F.array(*single) if single else F.array(F.concat_ws(" ", first, last))
    return F.struct(first.alias("first_name"), last.alias("last_name"),
                    F.lit(kind).alias("kind"), checked.alias("names"))


def _readings(x: Column, stop: Sequence[str]) -> Column:
    """Ways to read a candidate as a person, in order: sign-off, pair, plain name."""
    cand = x["cand"]

    def family(pieces: Column) -> Column:
        first = capitalize(F.get(words(F.get(pieces, F.lit(0))), F.lit(0)))
        tail = words(F.try_element_at(pieces, F.lit(-1)))
        return F.array(F.when((F.size(tail) >= 2) & first.isNotNull(), _reading(
            first, capitalize(F.try_element_at(tail, F.lit(-1))), "_family")))

    def only_words(c: Column) -> Column:
        return F.transform(F.filter(words(c), lambda w: w.rlike(r"^\p{L}+$")), capitalize)

    def pair(p: Column) -> Column:
        one, two = p["one"], p["two"]
        a, z = F.get(one, F.lit(0)), F.try_element_at(one, F.lit(-1))
        b, y = F.get(two, F.lit(0)), F.try_element_at(two, F.lit(-1))
        return F.array(
            F.when(F.size(one) >= 2, _reading(a, z, "_cofounder")),
            F.when((F.size(one) == 1) & (F.size(two) >= 2), _reading(a, y, "_cofounder")),
            F.when((F.size(one) == 1) & (F.size(two) >= 2), _reading(b, y, "_cofounder")),
            F.when((F.size(one) == 1) & (F.size(two) == 1),
                   _reading(a, b, "_cofounder", a, b)))

    def alone(parts: Column) -> Column:
        kept = F.array_max(F.transform(parts, lambda p, i: F.when(
            (i < 2) | ~F.lower(p).isin(*rules.TRAILING_WORDS, *stop), i + 1).otherwise(0)))
        first = capitalize(F.get(parts, F.lit(0)))
        last = capitalize(F.get(parts, kept - 1))
        return F.array(
            F.when(F.size(parts) >= 2, _reading(first, last, "")),
            F.when(F.size(parts) == 1, _reading(first, F.lit(""), "_first", first)))

    joint = F.contains(cand, F.lit("&")) | F.contains(F.lower(cand), F.lit(" and "))
    commas = F.filter(F.transform(F.split(cand, r"(?i)[,&]|\band\b"), lambda s: F.trim(s)),
                      lambda s: s != "")
    halves = F.split(cand, r"(?i)\s*(?:&|and)\s*")
    sides = F.struct(only_words(F.get(halves, F.lit(0))).alias("one"),
                     only_words(F.get(halves, F.lit(1))).alias("two"))
    none = F.array(F.when(F.lit(False), _reading(F.lit(""), F.lit(""), "")))
    return F.array_compact(F.concat(
        F.when(joint & F.contains(cand, F.lit(",")), let(commas, family)).otherwise(none),
        F.when(joint, let(sides, pair)).otherwise(none),
        let(words(cand), alone)))


def _resolve(x: Column, name_list: Sequence[str], stop: Sequence[str], brand: Column,
             domain: Column) -> Column:
    """First reading of a candidate that is a plausible name, or NULL."""
    year = F.regexp_extract(x["whole"], patterns.FOUNDING_YEAR_PATTERN, 1)
    old = (year != "") & (year.try_cast("int") < patterns.FOUNDING_YEAR_FLOOR)
    titled = F.lower(x["cand"]).rlike("^(?:" + any_of(rules.HONORIFICS) + ")")
    good = F.filter(_readings(x, stop), lambda r: F.forall(r["names"], lambda n: (
        names.plausible_name(n, name_list, stop, brand, domain))))
    return F.when(~old & ~titled, let(F.get(good, F.lit(0)), lambda r: F.when(
        r.isNotNull(), F.struct(
            r["first_name"].alias("first_name"), r["last_name"].alias("last_name"),
            F.concat(F.lit("pat"), x["pat"].cast("string"), r["kind"]).alias("source")))))


def person_candidates(df: DataFrame, text: str, keys: Sequence[str],
                      table=patterns.SITE_PATTERNS, flags: str = "(?i)") -> DataFrame:
    """Pattern hits of a text as one small array, ``mentions``. Needs neither brand nor names,
    so long texts are left behind before anything is joined."""
    base = df.select(*keys, F.col(text).alias("_text"), F.lower(F.col(text)).alias("_low"))
    return base.select(*keys, mention_candidates(F.col("_text"), F.col("_low"), table, flags)
                       .alias("mentions"))


def resolve_candidates(df: DataFrame, brand: str, domain: str, keys: Sequence[str],
                       name_list: Sequence[str], stop: Sequence[str]) -> DataFrame:
    """First candidate of ``mentions`` that is a plausible name, by pattern and position."""
    hits = F.array_compact(F.transform("mentions", lambda x: _resolve(
        x, name_list, stop, F.col(brand), F.col(domain))))
    # a generator over the first hit: texts without one give no row, nothing runs twice
    return df.select(*keys, F.inline(F.slice(hits, 1, 1)))


def person_mentions(df: DataFrame, text: str, brand: str, domain: str, keys: Sequence[str],
                    name_list: Sequence[str], stop: Sequence[str],
                    table=patterns.SITE_PATTERNS, flags: str = "(?i)") -> DataFrame:
    """First person a text names, by pattern order and then by position.

    ``flags=""`` keeps the patterns' capitals meaningful; the default follows the
    case-blind reading, with the name check as the only guard.
    """
    named = df.withColumns({"_brand": F.col(brand), "_domain": F.col(domain)})
    found = person_candidates(named, text, [*keys, "_brand", "_domain"], table, flags)
    return resolve_candidates(found, "_brand", "_domain", keys, name_list, stop)


def read_pages(pages: DataFrame, markup: str = "html", domain: str = "domain",
               path: str = "path_no") -> DataFrame:
    """Everything the person flow wants of a page, read in one pass over its markup.

    Gives domain, path_no and small arrays or structs: ``emails`` (own addresses),
    ``schema`` (schema.org names), ``handle`` (channel handle as a name), ``mentions``
    (pattern hits of the visible text). Row-local: the markup is never shuffled.
    """
    site = domains.clean_domain(domain)
    keyed = pages.select(
        site.alias("domain"), F.col(path).alias("path_no"),
        sweep_list(markup, site).alias("emails"), schema_list(markup).alias("schema"),
        names.handle_name(F.regexp_extract(markup, patterns.VIDEO_HANDLE_PATTERN, 1))
        .alias("handle"), html.visible_text(markup).alias("_visible"))
    return person_candidates(keyed, "_visible",
                             ["domain", "path_no", "emails", "schema", "handle"])


def page_person(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Older page step: short pattern list, two or three words, phrase deny list."""
    base = df.select(*keys, F.col(text).alias("_text"), F.lower(F.col(text)).alias("_low"))
    cands = mention_candidates(F.col("_text"), F.col("_low"), patterns.PAGE_PATTERNS)
    good = F.filter(cands, lambda x: F.size(words(x["cand"])).between(2, 3)
                    & ~contains_any(F.lower(x["cand"]), patterns.PAGE_PHRASE_DENY))
    first = base.select(*keys, F.inline(F.slice(good, 1, 1)))
    parts = words(F.col("cand"))
    return first.select(
        *keys, capitalize(F.get(parts, F.lit(0))).alias("first_name"),
        capitalize(F.array_join(F.slice(parts, 2, 2), " ")).alias("last_name"))


def bio_text(markup: Column | str) -> Column:
    """Profile biography field of a raw page, escapes undone."""
    bio = F.regexp_extract(col(markup), patterns.BIO_PATTERN, 1)
    bio = F.replace(F.replace(bio, F.lit("\\n"), F.lit(" ")), F.lit("\\u0026"), F.lit("&"))
    return F.when(bio != "", bio)


def schema_list(markup: Column | str) -> Column:
    """Names in schema.org blocks, in order, as an array of (first, last, pos) structs.

    People of an organisation by role and position, or a person with a leading role.
    Blocks, items, types and people may be single or listed; broken JSON gives nothing.
    """
    blocks = F.regexp_extract_all(col(markup), F.lit(patterns.SCHEMA_BLOCK_PATTERN), F.lit(1))

    def listed(value: Column, path: str) -> Column:
        """The field as an array, also where it is a single value."""
        return F.coalesce(F.try_variant_get(value, path, "array<variant>"),
                          F.array_compact(F.array(F.try_variant_get(value, path, "variant"))))

    def text(value: Column, path: str) -> Column:
        return F.try_variant_get(value, path, "string")

    def named(people: Column) -> Column:
        return F.transform(people, lambda p, i: F.struct(i.alias("pos"),
                                                         text(p, "$.name").alias("name")))

    def of_item(item: Column) -> Column:
        kinds = F.transform(listed(item, "$['@type']"), lambda t: F.lower(text(t, "$")))
        org = F.flatten(F.array(*[named(listed(item, f"$.{key}"))
                                  for key in patterns.SCHEMA_PERSON_KEYS]))
        job = F.lower(F.coalesce(text(item, "$.jobTitle"), F.lit("")))
        none = F.array().cast("array<struct<pos:int,name:string>>")
        is_org = F.exists(kinds, lambda t: t.isin(*patterns.SCHEMA_ORG_TYPES))
        leads = (F.array_contains(kinds, F.lit("person"))
                 & contains_any(job, patterns.SCHEMA_JOB_TERMS))
        return F.concat(F.when(is_org, org).otherwise(none),
                        F.when(leads, named(F.array(item))).otherwise(none))

    def of_block(block: Column) -> Column:
        return let(F.try_parse_json(F.trim(block)), lambda v: F.flatten(F.transform(
            listed(v, "$"), of_item)))

    def split(found: Column) -> Column:
        return let(words(found["name"]), lambda w: F.when(F.size(w) >= 2, F.struct(
            capitalize(F.get(w, F.lit(0))).alias("first_name"),
            capitalize(F.get(w, F.lit(1))).alias("last_name"), found["pos"].alias("pos"))))

    return F.array_compact(F.transform(
        F.flatten(F.array_compact(F.transform(blocks, of_block))), split))


def schema_candidates(df: DataFrame, markup: str, keys: Sequence[str]) -> DataFrame:
    """One row per name in a page's schema.org blocks."""
    return df.select(*keys, F.inline(schema_list(markup)))


def schema_person(df: DataFrame, markup: str, keys: Sequence[str], name_list: Sequence[str],
                  stop: Sequence[str], brand: str | None = None,
                  domain: str | None = None) -> DataFrame:
    """First plausible name of the page's schema.org blocks."""
    return schema_choice(df.withColumn("_schema", schema_list(markup)), "_schema", keys,
                         name_list, stop, brand, domain)


def schema_choice(df: DataFrame, listed: str, keys: Sequence[str], name_list: Sequence[str],
                  stop: Sequence[str], brand: str | None = None,
                  domain: str | None = None) -> DataFrame:
    """First plausible name of a ``schema_list`` column."""
    good = F.filter(listed, lambda p: names.plausible_name(
        F.concat_ws(" ", p["first_name"], p["last_name"]), name_list, stop,
        F.col(brand) if brand else None, F.col(domain) if domain else None))
    first = df.select(*keys, F.inline(F.slice(good, 1, 1)))
    return first.select(*keys, "first_name", "last_name")


def feed_author(markup: Column | str) -> Column:
    """Author of a feed as a struct: e-mail, first name, last name (NULLs if absent)."""
    page = col(markup)
    nested = F.regexp_extract(page, patterns.FEED_EMAIL_PATTERN, 1)
    editor = F.regexp_extract(page, patterns.FEED_EDITOR_PATTERN, 1)
    email = F.trim(F.when(nested != "", nested).when(editor != "", editor))
    parts = words(F.regexp_extract(page, patterns.FEED_AUTHOR_PATTERN, 1))
    named = F.size(parts) >= 2
    return F.struct(email.alias("email"),
                    F.when(named, capitalize(F.get(parts, F.lit(0)))).alias("first_name"),
                    F.when(named, capitalize(F.try_element_at(parts, F.lit(-1)))).alias("last_name"))


def api_author(body: Column | str) -> Column:
    """First author of a JSON author list: by name, else by slug; struct or NULL."""
    users = F.from_json(col(body), "array<struct<name:string,slug:string>>")
    user = F.get(users, F.lit(0))
    parts = words(F.coalesce(user["name"], F.lit("")))
    pieces = F.split(user["slug"], "[-_]")

    def make(p: Column, source: str) -> Column:
        return F.struct(capitalize(F.get(p, F.lit(0))).alias("first_name"),
                        capitalize(F.try_element_at(p, F.lit(-1))).alias("last_name"),
                        F.lit(source).alias("source"))

    return (F.when(F.size(parts) >= 2, make(parts, "author_api"))
            .when((F.size(parts) == 1) & (F.length(user["slug"]) > 2)
                  & (F.size(pieces) >= 2), make(pieces, "author_api_slug")))


def registration_json_person(body: Column | str) -> Column:
    """Full name of the registrant or administrative entity; NULL for privacy services."""
    shape = ("struct<entities:array<struct<roles:array<string>,"
             "vcardArray:array<string>>>>")
    entities = F.from_json(col(body), shape)["entities"]
    wanted = F.filter(entities, lambda e: F.arrays_overlap(
        e["roles"], F.array(F.lit("registrant"), F.lit("administrative"))))
    cards = F.transform(wanted, lambda e: F.from_json(F.get(e["vcardArray"], F.lit(1)),
                                                      "array<array<string>>"))
    fields = F.filter(F.flatten(F.filter(cards, lambda c: c.isNotNull())),
                      lambda f: F.get(f, F.lit(0)) == "fn")
    found = F.filter(F.transform(fields, lambda f: F.trim(F.get(f, F.lit(3)))),
                     lambda n: (F.size(words(n)) >= 2)
                     & ~contains_any(F.lower(n), rules.PRIVACY_NAMES))
    return F.get(found, F.lit(0))


def registration_text_person(body: Column | str) -> Column:
    """Name on the first registrant, admin or owner line of a registration text."""
    lines = F.split(col(body), r"\r?\n")
    values = F.transform(lines, lambda x: F.trim(F.regexp_extract(
        x, patterns.REGISTRANT_LINE_PATTERN, 1)))
    found = F.filter(values, lambda v: (v != "")
                     & ~contains_any(F.lower(v), rules.PRIVACY_WORDS)
                     & F.size(words(v)).between(2, 3))
    return F.get(found, F.lit(0))


def company_number(markup: Column | str, domain: Column | str) -> Column:
    """Registered company number, only for home-country sites."""
    page, domain = col(markup), col(domain)
    number = F.regexp_extract(page, patterns.COMPANY_NUMBER_PATTERN, 1)
    home = (F.endswith(F.lower(domain), F.lit(".uk"))
            | (domains.country_from_tld(domain, "codes") == "UK")
            | contains_any(F.lower(page), rules.HOME_MARKERS))
    return F.when((number != "") & home, number)


# ------------------------------------------------------------------ cards, records
def rank_cards(cards: DataFrame, stop: Sequence[str] = ()) -> DataFrame:
    """Search cards that may speak about their domain, ranked by engine and position.

    Input: domain, brand, engine, engine_rank, pos, url, text. Adds the unwrapped
    ``target`` and ``rank`` within (domain, engine), a handful of cards; the text stays behind.
    """
    rows = cards.withColumn("target", domains.unwrap("url"))
    rows = rows.where(domains.trusted("target", "domain")
                      & domains.grounded("text", "domain", "brand", stop))
    place = Window.partitionBy("domain", "engine").orderBy("pos")
    return rows.drop("text").withColumn("rank", F.row_number().over(place))


def read_cards(cards: DataFrame, name_list: Sequence[str], stop: Sequence[str]) -> DataFrame:
    """First full person of every card that may be believed, with what it may be used for.

    ``for_vote``: trusted source whose text speaks about the business. ``for_profile``: a
    profile host that names the full domain.
    """
    rows = cards.withColumn("_target", domains.unwrap("url"))
    vote = (domains.trusted("_target", "domain")
            & domains.grounded("text", "domain", "brand", stop))
    profile = (contains_any(F.lower("_target"), rules.PROFILE_HOSTS)
               & F.contains(F.lower("text"), F.lower("domain")))
    # a generator keeps the tests from running once to filter and once to show
    flags = F.array(F.struct(vote.alias("for_vote"), profile.alias("for_profile")))
    rows = rows.select("*", F.inline(F.filter(
        flags, lambda f: f["for_vote"] | f["for_profile"])))
    keys = ["domain", "brand", "engine", "engine_rank", "pos", "for_vote", "for_profile"]
    found = person_candidates(rows, "text", keys)
    people = resolve_candidates(found, "brand", "domain", keys, name_list, stop)
    return people.where("last_name <> ''")


def votes_of(read: DataFrame) -> DataFrame:
    """One vote per (domain, engine): the first believed card that names a full person."""
    best = F.min_by(F.struct("first_name", "last_name", "source"), "pos").alias("p")
    return (read.where("for_vote").groupBy("domain", "engine", "engine_rank").agg(best)
            .select("domain", "engine", "engine_rank", "p.*"))


def profiles_of(read: DataFrame) -> DataFrame:
    """First person per domain on cards of profile hosts."""
    best = F.min_by(F.struct("first_name", "last_name"), F.struct("engine_rank", "pos"))
    return (read.where("for_profile").groupBy("domain").agg(best.alias("p"))
            .select("domain", "p.*"))


def card_votes(cards: DataFrame, name_list: Sequence[str], stop: Sequence[str]) -> DataFrame:
    """Votes straight from the cards."""
    return votes_of(read_cards(cards, name_list, stop))


def profile_cards(cards: DataFrame, name_list: Sequence[str],
                  stop: Sequence[str]) -> DataFrame:
    """Profile-host findings straight from the cards."""
    return profiles_of(read_cards(cards, name_list, stop))


def profile_head(text: Column | str) -> Column:
    """``First Last - headline`` at the start of a profile card, as a struct or NULL."""
    head = words(F.regexp_extract(col(text), patterns.PROFILE_HEAD_PATTERN, 1))
    return F.when(F.size(head) == 2, F.struct(
        capitalize(F.get(head, F.lit(0))).alias("first_name"),
        capitalize(F.get(head, F.lit(1))).alias("last_name")))


def answer_owner(text: Column | str) -> Column:
    """Owner of an answer box: a full name, else the first name of a pair; struct."""
    whole = words(F.regexp_extract(col(text), patterns.ANSWER_OWNER_PATTERN, 1))
    one = F.regexp_extract(col(text), patterns.ANSWER_PAIR_PATTERN, 1)
    return (F.when(F.size(whole) >= 2, F.struct(
        capitalize(F.get(whole, F.lit(0))).alias("first_name"),
        capitalize(F.try_element_at(whole, F.lit(-1))).alias("last_name")))
        .when(one != "", F.struct(capitalize(one).alias("first_name"),
                                  F.lit("").alias("last_name"))))


def dns_json(df: DataFrame, body: str, keys: Sequence[str]) -> DataFrame:
    """DNS JSON answers to rows (pref, host); a bare value gets preference 10."""
    answers = F.from_json(F.col(body), "struct<Answer:array<struct<data:string>>>")["Answer"]
    rows = df.select(*keys, F.explode(answers).alias("_a"))
    value = F.regexp_replace(F.trim(F.col("_a.data")), r"\.+$", "")
    two = value.rlike(r"^\d+\s+\S")
    return (rows.where(value != "")
            .select(*keys,
                    F.when(two, F.regexp_extract(value, r"^(\d+)\s", 1).try_cast("int"))
                    .otherwise(10).alias("pref"),
                    F.when(two, F.regexp_replace(value, r"^\d+\s+", ""))
                    .otherwise(value).alias("host")))


def snapshots(df: DataFrame, body: str, keys: Sequence[str], n: int = 3) -> DataFrame:
    """Archive index (header row, then rows) to the first n snapshots."""
    table = F.from_json(F.col(body), "array<array<string>>")
    rows = df.select(*keys, F.posexplode(F.slice(table, 2, n)).alias("pos", "_r"))
    return rows.select(*keys, "pos", F.get("_r", F.lit(0)).alias("taken_at"),
                       F.get("_r", F.lit(1)).alias("original"))
