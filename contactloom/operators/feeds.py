"""Authors of all entries of a feed, read as XML.

RSS and Atom feeds are parsed with ``from_xml``, which knows CDATA, entities and namespaces.
Feeds that are no XML, as pages collected in the wild often are, go through the regular expressions
of ``extract.feed_author``, which know the first author only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.functions.text import capitalize, words
from contactloom.operators import extract

# Elements that carry an author. RSS: item/dc:creator, item/author (an address, often with the
# name in brackets), channel/managingEditor. Atom: entry/author and feed/author.
_PERSON = "STRUCT<name: STRING, email: STRING, _VALUE: STRING>"
_ITEM = f"STRUCT<creator: ARRAY<STRING>, author: ARRAY<{_PERSON}>>"
SCHEMA = (f"channel STRUCT<managingEditor: STRING, item: ARRAY<{_ITEM}>>, "
          f"author ARRAY<{_PERSON}>, entry ARRAY<{_ITEM}>")
OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE",
           "columnNameOfCorruptRecord": "broken", "ignoreSurroundingSpaces": "true"}
ADDRESS = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"


def parsed_feed(markup: Column) -> Column:
    """The feed as a struct, with the text itself in ``broken`` if it is no XML."""
    return F.from_xml(markup, f"{SCHEMA}, broken STRING", OPTIONS)


def as_person(name: Column, email: Column) -> Column:
    return F.struct(name.alias("name"), email.alias("email"))


def named(text: Column) -> Column:
    """A text such as ``a@b.c (Jane Roe)``, ``Jane Roe`` or ``a@b.c``."""
    email = F.regexp_extract(text, f"({ADDRESS})", 1)
    rest = F.trim(F.regexp_replace(F.regexp_replace(text, ADDRESS, " "), r"[()<>\s]+", " "))
    return as_person(F.nullif(rest, F.lit("")), F.nullif(email, F.lit("")))


def people_of(item: Column) -> Column:
    """Authors of one entry, in the order creator, author."""
    creators = F.coalesce(item["creator"], F.array().cast("array<string>"))
    authors = F.coalesce(item["author"], F.array().cast(f"array<{_PERSON}>"))
    return F.concat(
        F.transform(creators, lambda c: named(c)),
        F.transform(authors, lambda a: F.when(
            a["name"].isNotNull() | a["email"].isNotNull(), as_person(a["name"], a["email"]))
            .otherwise(named(a["_VALUE"]))))


def feed_people(feed: Column) -> Column:
    """All authors of a parsed feed: those of the entries in order, then the feed's own."""
    none = F.array().cast(f"array<{_ITEM}>")
    own = F.coalesce(feed["author"], F.array().cast(f"array<{_PERSON}>"))
    editor = F.when(feed["channel"]["managingEditor"].isNotNull(),
                    F.array(named(feed["channel"]["managingEditor"])))
    entries = F.concat(F.coalesce(feed["channel"]["item"], none), F.coalesce(feed["entry"], none))
    return F.concat(
        F.flatten(F.transform(entries, people_of)),
        F.transform(own, lambda a: as_person(a["name"], a["email"])),
        F.coalesce(editor, F.array().cast("array<struct<name: string, email: string>>")))


def feed_authors(df: DataFrame, key: str, markup: str) -> DataFrame:
    """``key, pos, email, first_name, last_name, source`` for each author of each feed.

    ``pos`` counts from 0 in the order of the entries; an author that writes several entries
    stands there once, at the first. Names have two words at least, else they are null; rows
    without name and address are left out. ``source`` is ``xml``, or ``text`` for the one author
    that is found in a feed that cannot be parsed. Null and empty feeds have no authors.
    """
    rows = df.where(F.length(F.trim(markup)) > 0).select(
        key, F.col(markup).alias("_markup"), parsed_feed(F.col(markup)).alias("_feed"))
    good = F.col("_feed").isNotNull() & F.col("_feed.broken").isNull()
    found = (rows.where(good)
             .select(key, F.posexplode(feed_people(F.col("_feed"))).alias("at", "who"))
             .select(key, "at", F.trim("who.email").alias("email"),
                     words(F.coalesce("who.name", F.lit(""))).alias("parts")))
    full = F.size("parts") >= 2
    people = found.select(
        key, "at", F.nullif("email", F.lit("")).alias("email"),
        F.when(full, capitalize(F.get("parts", F.lit(0)))).alias("first_name"),
        F.when(full, capitalize(F.try_element_at("parts", F.lit(-1)))).alias("last_name"),
        F.lit("xml").alias("source"))
    text = rows.where(~good).select(key, extract.feed_author("_markup").alias("a")).select(
        key, F.lit(0).alias("at"), "a.*", F.lit("text").alias("source"))
    known = people.unionByName(text).where("email IS NOT NULL OR first_name IS NOT NULL")
    once = known.groupBy(key, "email", "first_name", "last_name", "source").agg(
        F.min("at").alias("at"))
    # A feed's authors are few; the list is sorted inside its row.
    listed = once.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        "at", "email", "first_name", "last_name", "source"))).alias("_all"))
    return listed.select(key, F.posexplode("_all").alias("pos", "a")).select(
        key, "pos", "a.email", "a.first_name", "a.last_name", "a.source")
