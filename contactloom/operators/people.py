"""Who decides at a domain: evidence rows, votes, and the waterfall over tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.functions import domains, emails, names
from contactloom.functions.text import blank_to_null, let
from contactloom.operators.join import lookup

EVIDENCE = ("domain", "tier", "pos", "conf", "first_name", "last_name", "source")


def evidence(df: DataFrame, tier: float, source: Column | str, conf: Column | str,
             first: str = "first_name", last: str = "last_name",
             pos: Column | None = None) -> DataFrame:
    """Bring one tier's findings into the common long form."""
    def text(x: Column | str) -> Column:
        return F.lit(x) if isinstance(x, str) else x

    return df.select(
        "domain", F.lit(float(tier)).alias("tier"),
        (F.lit(0) if pos is None else pos).cast("long").alias("pos"),
        text(conf).alias("conf"), F.col(first).alias("first_name"),
        F.coalesce(F.col(last), F.lit("")).alias("last_name"), text(source).alias("source"))


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def vote(df: DataFrame, key: str = "domain", engine_rank: str = "engine_rank") -> DataFrame:
    """Most named person per key; a tie goes to the earliest engine.

    Input has one row per (key, engine). Two or more votes make it VERIFIED, else HIGH.
    Both steps are partial aggregates.
    """
    counted = df.groupBy(key, "first_name", "last_name").agg(
        F.count(F.lit(1)).alias("votes"), F.min(engine_rank).alias("first_engine"))
    order = F.struct((-F.col("votes")).alias("v"), "first_engine", "first_name", "last_name")
    best = counted.groupBy(key).agg(F.min_by(
        F.struct("first_name", "last_name", "votes", "first_engine"), order).alias("b"))
    return best.select(key, "b.*", F.when(F.col("b.votes") >= 2, "VERIFIED").otherwise("HIGH")
                       .alias("conf"))


ENTRY = ("struct<tier:double,pos:bigint,source:string,conf:string,first_name:string,"
         "last_name:string>")
NO_ENTRIES = f"array<{ENTRY}>"


def entry(tier: float, person: Column) -> Column:
    """A person struct of a row-local reading as one evidence entry, NULL if there is none."""
    return F.when(person.isNotNull(), F.struct(
        F.lit(tier).alias("tier"), F.lit(0).cast("long").alias("pos"),
        person["source"].alias("source"), person["confidence"].alias("conf"),
        person["first_name"].alias("first_name"), person["last_name"].alias("last_name"))
        .cast(ENTRY))


def collect_evidence(evidence_rows: DataFrame, key: str = "domain") -> DataFrame:
    """Evidence per key as one array.

    Evidence is first folded to the best stopping and the best other row per (key, tier,
    source), so the array is bounded by twice the number of sources, however much was
    found for a key.
    """
    stops = F.col("conf").isin("HIGH", "VERIFIED")
    order = F.struct("pos", "first_name", "last_name",
                     (-names.confidence_rank("conf")).alias("strength"))
    row = F.struct("tier", "pos", "source", "conf", "first_name", "last_name")
    folded = evidence_rows.groupBy(key, "tier", "source").agg(
        F.min_by(row, F.when(stops, order)).alias("strong"),
        F.min_by(row, F.when(F.col("conf") == "MEDIUM", order)).alias("weak"))
    both = F.array_compact(F.array("strong", "weak"))
    return folded.groupBy(key).agg(F.flatten(F.collect_list(both)).cast(NO_ENTRIES)
                                   .alias("evidence"))


def judge(entries: Column) -> Column:
    """Best person of an evidence array and the chain of sources read up to it.

    HIGH and VERIFIED stop at the first entry that has them; without one the first MEDIUM
    stands. The chain lists each source once, by tier and position, up to the stop.
    """
    def read(found: Column) -> Column:
        strong = F.get(F.filter(found, lambda e: e["conf"].isin("HIGH", "VERIFIED")), F.lit(0))
        weak = F.get(F.filter(found, lambda e: e["conf"] == "MEDIUM"), F.lit(0))
        return let(F.struct(found.alias("all"), strong.alias("strong"),
                            F.coalesce(strong, weak).alias("best")), result)

    def place(e: Column) -> Column:
        return F.struct(e["tier"], e["pos"], e["source"])

    def result(x: Column) -> Column:
        best = x["best"]
        chain = F.filter(x["all"], lambda e: x["strong"].isNull()
                         | (place(e) <= place(x["strong"])))
        sources = F.array_distinct(F.transform(chain, lambda e: e["source"]))
        return F.struct(
            best["first_name"].alias("first_name"), best["last_name"].alias("last_name"),
            best["conf"].alias("confidence"), best["source"].alias("source"),
            best["tier"].alias("tier"), F.array_join(sources, "|").alias("source_chain"))

    return let(F.array_sort(entries), read)


def waterfall(evidence_rows: DataFrame, key: str = "domain") -> DataFrame:
    """Best person per key over the tiers, with confidence and source chain."""
    return collect_evidence(evidence_rows, key).select(
        key, F.inline(F.array(judge(F.col("evidence")))))


def address_person(columns: Sequence[Column], name_list: Sequence[str], stop: Sequence[str],
                   brand: Column, domain: Column) -> Column:
    """The first address that reads as a full name, else the first given name; or NULL."""
    parsed = F.array_compact(F.transform(
        F.array(*[emails.clean_email(c, "input") for c in columns]),
        lambda e: names.parse_local_name(e, name_list, stop, brand, domain)))
    return let(parsed, lambda found: F.coalesce(
        F.get(F.filter(found, lambda p: p["confidence"] == "HIGH"), F.lit(0)),
        F.get(found, F.lit(0))))


def resolve_people(inputs: DataFrame, evidence_rows: DataFrame | None = None,
                   local: Sequence[Column] = ()) -> DataFrame:
    """Waterfall result for every input row; rows without evidence stay, as STANDARD.

    ``evidence_rows`` speak about domains, ``local`` entries about the row itself (its
    addresses, its brand). Rows of one domain share the former and keep their own latter.
    """
    rows = inputs.withColumn("domain", domains.clean_domain("domain"))
    empty = F.array().cast(NO_ENTRIES)
    if evidence_rows is None:
        rows = rows.withColumn("evidence", empty)
    else:
        known = evidence_rows.where("domain <> '' AND conf IS NOT NULL")
        rows = lookup(rows, collect_evidence(known), "domain")
    own = F.array_compact(F.array(*local)) if local else empty
    entries = F.concat(F.coalesce("evidence", empty),
                       F.when(F.col("domain") != "", own).otherwise(empty))
    out = rows.select(*[c for c in rows.columns if c != "evidence"],
                      F.inline(F.array(judge(entries))))
    return out.withColumns({
        "first_name": F.coalesce("first_name", F.lit("")),
        "last_name": F.coalesce("last_name", F.lit("")),
        "full_name": F.trim(F.concat_ws(" ", "first_name", "last_name")),
        "confidence": F.coalesce("confidence", F.lit("STANDARD")),
        "source": F.coalesce("source", F.lit("store_inbox")),
        "source_chain": F.coalesce(blank_to_null("source_chain"), F.lit("store_inbox")),
        "reg_country": F.when(F.col("domain") != "",
                              domains.country_from_tld("domain", "codes")),
    })


def _one_per_row(df: DataFrame, person: Column, tier: float) -> DataFrame:
    """Evidence rows out of a person struct per row; no row where it is NULL."""
    rows = df.select("domain", F.inline(F.array_compact(F.array(person))))
    return rows.select(
        "domain", F.lit(tier).alias("tier"), F.lit(0).cast("long").alias("pos"),
        F.col("confidence").alias("conf"), "first_name", "last_name", "source")


def address_evidence(df: DataFrame, columns: Sequence[str], name_list: Sequence[str],
                     stop: Sequence[str], brand: str = "brand") -> DataFrame:
    """Tier 1: the first address that reads as a full name, else the first given name."""
    best = address_person([F.col(c) for c in columns], name_list, stop, F.col(brand),
                          F.col("domain"))
    return _one_per_row(df, best, 1.0)


def registry_gate(df: DataFrame, stop: Sequence[str], brand: str = "brand",
                  suffixes: Sequence[str] | None = None) -> DataFrame:
    """Sites worth a look-up in the home company register."""
    from contactloom import rules

    key = domains.brand_key(brand)
    return df.where(~domains.ends_with_any(F.lower(F.col("domain")),
                                           suffixes or rules.GATE_SUFFIXES)
                    & (F.length(key) >= 5)
                    & (~F.lower(key).isin(*stop) if stop else F.lit(True)))
