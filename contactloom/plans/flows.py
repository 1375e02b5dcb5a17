"""The three end-to-end flows, composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import domains, emails, names
from contactloom.functions.text import capitalize, let, words
from contactloom.operators import classify, contacts, extract, match, people, rank
from contactloom.operators.join import lookup
from contactloom.session import materialise


def registry_to_work_list(registry: DataFrame, seen: DataFrame,
                          per_category: int = rules.QUOTA_PER_CATEGORY,
                          n_slices: int = rules.SLICE_COUNT, spill: bool = True,
                          order: Sequence[str] = ("source_prio", "seq")) -> DataFrame:
    """Registry rows to an interleaved, sliced work list.

    Known domains out, category by keyword, quota per category (with spill to a row's next
    category by default), round-robin over categories, slices.
    """
    fresh = rank.exclude_seen(registry.where("domain <> ''"), seen, ["domain"])
    text = classify.joined_text("domain", "brand", "tags", "tech")
    if spill:
        picked = rank.quota_with_spill(fresh, classify.registry_matches(text), per_category,
                                       "domain", order)
    else:
        named = fresh.withColumn("niche", classify.classify(text, "registry"))
        unique = rank.first_wins(named.where("niche IS NOT NULL"), ["domain"], order)
        picked = rank.quota(unique, "niche", per_category, order).drop("niche_rank")
    names = [category for category, _ in rules.REGISTRY_KEYWORDS]
    placed = rank.interleave(picked, "niche", names, order)
    return rank.slices(placed, n_slices, position="position")


def pages_to_contacts(pages: DataFrame, stores: DataFrame, dns_answers: DataFrame,
                      block: Sequence[str] = rules.BLOCK_TERMS,
                      secondary: int | None = None) -> DataFrame:
    """Site pages to one contact row per deliverable address.

    ``pages``: domain, path_no, html (first page 0). ``stores``: domain, brand, niche. Each
    row lists the other addresses of its site, all or the first ``secondary``.
    """
    # pages are read once: what was found is small, is written, and feeds both branches
    read = materialise(pages.select(
        "domain", "path_no", extract.candidate_list("html", "domain").alias("found"),
        *extract.page_socials("html")))
    found = read.select("domain", "path_no", F.posexplode("found").alias("pos", "c"))
    found = found.select("domain", "path_no", "pos", "c.*").where(
        emails.is_valid_email("email", block=block))
    best = rank.first_wins(found, ["domain", "email"],
                           [F.col("score").desc(), F.col("path_no"), F.col("pos")])
    social = extract.site_socials(read, "domain", ["path_no"])
    related = rank.siblings(
        best.withColumn("ord", -F.col("score")), "domain", "email", n=secondary,
        order=["ord", "path_no", "pos"], distinct=False)
    facts = match.deliverable(match.attach_dns(
        related.select("domain", "email", "score", "secondary_email"),
        match.collapse_dns(dns_answers, "inbox", gate=True)))
    site = stores.select("domain", "brand", "niche").join(social, "domain", "full")
    joined = lookup(facts.drop("score"), site, "domain")
    brand = domains.brand_or_default("brand", "domain")
    role = emails.role_from_local("email")
    rows = match.status_texts(joined.withColumn("company", brand)).select(
        "*", role.alias("role"),
        classify.classify(classify.joined_text("company", "domain", "email"),
                          "strict_initial", F.col("niche")).alias("final_niche"),
        emails.deliverability("inbox", F.col("dmarc"), F.col("spf"),
                              F.col("instagram").isNotNull()).alias("points"))
    return rows.select(
        F.col("role.first_name").alias("first_name"),
        F.col("role.last_name").alias("last_name"), "email", "secondary_email", "company",
        F.concat(F.lit("https://"), F.col("domain")).alias("website"),
        F.col("role.title").alias("title"), domains.search_url("company").alias("ads_url"),
        F.col("final_niche").alias("niche"),
        domains.country_from_tld("domain").alias("country"), "instagram", "facebook",
        "linkedin", "tiktok", "twitter_x", "mx_status", "dmarc_status", "spf_status",
        F.lit("No").alias("profile_found"), contacts.score_label(F.col("points")).alias("score"),
        classify.template_text(F.col("company"), F.col("final_niche"), "niche").alias("note"))


def enrich_people(inputs: DataFrame, tiers: Sequence[DataFrame], name_list: Sequence[str],
                  stop: Sequence[str],
                  addresses: Sequence[str] = ("email", "secondary_email")) -> DataFrame:
    """Person per input row from its addresses, its brand and the given evidence tables.

    ``inputs``: domain, brand and address columns. ``tiers``: frames in the evidence form.
    Addresses and brand are read inside the row; rows are never lost.
    """
    domain = domains.clean_domain("domain")
    local = [people.entry(1.0, people.address_person([F.col(a) for a in addresses], name_list,
                                                     stop, F.col("brand"), domain)),
             people.entry(1.5, names.namesake(F.col("brand"), domain, name_list, stop))]
    return people.resolve_people(inputs, people.stack(tiers) if tiers else None, local)


def person_evidence(inputs: DataFrame, name_list: Sequence[str], stop: Sequence[str], *,
                    author_api: DataFrame | None = None, feeds: DataFrame | None = None,
                    pages: DataFrame | None = None, cards: DataFrame | None = None,
                    registrations: DataFrame | None = None, bios: DataFrame | None = None,
                    companies: DataFrame | None = None) -> list[DataFrame]:
    """Evidence tables of the tiers beyond the row itself, from collected records.

    Tables by domain: ``author_api`` and ``feeds`` (body), ``pages`` (as ``read_pages`` gives
    them; path_no 0 is the home page), ``registrations`` (kind json or text, body), ``bios``
    (html). ``cards`` as for ``extract.card_votes`` without brand. ``companies``: company_no,
    name, officers.
    """
    sites = rank.first_wins(
        inputs.select(domains.clean_domain("domain").alias("domain"), "brand")
        .where("domain <> ''"), ["domain"], ["brand"])

    def with_brand(df: DataFrame) -> DataFrame:
        """Rows with their site's brand; callers read raw bodies first and join the result."""
        return lookup(df.withColumn("domain", domains.clean_domain("domain")), sites,
                      "domain").where("brand IS NOT NULL")

    def plausible(df: DataFrame) -> DataFrame:
        whole = names.full_name(F.col("first_name"), F.col("last_name"))
        return df.where(names.plausible_name(whole, name_list, stop, F.col("brand"),
                                             F.col("domain")))

    def people_of(df: DataFrame, person: Column) -> DataFrame:
        return plausible(df.select("domain", "brand",
                                   F.inline(F.array_compact(F.array(person)))))

    out: list[DataFrame] = []
    if author_api is not None:
        read = author_api.select("domain", extract.api_author("body").alias("person"))
        found = people_of(with_brand(read.where("person IS NOT NULL")), F.col("person"))
        out.append(people.evidence(found, 0.0, "author_api", "HIGH"))
    if feeds is not None:
        read = feeds.select("domain", extract.feed_author("body").alias("person"))
        found = people_of(with_brand(read.where("person.first_name IS NOT NULL")),
                          F.col("person"))
        out.append(people.evidence(found, 0.1, "feed_author", "HIGH"))
    if pages is not None:
        # brand joins what was read of a page, never the page itself
        some = pages.where("size(schema) > 0 OR size(mentions) > 0 OR handle IS NOT NULL")
        rows = with_brand(some)
        keys = ["domain", "path_no"]
        by_schema = extract.schema_choice(rows, "schema", keys, name_list, stop, "brand",
                                          "domain")
        out.append(people.evidence(by_schema, 2.0, "site_schema", "HIGH",
                                   pos=F.col("path_no") * 10))
        by_text = extract.resolve_candidates(rows, "brand", "domain", keys, name_list, stop)
        full = F.col("last_name") != ""
        by_text = by_text.where(full | (F.col("path_no") > 0))  # home page: full names only
        out.append(people.evidence(by_text, 2.0, "site_text", F.when(full, "HIGH")
                                   .otherwise("MEDIUM"), pos=F.col("path_no") * 10 + 2))
        whole = names.full_name(F.col("first_name"), F.col("last_name"))
        by_handle = people_of(rows.where("path_no = 0"), F.col("handle")).where(
            names.plausible_name(whole, name_list, stop, strict=True))
        out.append(people.evidence(by_handle, 2.0, "site_handle", "HIGH",
                                   pos=F.lit(1)))
    if cards is not None:
        read = materialise(extract.read_cards(with_brand(cards), name_list, stop))
        votes = people.vote(extract.votes_of(read))
        out.append(people.evidence(votes, 3.0, "search", F.col("conf")))
        directory = extract.profiles_of(read)
        out.append(people.evidence(directory, 4.1, "directory_cards", "HIGH"))
    if registrations is not None:
        person = words(F.when(F.col("kind") == "json", extract.registration_json_person("body"))
                       .otherwise(extract.registration_text_person("body")))
        named = let(person, lambda p: F.when(F.size(p) >= 2, F.struct(
            capitalize(F.get(p, F.lit(0))).alias("first_name"),
            capitalize(F.try_element_at(p, F.lit(-1))).alias("last_name"))))
        read = registrations.select("domain", named.alias("person")).where("person IS NOT NULL")
        out.append(people.evidence(people_of(with_brand(read), F.col("person")), 4.0,
                                   "registration", "HIGH"))
    if bios is not None:
        rows = with_brand(bios.select("domain", extract.bio_text("html").alias("bio")))
        found = extract.person_mentions(rows, "bio", "brand", "domain", ["domain"], name_list,
                                        stop).where("last_name <> ''")
        out.append(people.evidence(found, 4.2, "profile_bio", "HIGH"))
    if companies is not None:
        first_officer = F.get(F.array_compact(F.transform("officers", names.officer_name)),
                              F.lit(0))
        officers = companies.select("company_no", F.inline(F.array_compact(
            F.array(first_officer)))).dropDuplicates(["company_no"])
        gated = people.registry_gate(sites, stop)
        hits = match.match_company(gated, companies.select("company_no", "name"))
        found = lookup(hits, officers, "company_no").where("first_name IS NOT NULL")
        out.append(people.evidence(plausible(found), 4.3, "company_register", "HIGH"))
    return out


def people_from_sources(inputs: DataFrame, name_list: Sequence[str], stop: Sequence[str],
                        profiles: DataFrame | None = None, **sources: DataFrame) -> DataFrame:
    """The whole person flow: one row per input row, with name, address and chain.

    ``inputs``: domain, brand, email, secondary_email. Addresses found on the site's pages
    join the row's own ones; the best personal one replaces the inbox. A profile that is
    registered for the address names the person where nothing else did. No made-up address is
    ever returned.
    """
    rows = inputs.withColumn("domain", domains.clean_domain("domain"))
    found = ["found_1", "found_2"]
    if sources.get("pages") is not None:
        sources["pages"] = materialise(extract.read_pages(sources["pages"]))
        swept = sources["pages"].select("domain", "path_no", F.inline("emails"))
        swept = swept.withColumns({"is_personal": emails.is_personal("email"),
                                   "pos": F.struct("path_no", "email")})
        best = rank.top_candidates(swept, "domain", 2, by="personal")
        listed = best.groupBy("domain").agg(F.array_sort(F.collect_list(F.struct(
            "rank", "email", "is_personal"))).alias("_found"))
        rows = lookup(rows, listed, "domain")
        rows = rows.withColumns({n: F.get("_found", F.lit(i))["email"]
                                 for i, n in enumerate(found)})
        rows = rows.withColumn("site_email", F.when(
            F.get("_found", F.lit(0))["is_personal"], F.col("found_1"))).drop("_found")
    else:
        rows = rows.withColumns({n: F.lit(None).cast("string")
                                 for n in (*found, "site_email")})
    tiers = person_evidence(inputs, name_list, stop, **sources)
    out = enrich_people(rows, tiers, name_list, stop,
                        ("site_email", "email", "secondary_email", *found))
    address = emails.clean_email(F.coalesce("email", F.lit("")), "input")
    out = out.withColumns({
        "person_email": F.coalesce("site_email", address),
        "email_pattern": F.when(F.col("site_email") != address, "site_discovered")
        .otherwise("store_email")})
    if profiles is None:
        return out.withColumn("profile_found", F.lit(False)).drop(*found)
    known = profiles.groupBy("email_hash").agg(F.lit(True).alias("profile_found"))
    out = lookup(out.withColumn("email_hash", emails.email_hash("person_email")), known,
                 "email_hash")
    # rows without a name try their address, then the site's inbox, then nothing else
    out = materialise(out.withColumn("_row", F.monotonically_increasing_id()))
    unnamed = out.where("first_name = '' AND domain <> ''").select(
        "_row", F.lit("info").alias("first_name"), "last_name", "domain", "person_email")
    hits = match.confirm_candidates(unnamed, profiles, "_row", given="person_email").select(
        "_row", "display_name", F.col("email").alias("_profile_email"))
    out = lookup(out, hits, "_row")
    shown = words(F.coalesce("display_name", F.lit("")))
    first = capitalize(F.get(shown, F.lit(0)))
    last = capitalize(F.array_join(F.slice(shown, 2, F.greatest(F.size(shown), F.lit(1))), " "))
    full = F.size(shown) >= 2
    whole = F.when(full, F.concat_ws(" ", first, last)).otherwise(first)
    use = ((F.size(shown) >= 1)
           & names.plausible_name(whole, name_list, stop, F.col("brand"), F.col("domain")))
    use = F.coalesce(use, F.lit(False))
    out = out.withColumns({
        "first_name": F.when(use, first).otherwise(F.col("first_name")),
        "last_name": F.when(use & full, last).otherwise(F.col("last_name")),
        "confidence": F.when(use, F.when(full, "HIGH").otherwise("MEDIUM"))
        .otherwise(F.col("confidence")),
        "source": F.when(use, "profile").otherwise(F.col("source")),
        "source_chain": F.when(use, F.when(F.col("source_chain") == "store_inbox", "profile")
                               .otherwise(F.concat("source_chain", F.lit("|profile"))))
        .otherwise(F.col("source_chain")),
        "person_email": F.when(use & full, F.col("_profile_email"))
        .otherwise(F.col("person_email")),
        "email_pattern": F.when(use & full, "profile_validated")
        .otherwise(F.col("email_pattern")),
        "profile_found": F.coalesce("profile_found", F.lit(False))})
    found += ["_row", "_profile_email"]
    out = out.withColumn("full_name", F.trim(F.concat_ws(" ", "first_name", "last_name")))
    return out.drop("email_hash", "display_name", *found)


def consolidate(frames: Sequence[DataFrame]) -> DataFrame:
    """Contact files in priority order to one master: first wins, defaults, category, text.

    Each frame carries ``seq``, its row order.
    """
    stacked = contacts.require(rank.union_sources(*frames, prio="file_prio"))
    unique = rank.first_wins(stacked, ["email"], ["file_prio", "seq"])
    filled = contacts.fill_defaults(unique)
    text = classify.joined_text("company", "website", "email")
    niche = F.col("niche") if "niche" in filled.columns else F.lit(None).cast("string")
    filled = filled.withColumn("niche", classify.classify(text, "strict_fallback", niche))
    note = classify.template_text(F.col("company"), F.col("niche"))
    have = F.col("note") if "note" in filled.columns else F.lit(None).cast("string")
    return filled.withColumn("note", F.coalesce(F.nullif(have, F.lit("")), note))
