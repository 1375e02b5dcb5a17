"""Hand-written rows for cases the driver tables lack. All names and hosts are invented."""

import pytest
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import domains, emails, html, names, social
from contactloom.functions.text import load_words, snippet
from contactloom.operators import audit, classify, contacts, extract, match, people, rank
from contactloom.plans import flows
from contactloom.sources import readers

NAMES = ("ada", "anna", "ann", "annabel", "grace", "jo", "john", "mary", "peter")
STOP = ("shop", "store", "team", "brand", "press", "designer", "contact", "box", "party",
        "bake", "run")


def rows(df):
    return [tuple(r) for r in df.collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("raw, prefix, anywhere", [
    (" HTTPS://www.Shop.example/a/b ", "shop.example", "shop.example"),
    ("http://https://shop.example", "https:", "shop.example"),
    ("www.www.shop.example", "www.shop.example", "shop.example"),
    ("my.www.shop.example", "my.www.shop.example", "my.shop.example"),
    ("", "", ""),
])
def test_clean_domain(spark, raw, prefix, anywhere):
    assert one(spark, domains.clean_domain(F.lit(raw))) == prefix
    assert one(spark, domains.clean_domain(F.lit(raw), "anywhere")) == anywhere


@pytest.mark.parametrize("domain, style, brand", [
    ("shopbloom.example", "crawl", "Bloom"), ("thebloomstore.example", "crawl", "Bloom"),
    ("shop.example", "crawl", "Shop"), ("wearbloomofficial.example", "ranked", "Bloom"),
    ("BLOOM.example", "label", "Bloom"), ("blue-moon2go.example", "title", "Blue Moon2Go"),
])
def test_brand_from_domain(spark, domain, style, brand):
    assert one(spark, domains.brand_from_domain(F.lit(domain), style)) == brand


@pytest.mark.parametrize("domain, code", [
    ("a.co.uk", "UK"), ("a.uk", "UK"), ("co.uk", "UK"), ("a.com.au", "AU"), ("a.com", "US"),
    ("a.io", "US"), ("a.fr", "INTL"), ("a.b.me.uk", "UK")])
def test_country_codes(spark, domain, code):
    assert one(spark, domains.country_from_tld(F.lit(domain), "codes")) == code


@pytest.mark.parametrize("email, ok", [
    ("info@bloom.test", True), ("a@b.c", False), ("no-at.test", False), ("a@b@c.test", False),
    ("info@bloom.x1", False), ("info@bloom.averyverylongtld", False),
    ("logo@2x.png", False), ("x@sub.example.com", False), ("noreply@bloom.test", False),
    ("support@shopify.test", False), ("@bloom.test", False)])
def test_email_validity(spark, email, ok):
    assert one(spark, emails.is_valid_email(F.lit(email))) is ok


def test_email_validity_bounds(spark):
    long = "a" * 120 + "@bloom.test"
    assert one(spark, emails.is_valid_email(F.lit(long))) is True
    assert one(spark, emails.is_valid_email(F.lit(long), bounds=(6, 120))) is False
    assert one(spark, emails.is_valid_email(F.lit("a@b@c.test"), (), (), parts="last")) is True


@pytest.mark.parametrize("local, title, first, last", [
    ("customer.care", "Customer Care / Operations Lead", "Support", "Lead"),
    ("press", "Head of Marketing & Growth", "Marketing", "Lead"),
    ("hello", "Founder / Marketing Lead", "Founder", "Team"),
    ("anna-bell_x", "Founder & Owner", "Anna", "Bell"),
    ("zoe", "Founder & Owner", "Zoe", "Founder"),
    ("loads", "Head of Marketing & Growth", "Marketing", "Lead")])
def test_role_from_local(spark, local, title, first, last):
    got = one(spark, emails.role_from_local(F.lit(local + "@bloom.test")))
    assert tuple(got) == (title, first, last)


def test_role_ads_only_in_worker_rules(spark):
    got = one(spark, emails.role_from_local(F.lit("loads@bloom.test"), "crawl"))
    assert got.first_name == "Loads"


@pytest.mark.parametrize("email, personal", [
    ("info@x.test", False), ("in.fo@x.test", False), ("a.b@x.test", True),
    ("anna@x.test", True), ("bo1@x.test", False), ("no-reply@x.test", False)])
def test_personal(spark, email, personal):
    assert one(spark, emails.is_personal(F.lit(email))) is personal


def test_protect(spark):
    assert one(spark, emails.protect(F.lit("anna@x.test"), "mask")) == "a***@x.test"
    assert one(spark, emails.protect(F.lit("Anna"), "mask", "name")) == "A***"
    assert len(one(spark, emails.protect(F.lit("anna@x.test"), "hash"))) == 64


@pytest.mark.parametrize("name, ok", [
    ("Anna Miller", True), ("Anna", True), ("Zoe", False), ("Zoe Miller", False),
    ("Zelda Miller", True), ("Jo Miller", True), ("Bo Miller", False), ("anna Miller", False),
    ("Anna miller", False), ("Anna M1ller", False), ("Anna Stores", False),
    ("Anna Parties", False), ("Anna Baking", False), ("Anna Baker", False),
    ("Anna Boxes", False), ("Anna Van", False), ("Anna X", False),
    ("Anna Bella Clara Dora Miller", False), ("", False), ("Änna Müller", True)])
def test_plausible_name(spark, name, ok):
    assert one(spark, names.plausible_name(F.lit(name), NAMES, STOP)) is ok


@pytest.mark.parametrize("name, brand, domain, ok", [
    ("Anna Miller", "Anna Miller", "x.test", False), ("Anna Miller", "Miller Goods", "", False),
    ("Anna Rye", "Rye Goods", "", True), ("Anna Miller", "", "miller.test", False),
    ("Anna Miller", "", "anna.test", False), ("Anna Miller", "Other", "other.test", True)])
def test_plausible_name_against_brand(spark, name, brand, domain, ok):
    got = names.plausible_name(F.lit(name), NAMES, STOP, F.lit(brand), F.lit(domain))
    assert one(spark, got) is ok


def test_older_name_rule(spark):
    for name, ok in (("Anna Miller", True), ("Zelda Miller", False), ("Anna B C D", False),
                     ("Anna", True), ("Anna shop", False)):
        assert one(spark, names.short_plausible_name(F.lit(name), NAMES, STOP)) is ok


@pytest.mark.parametrize("email, want", [
    ("anna.miller@x.test", ("Anna", "Miller", "HIGH")),
    ("annabelmiller@x.test", ("Annabel", "Miller", "HIGH")),
    ("annaway@x.test", ("Anna", "Way", "HIGH")),
    ("annabox@x.test", None),
    ("grace@x.test", ("Grace", "", "MEDIUM")),
    ("info@x.test", None), ("no at", None), ("//anna.miller@x.test", ("Anna", "Miller", "HIGH"))])
def test_parse_local_name(spark, email, want):
    got = one(spark, names.parse_local_name(F.lit(email), NAMES, STOP))
    assert (got and (got.first_name, got.last_name, got.confidence)) == want


def test_namesake(spark):
    got = one(spark, names.namesake(F.lit("Grace Hollow"), F.lit("gracehollow.test"), NAMES, STOP))
    assert (got.first_name, got.last_name) == ("Grace", "Hollow")
    for brand, domain in (("Grace Hollow", "other.test"), ("Zelda Hollow", "zeldahollow.test"),
                          ("Grace Hollow Co", "gracehollow.test")):
        assert one(spark, names.namesake(F.lit(brand), F.lit(domain), NAMES, STOP)) is None


def test_variants_keep_order_without_repeats(spark):
    got = one(spark, names.address_variants(F.lit("Al"), F.lit("A"), F.lit("x.test")))
    assert got == ["al@x.test", "al.a@x.test", "ala@x.test", "aa@x.test", "a.al@x.test",
                   "al_a@x.test"]
    assert one(spark, names.address_variants(F.lit("Al"), F.lit(""), F.lit("x.test"))) == [
        "al@x.test"]
    assert one(spark, names.address_variants(F.lit(""), F.lit(""), F.lit("x.test"), "older"))[
        0] == "founder@x.test"


def test_max_confidence(spark):
    assert one(spark, names.max_confidence(F.lit("HIGH"), F.lit("VERIFIED"))) == "VERIFIED"
    assert one(spark, names.max_confidence(F.lit("MEDIUM"), F.lit("STANDARD"))) == "MEDIUM"


@pytest.mark.parametrize("href, platform, want", [
    ("https://www.instagram.com/bloom/?hl=en", "instagram", "https://www.instagram.com/bloom"),
    ("https://instagram.com/explore/x", "instagram", None),
    ("https://instagram.com/p/abc", "instagram", None),
    ("https://facebook.com/bloom/about", "facebook", "https://www.facebook.com/bloom"),
    ("https://facebook.com/sharer/sharer.php", "facebook", None),
    ("https://facebook.com/pages/x", "facebook", None),
    ("https://linkedin.com/company/bloom/", "linkedin", "https://linkedin.com/company/bloom"),
    ("https://linkedin.com/in/anna", "linkedin", None),
    ("https://tiktok.com/@bloom?x=1", "tiktok", "https://www.tiktok.com/@bloom"),
    ("https://twitter.com/bloom", "twitter", "https://x.com/bloom"),
    ("https://x.com/intent/tweet", "twitter", None),
    ("https://x.com/home", "twitter", None), ("", "twitter", None)])
def test_canonical_social(spark, href, platform, want):
    assert one(spark, social.canonical_social(F.lit(href), platform)) == want


def xor_hex(text, key=0x2a):
    return "%02x" % key + "".join("%02x" % (ord(c) ^ key) for c in text)


PAGE = f"""<html><head><title> Bloom &amp; Co </title>
<script type="application/ld+json">{{"@type":"Store","founder":{{"name":"grace hollow"}}}}</script>
<script type="application/ld+json">{{broken</script>
</head><body><header>Founder: Peter Header</header><nav>About John Navigator –</nav>
<a href="MAILTO:Hello@Bloom.test?subject=x">mail</a>
<span data-cfemail="{xor_hex('grace@bloom.test')}"></span>
team&#64;bloom&#46;test sales@mail.bloom.test. other@else.test sprite@2x.png
<a class="n" href="https://www.instagram.com/bloom_one/">i</a>
<a href="https://instagram.com/bloom_two">j</a>
<a href="/pages/Contact-Us">c</a></body></html>"""


@pytest.fixture(scope="module")
def page(spark):
    return spark.createDataFrame([(1, "bloom.test", PAGE)], "id INT, domain STRING, html STRING")


def test_sweep_finds_all_encodings(page):
    got = dict(rows(extract.sweep_emails(page, "html", "domain", ["id"]).select(
        "email", "encoding")))
    assert got == {"hello@bloom.test": "mailto", "grace@bloom.test": "xor",
                   "team@bloom.test": "entity", "sales@mail.bloom.test": "plain"}


def test_candidates_and_scores(page):
    got = rows(extract.page_candidates(page, "html", "domain", ["id"]).select("email", "score"))
    assert got == [("hello@bloom.test", 100), ("hello@bloom.test", 100),
                   ("sales@mail.bloom.test", 100), ("other@else.test", 60)]


def test_page_links_and_socials(page):
    links = [r[1] for r in rows(extract.page_links(page, "html", ["id"]).select("pos", "href"))]
    assert links[1] == "https://www.instagram.com/bloom_one/" and len(links) == 4
    got = page.select(*extract.page_socials("html")).first()
    assert got.instagram == "https://www.instagram.com/bloom_one" and got.facebook is None


def test_contact_link_styles(page):
    got = page.select(extract.contact_link("html", "domain").alias("a"),
                      extract.contact_link("html", "domain", "relative").alias("b"),
                      extract.contact_link("html", "domain", "own").alias("c")).first()
    assert got.a == got.b == got.c == "https://bloom.test/pages/Contact-Us"


def test_next_pages_use_link_texts(spark):
    df = spark.createDataFrame([("x.test", '<a href="/p/1"><b>Our Story</b></a><a href="/cart/'
                                 'about">About</a><a href="team">t</a><a href="https://o.test/'
                                 'about">o</a>')], "domain STRING, html STRING")
    got = df.select(extract.candidate_pages("html", "domain", 3).alias("u")).first().u
    assert got == ["https://x.test/p/1", "https://x.test/team",
                   "https://x.test" + rules.ABOUT_PATHS[0]]


def test_title_and_visible_text(page):
    got = page.select(html.title_of("html").alias("t"), html.visible_text("html").alias("v"),
                      html.visible_text_dom("html").alias("d")).first()
    assert got.t == "Bloom &amp; Co"
    for text in (got.v, got.d):
        assert "Header" not in text and "Navigator" not in text and "mail" in text


def test_schema_person(spark, page):
    assert rows(extract.schema_person(page, "html", ["id"], NAMES, STOP)) == [
        (1, "Grace", "Hollow")]
    more = spark.createDataFrame([
        (1, '<script type="application/ld+json">[{"@type":"Person","name":"Anna Miller",'
            '"jobTitle":"Co-Founder & CEO"}]</script>'),
        (2, '<script type="application/ld+json">{"@type":"Person","name":"Anna Miller",'
            '"jobTitle":"Intern"}</script>'),
        (3, '<script type="application/ld+json">{"@type":["Brand"],"employee":[{"name":"Shop '
            'Team"},{"name":"Peter Hall"}]}</script>')], "id INT, html STRING")
    assert sorted(rows(extract.schema_person(more, "html", ["id"], NAMES, STOP))) == [
        (1, "Anna", "Miller"), (3, "Peter", "Hall")]


@pytest.mark.parametrize("text, want", [
    ("Founded by Anna Miller in Rome", ("Anna", "Miller", "pat6")),
    ("Established in 1845 by Anna Miller.", None),
    ("established in 1995 by Anna Miller.", ("Anna", "Miller", "pat6")),
    ("Founded by Dutch designer Zelda Claes of", ("Zelda", "Claes", "pat6")),
    ("Handmade by Anna & Peter Hall.", ("Anna", "Hall", "pat8_cofounder")),
    ("Designed by Anna and Peter, always", ("Anna", "Peter", "pat8_cofounder")),
    ("with love, John, Mary & Grace Hollow", ("John", "Hollow", "pat17_family")),
    ("Owner: Shop Team", None),
    ("Handmade by hand in small lots", None),
    ("Geschäftsführer: Anna Miller", ("Anna", "Miller", "pat1")),
    ("Grundlægger: Søren Mikkelsen", ("Søren", "Mikkelsen", "pat19")),
    ("Handmade by Andrea & Anna.", ("Andrea", "Anna", "pat8")),  # "and" splits names too
    ("Handmade by Anna & Andrea.", ("Anna", "Andrea", "pat8")),
    ("nothing here", None)])
def test_person_mentions(spark, text, want):
    df = spark.createDataFrame([(1, text, "", "")], "id INT, t STRING, b STRING, d STRING")
    got = rows(extract.person_mentions(df, "t", "b", "d", ["id"], NAMES, STOP))
    assert got == ([(1, *want)] if want else [])


def test_strict_case_keeps_capitals(spark):
    df = spark.createDataFrame([(1, "founded by zelda claes", "", "")],
                               "id INT, t STRING, b STRING, d STRING")
    loose = extract.person_mentions(df, "t", "b", "d", ["id"], NAMES, STOP)
    strict = extract.person_mentions(df, "t", "b", "d", ["id"], NAMES, STOP, flags="")
    assert len(rows(loose)) == 1 and rows(strict) == []


def test_page_person_phrases(spark):
    df = spark.createDataFrame([(1, "Founded by our team here. Anna Mae Miller, Founder")],
                               "id INT, t STRING")
    assert rows(extract.page_person(df, "t", ["id"])) == [(1, "Anna", "Mae miller")]


def test_records(spark):
    feed = "<author> <email>anna@x.test</email></author><dc:creator>Anna Miller</dc:creator>"
    got = one(spark, extract.feed_author(F.lit(feed)))
    assert tuple(got) == ("anna@x.test", "Anna", "Miller")
    got = one(spark, extract.api_author(F.lit('[{"name":"Anna","slug":"anna-miller"}]')))
    assert tuple(got) == ("Anna", "Miller", "author_api_slug")
    assert one(spark, extract.api_author(F.lit("[]"))) is None
    text = "Registrant Name: Privacy Service\r\nAdmin Contact: Anna Miller\r\n"
    assert one(spark, extract.registration_text_person(F.lit(text))) == "Anna Miller"
    body = ('{"entities":[{"roles":["registrant"],"vcardArray":["vcard",[["fn",{},"text",'
            '"Anna Miller"]]]}]}')
    assert one(spark, extract.registration_json_person(F.lit(body))) == "Anna Miller"
    assert one(spark, extract.registration_json_person(F.lit("{}"))) is None
    page = F.lit("Company Number: 01234567 registered abroad")
    assert one(spark, extract.company_number(page, F.lit("x.test"))) is None
    assert one(spark, extract.company_number(page, F.lit("x.co.uk"))) == "01234567"
    bio = '{"biography":"Founder: Anna\\u0026 Co\\n x"}'
    assert one(spark, extract.bio_text(F.lit(bio))) == "Founder: Anna& Co  x"
    assert one(spark, snippet(F.lit("no hit"), F.lit("zzz"))) is None


def test_dns_json_and_snapshots(spark):
    df = spark.createDataFrame(
        [(1, '{"Answer":[{"data":"20 mx2.x.test."},{"data":"mx.bare.test"},{"data":""}]}'),
         (2, "{}")], "id INT, body STRING")
    assert rows(extract.dns_json(df, "body", ["id"])) == [
        (1, 20, "mx2.x.test"), (1, 10, "mx.bare.test")]
    df = spark.createDataFrame([(1, '[["timestamp","original"],["2018","u1"],["2019","u2"]]')],
                               "id INT, body STRING")
    assert rows(extract.snapshots(df, "body", ["id"], 1)) == [(1, 0, "2018", "u1")]


def test_dns_collapse(spark):
    answers = spark.createDataFrame([
        ("a.test", "MX", 20, "mx2.google.com."), ("a.test", "MX", 5, "mx1.other.test."),
        ("a.test", "TXT", None, "V=SPF1 -all"), ("a.test", "DMARC_TXT", None, "v=dmarc1; p=x"),
        ("b.test", "DMARC_TXT", None, "v=DMARC1; p=x"), ("b.test", "TXT", None, "hello")],
        "domain STRING, rtype STRING, pref INT, data STRING")
    got = {r.domain: tuple(r)[1:] for r in match.collapse_dns(answers).collect()}
    assert got["a.test"] == (True, "mx1.other.test", "Google Workspace", False, True)
    assert got["b.test"] == (False, None, "No MX", True, False)
    gated = {r.domain: r.dmarc for r in match.collapse_dns(answers, gate=True).collect()}
    assert gated["b.test"] is False
    best = {r.domain: r.provider for r in match.collapse_dns(answers, "fingerprint").collect()}
    assert best["a.test"] == "Custom SMTP"  # judged by the preferred host alone
    people_rows = spark.createDataFrame([("x@gmail.com",), ("x@a.test",), ("x@none.test",)],
                                        "email STRING")
    facts = {r.email: (r.has_mx, r.provider) for r in match.attach_dns(
        people_rows, match.collapse_dns(answers)).collect()}
    assert facts == {"x@gmail.com": (True, "Google Workspace"),
                     "x@a.test": (True, "Google Workspace"), "x@none.test": (False, "No MX")}


def card(domain, engine, rank_no, pos, url, text, brand="Bloom Goods"):
    return (domain, brand, engine, rank_no, pos, url, text)


def test_cards(spark):
    cards = spark.createDataFrame([
        card("bloomgoods.test", "yahoo", 0, 0, "https://whois.test/x", "Founded by Mary Hall"),
        card("bloomgoods.test", "yahoo", 0, 1, "https://news.test/x",
             "bloomgoods.test founded by Anna Miller"),
        card("bloomgoods.test", "ddg", 1, 0, "http://r/RU=https%3a%2f%2fnews.test%2f/RK=1",
             "Bloom Goods, founded by Anna Miller"),
        card("bloomgoods.test", "bing", 2, 0, "https://news.test",
             "something else founded by Peter Hall"),
        card("tiny.test", "yahoo", 0, 0, "https://a.test", "tiny founded by Grace Hollow", "T"),
        card("tietie.test", "yahoo", 0, 0, "http://r/RU=%zz/RK=1",
             "tietie.test founded by Mary Hall", "X"),
        card("tietie.test", "bing", 2, 0, "https://n.test",
             "tietie.test founded by Grace Hollow", "X")],
        "domain STRING, brand STRING, engine STRING, engine_rank INT, pos INT, url STRING, "
        "text STRING")
    votes = extract.card_votes(cards, NAMES, STOP)
    got = {r.domain: (r.first_name, r.votes, r.conf) for r in people.vote(votes).collect()}
    assert got == {"bloomgoods.test": ("Anna", 2, "VERIFIED"), "tietie.test": ("Mary", 1, "HIGH")}
    ranked = extract.rank_cards(cards, STOP).where("domain = 'bloomgoods.test'")
    assert sorted(rows(ranked.select("engine", "rank"))) == [("ddg", 1), ("yahoo", 1)]


def test_answer_owner(spark):
    for text, want in (("Owner: Anna Miller Hall.", ("Anna", "Hall")),
                       ("owned by anna and peter", ("Anna", "")), ("owner unknown", None)):
        got = one(spark, extract.answer_owner(F.lit(text)))
        assert (got and tuple(got)) == want


def test_company_match(spark):
    sites = spark.createDataFrame([
        ("bloomgoods.com", "Bloom Goods"), ("hollow.co.uk", "The Hollow"), ("abc.com", "Abc"),
        ("lanterns.uk", "Lanterns of Leeds")], "domain STRING, brand STRING")
    companies = spark.createDataFrame([
        ("2", "BLOOM GOODS LIMITED"), ("1", "Bloom Goods Holding"), ("3", "Hollow Tree Ltd"),
        ("4", "Abc"), ("5", "LEEDS")], "company_no STRING, name STRING")
    assert sorted(rows(match.match_company(sites, companies))) == [
        ("bloomgoods.com", "Bloom Goods", "2", "BLOOM GOODS LIMITED"),
        ("hollow.co.uk", "The Hollow", "3", "Hollow Tree Ltd"),
        ("lanterns.uk", "Lanterns of Leeds", "5", "LEEDS")]


def test_waterfall(spark):
    evidence = spark.createDataFrame([
        ("a", 1.0, 0, "MEDIUM", "Anna", "", "email"), ("a", 3.0, 0, "HIGH", "Mary", "Hall", "search"),
        ("a", 4.0, 0, "HIGH", "Peter", "Hall", "registry"),
        ("b", 2.0, 1, "MEDIUM", "Jo", "", "site"), ("b", 1.0, 0, "MEDIUM", "Ada", "", "email"),
        ("c", 0.0, 0, "HIGH", "Grace", "Hollow", "author_api")],
        "domain STRING, tier DOUBLE, pos LONG, conf STRING, first_name STRING, "
        "last_name STRING, source STRING")
    got = {r.domain: (r.first_name, r.confidence, r.source_chain)
           for r in people.waterfall(evidence).collect()}
    assert got == {"a": ("Mary", "HIGH", "email|search"), "b": ("Ada", "MEDIUM", "email|site"),
                   "c": ("Grace", "HIGH", "author_api")}


def test_known_answers(spark):
    """People of fixed inputs, exact match; empty and unknown rows stay as STANDARD."""
    inputs = spark.createDataFrame([
        ("https://www.bloom.test/", "anna.miller@bloom.test", "", "Bloom", "Anna Miller"),
        ("hollowhall.test", "info@hollowhall.test", "grace@hollowhall.test", "HH", "Grace"),
        ("gracehollow.test", "info@gracehollow.test", "", "Grace Hollow", "Grace Hollow"),
        ("registry.test", "info@registry.test", "", "Reg", "Peter Hall"),
        ("", "x@y.test", "", "Empty", ""), ("nobody.test", "info@nobody.test", "", "No", "")],
        "domain STRING, email STRING, secondary_email STRING, brand STRING, want STRING")
    found = spark.createDataFrame([("registry.test", "Peter", "Hall")],
                                  "domain STRING, first_name STRING, last_name STRING")
    out = flows.enrich_people(inputs, [people.evidence(found, 4.0, "registry", "HIGH")],
                              NAMES, STOP)
    got = out.collect()
    assert len(got) == 6
    for r in got:
        assert r.full_name == r.want
        assert (r.confidence == "STANDARD") == (r.want == "")


def test_people_from_every_kind_of_record(spark):
    """Each site is solved by one kind of record; the tiers decide where several speak."""
    sites = ["api", "feed", "schema", "about", "channel", "votes", "whois", "listed", "bio",
             "register", "profile", "nothing", "both"]
    inputs = spark.createDataFrame(
        [(f"{s}goods.test" if s != "register" else "registergoods.com", f"{s} Goods",
          f"info@{s}goods.test", "") for s in sites],
        "domain STRING, brand STRING, email STRING, secondary_email STRING")
    api = spark.createDataFrame([("apigoods.test", '[{"name":"Anna Hall"}]')],
                                "domain STRING, body STRING")
    feeds = spark.createDataFrame([("feedgoods.test", "<author>Mary Hall</author>")],
                                  "domain STRING, body STRING")
    pages = spark.createDataFrame([
        ("schemagoods.test", 0, '<script type="application/ld+json">{"@type":"Store","founder":'
         '{"name":"Grace Hall"}}</script>'),
        ("aboutgoods.test", 0, "Meet Anna, our founder"), ("aboutgoods.test", 1,
         "Founded by Peter Hall. peter.hall@aboutgoods.test"),
        ("channelgoods.test", 0, '<a href="https://youtube.com/@JohnHall">v</a>'),
        ("bothgoods.test", 1, "Founded by Peter Hall.")],
        "domain STRING, path_no INT, html STRING")
    cards = spark.createDataFrame([
        ("votesgoods.test", "yahoo", 0, 0, "https://n.test", "votesgoods.test founded by Ada Hall"),
        ("votesgoods.test", "bing", 2, 0, "https://n.test", "votesgoods.test founded by Ada Hall"),
        ("listedgoods.test", "yahoo", 0, 0, "https://www.crunchbase.com/pub/dir/x",
         "listedgoods.test founded by Mary Hall"),
        ("bothgoods.test", "yahoo", 0, 0, "https://n.test", "bothgoods.test founded by Ada Hall")],
        "domain STRING, engine STRING, engine_rank INT, pos INT, url STRING, text STRING")
    registrations = spark.createDataFrame(
        [("whoisgoods.test", "text", "Registrant Name: Grace Hall")],
        "domain STRING, kind STRING, body STRING")
    bios = spark.createDataFrame([("biogoods.test", '"biography":"Owner: Anna Hall"')],
                                 "domain STRING, html STRING")
    companies = spark.createDataFrame([("1", "Register Goods Ltd", ["HALL, John Paul"])],
                                      "company_no STRING, name STRING, officers ARRAY<STRING>")
    profiles = spark.createDataFrame([("info@profilegoods.test", "mary hall"),
                                      ("info@apigoods.test", "Other Person")],
                                     "email STRING, display_name STRING")
    out = flows.people_from_sources(
        inputs, NAMES, STOP, profiles.select(emails.email_hash("email").alias("email_hash"),
                                             "display_name"),
        author_api=api, feeds=feeds, pages=pages, cards=cards, registrations=registrations,
        bios=bios, companies=companies)
    got = {r.brand.split()[0]: (r.full_name, r.confidence, r.source_chain) for r in out.collect()}
    assert got == {
        "api": ("Anna Hall", "HIGH", "author_api"), "feed": ("Mary Hall", "HIGH", "feed_author"),
        "schema": ("Grace Hall", "HIGH", "site_schema"),
        "about": ("Peter Hall", "HIGH", "email_first_last"),
        "channel": ("John Hall", "HIGH", "site_handle"),
        "votes": ("Ada Hall", "VERIFIED", "search"),
        "whois": ("Grace Hall", "HIGH", "registration"),
        "listed": ("Mary Hall", "HIGH", "directory_cards"),
        "bio": ("Anna Hall", "HIGH", "profile_bio"),
        "register": ("John Hall", "HIGH", "company_register"),
        "profile": ("Mary Hall", "HIGH", "profile"),
        "nothing": ("", "STANDARD", "store_inbox"), "both": ("Peter Hall", "HIGH", "site_text")}
    by_site = {r.brand.split()[0]: r for r in out.collect()}
    assert by_site["about"].person_email == "peter.hall@aboutgoods.test"
    assert by_site["about"].email_pattern == "site_discovered"
    assert by_site["api"].profile_found and not by_site["bio"].profile_found


def test_confirm_candidates(spark):
    persons = spark.createDataFrame([("k", "Anna", "Miller", "x.test"),
                                     ("z", "Mary", "Hall", "y.test")],
                                    "k STRING, first_name STRING, last_name STRING, domain STRING")
    profiles = spark.createDataFrame([("anna.miller@x.test", "A. Miller"),
                                      ("anna@x.test", ""), ("anna_miller@x.test", "late")],
                                     "email STRING, display_name STRING")
    hashed = profiles.select(emails.email_hash("email").alias("email_hash"), "display_name")
    assert rows(match.confirm_candidates(persons, hashed, "k")) == [
        ("k", "anna.miller@x.test", 1, "A. Miller")]


def test_first_wins_and_defaults(spark):
    one_file = spark.createDataFrame([(1, " ANNA@x.test ", "", "Odd"), (2, "b@x.test", "Two", "")],
                                     "seq LONG, email STRING, company STRING, niche STRING")
    two_file = spark.createDataFrame([(1, "anna@x.test", "Late", "late.test"),
                                      (2, "c@y.test", None, "y.test"), (3, "", "No", "z.test")],
                                     "seq LONG, email STRING, company STRING, domain STRING")
    got = {r.email: r for r in flows.consolidate([one_file, two_file]).collect()}
    assert set(got) == {"anna@x.test", "b@x.test", "c@y.test"}
    assert got["anna@x.test"].company == "" and got["anna@x.test"].niche == rules.GENERAL
    assert got["c@y.test"].website == "https://y.test"
    assert got["c@y.test"].mx_status == "unknown" and got["c@y.test"].first_name == "C"


def test_pages_to_contacts(spark):
    pages = spark.createDataFrame([
        ("bloomjewels.co.uk", 0, '<a href="https://instagram.com/bloom">i</a> info@bloomjewels.co.uk '
         "bloomjewels.fan@gmail.com sprite@2x.png"),
        ("bloomjewels.co.uk", 1, "support@other.test nomx@dead.test"),
        ("empty.test", 0, "no address")], "domain STRING, path_no INT, html STRING")
    stores = spark.createDataFrame([("bloomjewels.co.uk", "", "Extended DTC"),
                                    ("empty.test", "E", "Jewelry")],
                                   "domain STRING, brand STRING, niche STRING")
    answers = spark.createDataFrame([
        ("bloomjewels.co.uk", "MX", 1, "mx.zoho.eu"), ("bloomjewels.co.uk", "TXT", None, "v=spf1"),
        ("other.test", "MX", 1, "mx.other.test"), ("dead.test", "TXT", None, "v=spf1")],
        "domain STRING, rtype STRING, pref INT, data STRING")
    got = {r.email: r for r in flows.pages_to_contacts(pages, stores, answers).collect()}
    assert set(got) == {"info@bloomjewels.co.uk", "bloomjewels.fan@gmail.com",
                        "support@other.test"}
    own = got["info@bloomjewels.co.uk"]
    assert (own.company, own.niche, own.country) == ("Bloomjewels", "Jewelry", "United Kingdom")
    assert (own.mx_status, own.dmarc_status, own.spf_status, own.score) == (
        "Valid (Zoho Mail)", "Not Configured", "Configured", "90%")
    assert own.secondary_email == "bloomjewels.fan@gmail.com; support@other.test; nomx@dead.test"
    assert own.instagram == "https://www.instagram.com/bloom" and own.facebook is None
    assert own.title == "Founder / Marketing Lead"
    assert got["bloomjewels.fan@gmail.com"].mx_status == "Valid (Google Workspace)"
    assert got["support@other.test"].first_name == "Support"


def test_profiles(spark):
    df = spark.createDataFrame([("anna@x.test", "Anna", 95)], "email STRING, first_name STRING, "
                               "score INT")
    for profile, header in rules.PROFILES.items():
        out = contacts.project_profile(df, profile)
        assert tuple(out.columns) == header
    master = contacts.project_profile(df, "master").first()
    assert master["Email"] == "anna@x.test" and master["Last Name"] == ""


def test_items_without_address_are_dropped(spark):
    items = spark.createDataFrame([("https://www.x.test/a", None, "Anna Mae Miller"),
                                   ("y.test", "info@y.test", None)],
                                  "website STRING, email STRING, founder_name STRING")
    assert rows(contacts.items_to_contacts(items).select("first_name", "email", "company")) == [
        ("Founder", "info@y.test", "Y")]


@pytest.mark.parametrize("text, ruleset, want", [
    ("giva hair care", "strict", "Jewelry"), ("diamond car parts", "strict", rules.GENERAL),
    ("eyewear", "strict", rules.APPAREL),  # "wear" is tried first
    ("spring goods", "strict", rules.GENERAL), ("spring goods", "strict_fallback", "Jewelry"),
    ("plain", "harvest", rules.GENERAL), ("my outlet", "ranked", rules.GENERAL),
    ("plain", "ranked", None), ("plain", "registry", None)])
def test_classify(spark, text, ruleset, want):
    assert one(spark, classify.classify(F.lit(text), ruleset)) == want


def test_classify_current_value(spark):
    text = F.lit("plain")
    assert one(spark, classify.classify(text, "strict_initial", F.lit("Odd"))) == "Odd"
    assert one(spark, classify.classify(text, "strict_fallback", F.lit("Odd"))) == rules.GENERAL
    assert one(spark, classify.classify(text, "turbo", F.lit(rules.JEWELRY))) == rules.JEWELRY


def test_readers(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('Domain,url,merchant_name,technologies\n"","https://A.test/x",Alpha,T\n'
                    "b.test,,,\nnodot,,Beta,\n")
    got = readers.read_registry(spark, [str(path)])
    assert sorted(rows(got.select("domain", "brand", "employees", "source_prio"))) == [
        ("a.test", "Alpha", "11-50", 0), ("b.test", None, "11-50", 0)]
    bad = tmp_path / "b.csv"
    bad.write_text("first_name,email\nanna,a@x.test\nshort\nfirst_name,email\n")
    assert rows(readers.drop_malformed(spark, str(bad), "first_name STRING, email STRING")) == [
        ("anna", "a@x.test")]
    ranked = tmp_path / "c.csv"
    ranked.write_text("1,A.test\n2\n3,b.test\n")
    assert rows(readers.read_ranked(spark, str(ranked))) == [(1, "a.test"), (3, "b.test")]
    lines = spark.createDataFrame([("https://www.A.test/x,1",), ("url,x.y",), ("no dot",),
                                   ("two words.test",)], "value STRING")
    assert [r[1] for r in rows(readers.lines_to_domains(lines))] == ["a.test"]
    (tmp_path / "p.json").write_text('{"worker_id": 1, "scanned": 5, "total": 9, "found": 2, '
                                     '"niches": {"Jewelry": 2}, "speed": 1.5}')
    got = readers.read_progress(spark, str(tmp_path / "p.json")).first()
    assert got.scanned == 5 and got.niches == {"Jewelry": 2}


def test_load_words_checks_size(spark):
    dim = spark.createDataFrame([(" Anna ",), ("anna",), ("Bo",), ("",)], "name STRING")
    assert load_words(dim, "name") == ("anna", "bo")
    with pytest.raises(ValueError):
        load_words(dim, "name", limit=1)


def test_retry_and_ok_pages(spark):
    visits = spark.createDataFrame([("a", "429", 1), ("b", "429", 3), ("c", None, 1)],
                                   "d STRING, http_status STRING, attempt INT")
    queued, final = audit.retry_split(visits)
    assert rows(queued) == [("a", "429", 2)] and final.count() == 2
    pages = spark.createDataFrame([(200, "x" * 300), (301, "x" * 300), (404, "x"), (200, "x")],
                                  "status INT, html STRING")
    assert audit.ok_pages(pages, 100).count() == 2
    assert audit.ok_pages(pages, 100, exact=True).count() == 1


def test_top_candidates_orders(spark):
    df = spark.createDataFrame([("d", "info@x.test", 85, 0), ("d", "a.b@x.test", 60, 1),
                                ("d", "info@x.test", 100, 2), ("d", "anna@x.test", 100, 3)],
                               "domain STRING, email STRING, score INT, pos INT")
    df = df.withColumn("is_personal", emails.is_personal("email"))
    order = lambda by: [r.email for r in rank.top_candidates(df, "domain", 3, by)
                        .orderBy("rank").collect()]
    assert order("score") == ["info@x.test", "anna@x.test", "a.b@x.test"]
    assert order("pos") == ["info@x.test", "a.b@x.test", "anna@x.test"]
    assert order("personal") == ["a.b@x.test", "anna@x.test", "info@x.test"]


def test_contacts_name_all_other_addresses_of_a_site(spark):
    markup = " ".join(f"<a href='mailto:anna{i}@craft-site.com'>x</a>" for i in range(15))
    pages = spark.createDataFrame([("craft-site.com", 0, markup)],
                                  "domain STRING, path_no INT, html STRING")
    stores = spark.createDataFrame([("craft-site.com", "Craft", "")],
                                   "domain STRING, brand STRING, niche STRING")
    answers = spark.createDataFrame([("craft-site.com", "MX", 1, "mx.zoho.eu")],
                                    "domain STRING, rtype STRING, pref INT, data STRING")
    got = flows.pages_to_contacts(pages, stores, answers).collect()
    assert len(got) == 15
    for r in got:
        assert set(r.secondary_email.split("; ")) == {
            f"anna{i}@craft-site.com" for i in range(15)} - {r.email}
    few = flows.pages_to_contacts(pages, stores, answers, secondary=3).collect()
    assert {len(r.secondary_email.split("; ")) for r in few} == {3}


def test_profiles_are_looked_up_by_variant(spark):
    inputs = spark.createDataFrame(
        [("craft-site.com", "", "hello@craft-site.com", ""),
         ("other-site.com", "", "hello@other-site.com", "")],
        "domain STRING, brand STRING, email STRING, secondary_email STRING")
    known = spark.createDataFrame([("info@craft-site.com", "maria garcia"),
                                   ("x@other-site.com", "peter weber")], "e STRING, n STRING")
    profiles = known.select(emails.email_hash("e").alias("email_hash"),
                            known.n.alias("display_name"))
    got = {r.domain: r for r in flows.people_from_sources(
        inputs, ("maria", "peter"), (), profiles).collect()}
    one = got["craft-site.com"]
    assert (one.first_name, one.last_name, one.confidence, one.person_email,
            one.email_pattern) == ("Maria", "Garcia", "HIGH", "info@craft-site.com",
                                   "profile_validated")
    assert got["other-site.com"].first_name == ""
