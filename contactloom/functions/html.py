"""Columns over raw page markup."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from contactloom import rules
from contactloom.functions.text import col, contains_any

_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                   "source", "track", "wbr"))


def hrefs(html: Column | str) -> Column:
    """Link targets of anchor tags in page order."""
    return F.transform(
        F.regexp_extract_all(col(html), F.lit(r"""(?is)<a\b[^>]*?\shref=["']([^"']*)["']"""),
                             F.lit(1)),
        lambda h: F.trim(h))


def anchors(html: Column | str) -> Column:
    """Anchors in page order as (href, text) structs; the text has no tags."""
    pattern = F.lit(r"""(?is)<a\b[^>]*?\shref=["']([^"']*)["'][^>]*>(.*?)</a\s*>""")
    found = F.arrays_zip(F.regexp_extract_all(col(html), pattern, F.lit(1)).alias("href"),
                         F.regexp_extract_all(col(html), pattern, F.lit(2)).alias("text"))
    return F.transform(found, lambda a: F.struct(
        F.trim(a["href"]).alias("href"),
        F.trim(F.regexp_replace(a["text"], "(?s)<[^>]*>", "")).alias("text")))


def title_or_default(html: Column | str, brand: Column | str) -> Column:
    """Page title, else a role line with the brand."""
    return F.coalesce(title_of(html), F.concat(F.lit("Founder / Owner @ "), col(brand)))


def title_of(html: Column | str) -> Column:
    """Page title of 4 to 80 characters; NULL otherwise."""
    hit = F.regexp_extract(col(html), r"(?i)<title[^>]*>([^<]{4,80})</title>", 1)
    return F.when(hit != "", F.trim(hit))


def platform_of(html: Column | str) -> Column:
    """Shop platform label and shop flag as a struct."""
    html = col(html)
    label = (F.when(contains_any(html, rules.SHOP_MARKERS), "Shopify")
             .when(F.contains(html, F.lit("wp-content"))
                   & F.contains(html, F.lit("woocommerce")), "WooCommerce")
             .when(F.contains(html, F.lit("bigcommerce")), "BigCommerce")
             .otherwise("Unknown"))
    return F.struct(label.alias("platform"),
                    ((label != "Unknown") | contains_any(F.lower(html), rules.SHOP_WORDS))
                    .alias("is_ecommerce"))


def pixel_of(html: Column | str) -> Column:
    """Pixel id and ad signal as a struct."""
    html = col(html)
    pixel = F.regexp_extract(html, rules.PIXEL_PATTERN, 1)
    signal = (F.when(pixel != "", rules.SIGNAL_HIGH)
              .when(contains_any(html, rules.TRACKING_MARKERS), rules.SIGNAL_MEDIUM)
              .otherwise(rules.SIGNAL_NONE))
    return F.struct(F.when(pixel != "", pixel).alias("pixel_id"), signal.alias("ad_signal"))


def decode_mail_entities(html: Column | str) -> Column:
    """Entities of @ and dot back to the characters."""
    at = F.regexp_replace(col(html), "(?i)&#(?:x40|64);", "@")
    return F.regexp_replace(at, "(?i)&#(?:x2e|46);", ".")


def decode_xor(hex_text: Column | str) -> Column:
    """Address hidden as hex bytes, each XOR-ed with the first one."""
    text = col(hex_text)

    def byte_at(i: Column) -> Column:
        return F.conv(F.substr(text, i * 2 - 1, F.lit(2)), 16, 10).cast("int")

    key = byte_at(F.lit(1))
    count = (F.length(text) / 2).cast("int")
    chars = F.transform(F.sequence(F.lit(2), count),
                        lambda i: F.char(byte_at(i).bitwiseXOR(key)))
    return F.when((count >= 2) & (F.length(text) % 2 == 0), F.array_join(chars, ""))


def visible_text(html: Column | str) -> Column:
    """Text without scripts, styles, navigation, header, footer and tags."""
    out = col(html)
    for tag in rules.CHROME_TAGS:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                          ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


class _TextParser(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in rules.CHROME_TAGS and tag not in _VOID:
            self.hidden.append(tag)

    def handle_endtag(self, tag):
        if tag in self.hidden:
            while self.hidden.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


@F.pandas_udf(StringType())
def visible_text_dom(html: pd.Series) -> pd.Series:
    """As ``visible_text`` but by a real parser, for broken or nested markup."""

    def one(page):
        if page is None:
            return None
        parser = _TextParser()
        parser.feed(page)
        parser.close()
        return " ".join(" ".join(parser.parts).split())

    return html.map(one)
