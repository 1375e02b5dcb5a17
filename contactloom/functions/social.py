"""Social profile links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions.text import col, contains_any


def canonical_social(href: Column | str, platform: str) -> Column:
    """Profile URL of one platform, NULL for share links, reserved paths and others."""
    raw = col(href)
    link = F.regexp_replace(F.split_part(F.trim(raw), F.lit("?"), F.lit(1)), "/+$", "")
    if platform == "linkedin":
        target = F.when(F.contains(link, F.lit("linkedin.com/company/")), link)
    elif platform == "twitter":
        bare = link
        for token in ("https://", "http://", "www."):
            bare = F.replace(bare, F.lit(token), F.lit(""))
        handle = F.get(F.split(bare, "/"), F.lit(1))
        target = F.when(link.rlike(r"twitter\.com/|x\.com/"), handle)
    else:
        mark = {"instagram": "instagram.com/", "facebook": "facebook.com/",
                "tiktok": "tiktok.com/@"}[platform]
        tail = F.get(F.split(link, mark.replace(".", r"\."), -1), F.lit(1))
        target = F.split_part(tail, F.lit("/"), F.lit(1))
    ok = ~contains_any(F.lower(raw), rules.SHARE_MARKERS) & (target != "")
    if platform == "linkedin":
        return F.when(ok, target)
    ok = ok & ~contains_any(F.lower(target), rules.RESERVED_HANDLES[platform])
    return F.when(ok, F.concat(F.lit(rules.PROFILE_PREFIX[platform]), target))


def harvest_social(html: Column | str, platform: str) -> Column:
    """First profile URL anywhere in the markup; a reserved first handle gives NULL."""
    handle = F.regexp_extract(col(html), rules.HARVEST_SOCIAL_PATTERNS[platform], 1)
    ok = (handle != "") & ~F.lower(handle).isin(*rules.HARVEST_RESERVED)
    return F.when(ok, F.concat(F.lit(rules.PROFILE_PREFIX[platform]), handle))
