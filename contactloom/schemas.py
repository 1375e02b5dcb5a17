"""Column types of the tables the engine reads and writes."""

from __future__ import annotations

REGISTRY = ("domain STRING, merchant_name STRING, tags STRING, technologies STRING, "
            "employee_count_bucket STRING")
RANKED = "rank INT, domain STRING"
SLICE = "domain STRING, brand STRING, niche STRING, tech STRING, employees STRING"
SITE_PAGE = ("domain STRING, path STRING, path_no INT, status INT, html STRING, "
             "fetched_at TIMESTAMP")
DNS_ANSWER = "domain STRING, rtype STRING, pref INT, data STRING"
PROFILE = "email_hash STRING, display_name STRING"
CARD = ("domain STRING, brand STRING, engine STRING, engine_rank INT, pos INT, url STRING, "
        "text STRING")
REGISTRATION = "domain STRING, kind STRING, body STRING"
COMPANY = "company_no STRING, name STRING, officers ARRAY<STRING>"
CONTACT = ("first_name STRING, last_name STRING, email STRING, secondary_email STRING, "
           "company STRING, website STRING, title STRING, ads_url STRING, niche STRING, "
           "country STRING, instagram STRING, facebook STRING, linkedin STRING, "
           "tiktok STRING, twitter_x STRING, mx_status STRING, dmarc_status STRING, "
           "spf_status STRING, profile_found STRING, score STRING, note STRING")
PERSON_INPUT = ("domain STRING, email STRING, secondary_email STRING, store_name STRING, "
                "instagram STRING, facebook STRING")
EVIDENCE = ("domain STRING, tier DOUBLE, pos LONG, conf STRING, first_name STRING, "
            "last_name STRING, source STRING")
VISIT = "domain STRING, seq LONG, http_status STRING, html STRING, attempt INT"
PROGRESS = ("worker_id INT, scanned LONG, total LONG, found LONG, niches MAP<STRING,LONG>, "
            "speed DOUBLE")
ITEM = ("domain STRING, website STRING, email STRING, contact_email STRING, "
        "founder_name STRING, brand_name STRING, title STRING, niche STRING, country STRING")
STAMPED_CONTACT = CONTACT + ", scraped_at TIMESTAMP"
