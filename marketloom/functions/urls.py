"""Addresses of pages as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query fields that only track the reader.
TRACKING_KEYS = ("source", "ref", "fbclid", "gclid", "mc_cid", "mc_eid", "yptr")
TRACKING_PREFIX = "utm_"


def domain_of(url: Column) -> Column:
    """Authority in lower case without a leading `www.`; empty where the address has none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.lower(authority), r"^www\.", "")


def canonical_url(url: Column) -> Column:
    """Scheme and authority in lower case, no fragment, no closing slashes, no blank or tracking query fields."""
    head, rest = F.regexp_extract(url, r"^([^?#]*)", 1), F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    origin = F.regexp_extract(head, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*)", 1)
    path = F.regexp_replace(F.substr(head, F.length(origin) + 1, F.length(head)), "/+$", "")
    name = lambda f: F.lower(F.split_part(f, F.lit("="), F.lit(1)))
    fields = F.filter(F.split(rest, "&"), lambda f: f.rlike(r"^[^=]+=.") & ~name(f).startswith(TRACKING_PREFIX) & ~name(f).isin(*TRACKING_KEYS))
    query = F.array_join(fields, "&")
    return F.concat(F.lower(origin), F.when(path == "", "/").otherwise(path), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
