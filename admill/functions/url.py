"""Columns over URLs: canonical form, campaign parameters, paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Parameters that don't change the page, and campaign vocabularies.
TRACKING = ["fbclid", "gclid", "ttclid", "ad_id", "adset_id", "campaign_id", "placement", "site_source_name", "variant", "_ke", "_pos", "_ss", "preview_theme_id", "affiliate_id", "ref"]
GRANULARITY = ["hook", "cta", "ugc", "static", "video", "testimonial", "flavor", "size", "angle", "format"]
TEST_SIGNALS = ["test", "v1", "v2", "v3", "variant", "alt", "exp", "experiment"]
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def part(url: Column, group: int) -> Column:
    """1 scheme, 2 host, 3 path, 4 query; empty where absent."""
    return F.regexp_extract(url, _PARTS, group)


def host(url: Column) -> Column:
    return F.lower(part(url, 2))


def params(url: Column) -> Column:
    """Array of decoded (key, value) pairs in order; a key alone has an empty value."""
    pieces = F.filter(F.split(part(url, 4), "&"), lambda p: p != "")
    decode = lambda x: F.coalesce(F.try_url_decode(x), x)
    pair = lambda p: F.struct(decode(F.substring_index(p, "=", 1)).alias("k"), decode(F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, "^[^=]*=", "")).otherwise("")).alias("v"))
    return F.transform(pieces, pair)


def is_tracking(key: Column) -> Column:
    low = F.lower(key)
    return low.isin(TRACKING) | F.startswith(low, F.lit("utm_"))


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, tracking parameters dropped, others sorted, no trailing slash, no fragment."""
    kept = F.array_sort(F.filter(params(url), lambda p: ~is_tracking(p["k"])))
    query = F.array_join(F.transform(kept, lambda p: F.concat(F.url_encode(p["k"]), F.lit("="), F.url_encode(p["v"]))), "&")
    path = F.regexp_replace(part(url, 3), "/+$", "")
    return F.concat(
        F.when(part(url, 1) != "", F.concat(F.lower(part(url, 1)), F.lit(":"))).otherwise(""),
        F.when(host(url) != "", F.concat(F.lit("//"), host(url))).otherwise(""),
        F.when(path == "", "/").otherwise(path),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )


def utm(url: Column, name: str) -> Column:
    """First non-empty value of utm_<name>, any case of the key; null if there is none."""
    hit = F.filter(params(url), lambda p: (F.lower(p["k"]) == f"utm_{name}") & (p["v"] != ""))
    return F.get(hit, F.lit(0))["v"]


def campaign_features(url: Column) -> dict[str, Column]:
    empty = lambda x: F.coalesce(x, F.lit(""))
    campaign, content, medium = (empty(utm(url, n)) for n in ("campaign", "content", "medium"))
    known = F.exists(params(url), lambda p: F.startswith(F.lower(p["k"]), F.lit("utm_")) & (p["v"] != ""))
    dynamic = F.concat_ws(" ", campaign, content, empty(utm(url, "term"))).rlike(r"(?i)\{\{[a-z_.]+\}\}")
    count = sum(F.contains(F.lower(content), F.lit(k)).cast("int") for k in GRANULARITY)
    test = F.exists(F.array(*map(F.lit, TEST_SIGNALS)), lambda k: F.contains(F.lower(campaign), k) | F.contains(F.lower(content), k))
    role = F.when(~known, "unknown").when(dynamic | (count >= 2) | test, "likely_test").when(campaign != "", "likely_scale").otherwise("unknown")
    kind = F.when(medium.rlike("(?i)paid[-_ ]?social|paidsocial"), "dedicated_paid_social").when(F.trim(medium).rlike("(?i)^(cpc|social|ppc)$"), "legacy_generic").otherwise("unknown")
    return {"has_utm_tracking": known, "utm_medium_category": kind, "utm_dynamic_naming": dynamic, "utm_content_granularity_score": count, "campaign_role_signal": role}


def has_product_path(url: Column) -> Column:
    return part(url, 3).rlike("/products?/[^/]+")


def product_json(url: Column) -> Column:
    """Address of a storefront product's JSON document."""
    return F.concat(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", ""), F.lit(".json"))


def expired(url: Column, now_epoch: Column) -> Column:
    """True if the hexadecimal oe parameter lies before now; a URL without one doesn't expire."""
    stamp = F.conv(F.nullif(F.regexp_extract(url, r"[?&]oe=([0-9A-Fa-f]+)", 1), F.lit("")), 16, 10).try_cast("long")
    return F.coalesce(stamp < now_epoch, F.lit(False))
