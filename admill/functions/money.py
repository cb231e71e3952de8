"""Columns over prices, ratings and counts found in text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Price tiers by upper bound, and marketplaces by host.
TIERS = [(15.0, "budget"), (35.0, "mid"), (60.0, "premium")]
TOP_TIER = "luxury_bundle"
MARKETPLACES = {
    "amazon.com": ("us", "USD"), "amazon.co.uk": ("gb", "GBP"), "amazon.de": ("de", "EUR"), "amazon.fr": ("fr", "EUR"),
    "amazon.it": ("it", "EUR"), "amazon.es": ("es", "EUR"), "amazon.nl": ("nl", "EUR"), "amazon.se": ("se", "SEK"),
    "amazon.pl": ("pl", "PLN"), "amazon.ca": ("ca", "CAD"), "amazon.com.mx": ("mx", "MXN"), "amazon.com.br": ("br", "BRL"),
    "amazon.co.jp": ("jp", "JPY"), "amazon.in": ("in", "INR"), "amazon.com.au": ("au", "AUD"), "amazon.sg": ("sg", "SGD"),
    "amazon.ae": ("ae", "AED"), "amazon.sa": ("sa", "SAR"), "amazon.eg": ("eg", "EGP"), "amazon.com.tr": ("tr", "TRY"),
}


def price_tier(price: Column) -> Column:
    out = F.when(price.isNull(), "unknown")
    for bound, name in TIERS:
        out = out.when(price < bound, name)
    return out.otherwise(TOP_TIER)


def clean_price(raw: Column) -> Column:
    """The last number of a text, once all but digits, points, signs and white space are removed; null if there is none."""
    plain = F.regexp_replace(F.coalesce(raw, F.lit("")), r"[^0-9.\-\s]", "")
    numbers = F.regexp_extract_all(plain, F.lit(r"-?[0-9]+(?:\.[0-9]+)?"), F.lit(0))
    return F.try_element_at(numbers, F.lit(-1)).try_cast("double")


def clean_count(raw: Column) -> Column:
    """The first run of digits and commas as a whole number."""
    return F.translate(F.regexp_extract(F.coalesce(raw, F.lit("")), "[0-9][0-9,]*", 0), ",", "").try_cast("long")


def log_count(n: Column) -> Column:
    return F.log1p(n.cast("double"))


def accepted_price(price: Column) -> Column:
    """Prices outside 2 to 1500 are taken for errors."""
    return F.when(price.between(2, 1500), price)


def accepted_rating(rating: Column) -> Column:
    return F.when((rating > 0) & (rating <= 5), rating)


def marketplace(host: Column) -> Column:
    """(region, currency) of a marketplace host, null for any other host; the suffixes exclude one another."""
    low = F.lower(host)
    out = None
    for suffix, (region, currency) in MARKETPLACES.items():
        hit = (low == suffix) | F.endswith(low, F.lit(f".{suffix}"))
        value = F.struct(F.lit(region).alias("region"), F.lit(currency).alias("currency"))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def monthly_cost(total_bytes: Column, usd_per_gib: float = 0.02) -> Column:
    return total_bytes / float(1 << 30) * usd_per_gib
