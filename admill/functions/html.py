"""Columns over page sources: visible text, hashes, detectors, structured data, offers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from admill.functions.text import text_or_empty

# Signatures of page builders and subscription apps, in the order they are tried; then phrases, rates and
# quantities of offers (digits are ASCII here, since numbers are cast from them).
BUILDERS = {
    "pagefly": r"(?i)pf-container|pagefly-container|cdn\.pagefly\.io",
    "zipify": r"(?i)zp-container|zipify-pages|cdn\.zipify\.com",
    "gempages": r"(?i)gf_style|gempages-container",
    "reconvert": r"(?i)reconvert-content|reconvert_funnel",
}
SUBSCRIPTION_APPS = {
    "recharge": r"(?i)recharge|RechargeStorefrontConfig",
    "bold_subscriptions": r"(?i)bold[-_]?subscription|BOLD\.",
    "skio": r"(?i)skio|Skio\.",
    "awtomic": r"(?i)awtomic|Awtomic\.",
    "loop_subscriptions": r"(?i)loop[-_]?subscription",
    "appstle": r"(?i)appstle",
}
ONE_TIME = r"(?i)one[- ]time purchase|single purchase|buy once|no subscription"
REQUIRED = r"(?i)subscription only|members?[- ]only|auto-renew(?:ing)? only|subscription required"
SUBSCRIBES = r"(?i)subscribe\s*&?\s*save|subscription|deliver every|manage subscription|cancel anytime"
RATE = r"(?i)\$\s?([0-9][0-9,]*\.?[0-9]{0,2})\s*(?:/|per\s+)\s*(day|month|mo\b)"
QUANTITY = r"(?i)([0-9]+)\s*(?:bottles|bottle|packs|pack|units|unit|items|item|boxes|box|months|month|supply)"
PRICED = r"([$€£])\s?([0-9][0-9,]*\.?[0-9]{0,2})"
BEST_VALUE = r"(?i)best\s*value|most\s*popular|best\s*seller"
_BLOCKS = r"(?is)<(script|style|svg|noscript|iframe)\b[^>]*>.*?</\1\s*>"


def visible_text(html: Column, most: int | None = None) -> Column:
    """Text outside tags and non-content blocks, white space collapsed."""
    plain = F.regexp_replace(F.regexp_replace(text_or_empty(html), _BLOCKS, " "), "(?s)<[^>]+>", " ")
    out = F.trim(F.regexp_replace(plain, r"[\s]+", " "))
    return F.substring(out, 1, most) if most else out


def content_hash(html: Column) -> Column:
    """SHA-256 of the visible text without long hexadecimal tokens and time stamps."""
    text = F.regexp_replace(visible_text(html), r"(?i)\b[0-9a-f]{16,}\b", "")
    text = F.regexp_replace(text, r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?Z?\b", "")
    return F.sha2(F.trim(F.regexp_replace(text, r"[\s]+", " ")), 256)


def detect(html: Column, signatures: dict[str, str]) -> Column:
    out = None
    for name, pattern in signatures.items():
        hit = text_or_empty(html).rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def builder(html: Column) -> Column:
    return detect(html, BUILDERS)


def subscription_app(html: Column) -> Column:
    return detect(html, SUBSCRIPTION_APPS)


def subscription_status(html: Column, text: Column) -> Column:
    t = text_or_empty(text)
    signal = subscription_app(html).isNotNull() | t.rlike(SUBSCRIBES)
    return F.when(~signal, "unknown").when(t.rlike(REQUIRED) & ~t.rlike(ONE_TIME), "subscription_required").otherwise("subscription_optional")


def subscription_price(text: Column) -> Column:
    """The first monthly price of a text, else thirty times the first daily one."""
    t = text_or_empty(text)
    amounts = F.regexp_extract_all(t, F.lit(RATE), F.lit(1))
    units = F.regexp_extract_all(t, F.lit(RATE), F.lit(2))
    pairs = F.zip_with(amounts, units, lambda a, u: F.struct(F.translate(a, ",", "").try_cast("double").alias("x"), (F.lower(u) == "day").alias("daily")))
    first = lambda daily: F.get(F.filter(pairs, lambda p: p["daily"] == daily), F.lit(0))["x"]
    return F.coalesce(first(False), first(True) * 30)


def offer(card: Column) -> Column:
    """(tier_label, quantity, total_price, price_per_unit, currency, is_best_value) of a card's text; null if it isn't one."""
    t = text_or_empty(card)
    quantity = F.regexp_extract(t, QUANTITY, 1).try_cast("int")
    price = F.translate(F.regexp_extract(t, PRICED, 2), ",", "").try_cast("double")
    symbol = F.regexp_extract(t, PRICED, 1)
    currency = F.when(symbol == "€", "EUR").when(symbol == "£", "GBP").otherwise("USD")
    value = F.struct(
        F.trim(F.regexp_extract(t, QUANTITY, 0)).alias("tier_label"),
        quantity.alias("quantity"),
        price.alias("total_price"),
        F.when(quantity > 0, F.try_divide(price, quantity)).alias("price_per_unit"),
        currency.alias("currency"),
        t.rlike(BEST_VALUE).alias("is_best_value"),
    )
    return F.when(quantity.isNotNull() & price.isNotNull(), value)


def review_count(text: Column) -> Column:
    return F.translate(F.regexp_extract(text_or_empty(text), r"(?i)([0-9,]+)\s*reviews?", 1), ",", "").try_cast("long")


def star_rating(text: Column) -> Column:
    value = F.regexp_extract(text_or_empty(text), r"(?i)([0-9](?:\.[0-9])?)\s*(?:stars?|out of 5|/\s*5)", 1).try_cast("double")
    return F.when(value.between(0, 5), value)


def json_ld(html: Column) -> Column:
    """The first JSON-LD block that parses, as a variant; its first @graph entry where it has one."""
    blocks = F.regexp_extract_all(text_or_empty(html), F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    parsed = F.get(F.filter(F.transform(blocks, lambda b: F.try_parse_json(F.trim(b))), lambda v: v.isNotNull()), F.lit(0))
    return F.coalesce(F.try_variant_get(parsed, "$['@graph'][0]", "variant"), parsed)


def product_of(json: Column) -> Column:
    """(name, brand, price, currency, rating, rating_count) of a JSON-LD product; null for other types; zeros are missing."""
    get = lambda path, kind: F.try_variant_get(json, path, kind)
    price = F.coalesce(get("$.offers.price", "double"), get("$.offers[0].price", "double"), get("$.offers.lowPrice", "double"))
    value = F.struct(
        get("$.name", "string").alias("name"),
        F.coalesce(get("$.brand.name", "string"), get("$.brand", "string")).alias("brand"),
        F.nullif(price, F.lit(0.0)).alias("price"),
        F.coalesce(get("$.offers.priceCurrency", "string"), get("$.offers[0].priceCurrency", "string")).alias("currency"),
        F.nullif(get("$.aggregateRating.ratingValue", "double"), F.lit(0.0)).alias("rating"),
        F.nullif(F.coalesce(get("$.aggregateRating.reviewCount", "long"), get("$.aggregateRating.ratingCount", "long")), F.lit(0).cast("long")).alias("rating_count"),
    )
    return F.when(get("$['@type']", "string") == "Product", value)


def open_graph(html: Column, name: str) -> Column:
    """Content of an og: meta tag."""
    pattern = rf"""(?is)<meta[^>]*property=["']og:{name}["'][^>]*content=["']([^"']*)["']"""
    return F.nullif(F.regexp_extract(text_or_empty(html), pattern, 1), F.lit(""))


# Scripts that hold a shop's name or its product.
SHOP_NAME = r'"shop"\s*:\s*\{\s*"name"\s*:\s*"([^"]+)"'
MERCHANT_NAME = r'"merchantName"\s*:\s*"([^"]+)"'
WINDOW_OBJECTS = [r"(?s)window\.ShopifyAnalytics\.meta\.product\s*=\s*(\{.*?\});", r"(?s)window\.__INITIAL_STATE__\s*=\s*(\{.*?\});"]


def description(html_or_text: Column, most: int = 3000) -> Column:
    """Text of a description: the text values of rich-text JSON where it holds one, else the visible text; at most `most` characters."""
    raw = F.trim(text_or_empty(html_or_text))
    rich = F.startswith(raw, F.lit('{"type"')) & F.try_parse_json(raw).isNotNull()
    values = F.transform(F.regexp_extract_all(raw, F.lit(r'"value"\s*:\s*"((?:[^"\\]|\\.)*)"'), F.lit(1)), lambda v: F.try_variant_get(F.try_parse_json(F.concat(F.lit('"'), v, F.lit('"'))), "$", "string"))
    told = F.trim(F.array_join(F.filter(values, lambda v: v != ""), " "))
    return F.when(rich & (told != ""), F.substring(told, 1, most)).otherwise(visible_text(html_or_text, most))


def title(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(text_or_empty(html), r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))


def product_name(title: Column, most: int = 50) -> Column:
    """Product name of a page title: what stands before its last separator, cut at the first one inside; null without one or where too long."""
    separator = r"\s+[\u2013|]\s+"
    parts = F.split(F.trim(text_or_empty(title)), separator)
    name = F.trim(F.get(parts, F.lit(0)))
    return F.when((F.size(parts) > 1) & (name != "") & (F.length(name) <= most), name)


def window_product(html: Column) -> Column:
    """Struct of brand, price and variants from script objects; prices over 1000 are cents."""
    from admill.functions.money import clean_price

    h = text_or_empty(html)
    brand = F.coalesce(*[F.nullif(F.trim(F.regexp_extract(h, p, 1)), F.lit("")) for p in (SHOP_NAME, MERCHANT_NAME)])
    found = [F.try_parse_json(F.nullif(F.regexp_extract(h, p, 1), F.lit(""))) for p in WINDOW_OBJECTS]
    price = F.coalesce(*[clean_price(F.try_variant_get(v, "$.price", "string")) for v in found])
    names = lambda v: F.filter(F.transform(F.try_variant_get(v, "$.variants", "array<variant>"), lambda x: F.coalesce(F.nullif(F.try_variant_get(x, "$.title", "string"), F.lit("")), F.try_variant_get(x, "$.name", "string"))), lambda n: n.isNotNull() & (n != ""))
    variants = F.coalesce(*[F.when(F.size(names(v)) > 0, names(v)) for v in found])
    return F.struct(brand.alias("brand"), F.when(price > 1000, price / 100).otherwise(price).alias("price"), variants.alias("variants"))


def has_min_fields(description: Column, variants: Column, rating: Column, count: Column) -> Column:
    """Whether a page told anything but a price."""
    told = (F.coalesce(description, F.lit("")) != "") | (F.coalesce(F.size(variants), F.lit(0)) > 0) | (F.coalesce(rating, F.lit(0.0)) != 0) | (F.coalesce(count, F.lit(0)) != 0)
    return F.coalesce(told, F.lit(False))


def image_addresses(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text_or_empty(html), F.lit(r'(?i)<img[^>]*\bsrc="([^"]+)"'), F.lit(1)))
