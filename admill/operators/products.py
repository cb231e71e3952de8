"""Product pages: features, storefront documents, guarded updates, provenance checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from admill.functions import money
from admill.functions.html import visible_text


def words_or_null(text: Column) -> Column:
    plain = F.trim(F.coalesce(text, F.lit("")))
    return F.when(plain != "", F.size(F.split(plain, r"\s+")))


def product_features(pages: DataFrame, page: str = "product_page") -> dict[str, Column]:
    """Features of a product-page struct; without a page, ratings are null and counts zero."""
    p = F.col(page)
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    size = lambda c: F.when(c.isNull(), 0).otherwise(F.size(c))
    return {
        "rating": p["rating"],
        "rating_count_log1p": money.log_count(p["rating_count"]),
        "has_rating": p["rating"].isNotNull(),
        "has_product_description": filled(p["marketing_copy"]) | filled(p["usp"]),
        "product_description_word_count": words_or_null(p["marketing_copy"]),
        "product_usp_word_count": words_or_null(p["usp"]),
        "subscription_status": F.coalesce(F.nullif(p["subscription_status"], F.lit("")), F.lit("unknown")),
        "shows_all_variants": F.coalesce(p["shows_all_variants"], F.lit(False)),
        "variants_featured_count": size(p["variants_featured"]),
        "cultural_branding_count": size(p["cultural_branding"]),
    }


def storefront_product(document: Column) -> Column:
    """(name, brand, price, price_range, variants, tags, description) of a storefront's product JSON (a variant)."""
    get = lambda path, kind: F.try_variant_get(document, path, kind)
    variants = F.coalesce(get("$.product.variants", "array<struct<title: string, price: string>>"), F.array().cast("array<struct<title: string, price: string>>"))
    prices = F.filter(F.transform(variants, lambda v: v["price"].try_cast("double")), lambda x: x.isNotNull())
    low, high = F.array_min(prices), F.array_max(prices)
    span = F.when(low < high, F.format_string("%.2f-%.2f", low, high))
    titles = F.filter(F.transform(variants, lambda v: v["title"]), lambda t: t != "Default Title")
    tags = F.filter(F.transform(F.split(F.coalesce(get("$.product.tags", "string"), F.lit("")), ","), lambda t: F.trim(t)), lambda t: t != "")
    value = F.struct(
        get("$.product.title", "string").alias("name"), get("$.product.vendor", "string").alias("brand"), low.alias("price"), span.alias("price_range"),
        titles.alias("variants"), tags.alias("tags"), visible_text(get("$.product.body_html", "string"), 1000).alias("description"),
    )
    return F.when(get("$.product.title", "string").isNotNull(), value)


def fan_out(rows: DataFrame, url: str, enrich) -> DataFrame:
    """rows with what enrich adds, computed once for each distinct URL; enrich maps a one-column DataFrame."""
    distinct = rows.filter(F.col(url).isNotNull()).select(url).distinct()
    return rows.join(enrich(distinct), url, "left")


def provenance_reasons(rows: DataFrame, required: list[str], hashes: list[str], source: str = "provenance") -> DataFrame:
    """rows with reasons: what is missing, blank or malformed in the provenance struct; none means it may be used."""
    p = F.col(source)
    missing = [F.when(p[c].isNull(), f"missing_{c}") for c in required]
    blank = [F.when(p[c] == "", f"blank_{c}") for c in required]
    malformed = [F.when((p[c] != "") & (F.length(p[c]) != 64), f"invalid_{c}") for c in hashes]
    return rows.withColumn("reasons", F.filter(F.array(*missing, *blank, *malformed), lambda r: r.isNotNull()))


def mature(rows: DataFrame, start: str, stopped: str, as_of: Column, least: int = 30) -> DataFrame:
    """Rows whose outcome is known: stopped, or at least that many days old."""
    return rows.filter(F.col(stopped) | (F.datediff(as_of, F.col(start)) >= least))
