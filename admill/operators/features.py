"""The whole model row of an ad: copy, call to action, positioning, colours, product page, account, creative and campaign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from admill.functions import color, money, text, url
from admill.operators.ordering import grouped_quantiles
from admill.operators.products import product_features

# Features of a creative's extraction, in the order of the row; each is prefixed with creative_.
CREATIVE = [
    "copy_block_count", "total_word_count", "total_char_count", "headline_word_count", "headline_char_count", "avg_words_per_block", "uppercase_ratio",
    "exclamation_count", "question_count", "emoji_count", "reading_grade_level", "hook_framework", "cta_present", "claimed_benefits_count", "has_price",
    "has_badge", "has_legal", "headline_to_subtext_scale_ratio", "copy_canvas_coverage", "asset_canvas_coverage", "whitespace_ratio",
    "copy_vs_image_balance", "text_alignment", "headline_x_center", "headline_y_center", "headline_zone", "n_blocks_top", "n_blocks_middle",
    "n_blocks_bottom", "product_visual_state", "secondary_prop_count", "object_relationship_count", "texture_visible", "texture_type", "human_presence",
    "human_model_count", "primary_human_demographic", "primary_human_action", "primary_human_expression", "primary_human_wardrobe", "authority_flag_count",
]
COLORS = {"dominant_hex_palette": "array<string>", "background_hex": "string", "contrast_ratio_type": "string", "background_style": "string"}
EMBEDDINGS = ["title_embedding", "body_embedding", "usp_embedding"]


def _or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def cognitive_incomplete(spatial: Column) -> Column:
    """Whether an extraction told nothing of what is seen: no product name, props, relations or texture; null tells nothing."""
    some = lambda c: c.isNotNull() & (F.size(c) > 0)
    named = F.coalesce(spatial["primary_product"]["name"], F.lit("")) != ""
    told = named | some(spatial["secondary_props"]) | some(spatial["object_relationships"]) | F.coalesce(spatial["texture_demonstration"]["visible"], F.lit(False))
    return ~F.coalesce(told, F.lit(False))


def price_medians(ads: DataFrame, category: str = "product_category") -> DataFrame:
    """(category, price_median): over the known prices of a category's product pages, by value ranges."""
    priced = ads.select(F.col(category).alias("category"), F.col("product_page")["price"].cast("double").alias("price")).filter("price IS NOT NULL AND category IS NOT NULL")
    return grouped_quantiles(priced, "category", "price", [0.5]).select("category", F.get("quantiles", F.lit(0)).alias("price_median"))


def feature_rows(ads: DataFrame, creative: DataFrame | None = None, medians: DataFrame | None = None, key: str = "ad_id", category: str = "product_category") -> DataFrame:
    """A row per ad with every feature and price_tier, which is a segment and no feature.

    ads: key, title, body, cta_text, link_url, days_active, collation_count, publisher_platforms, product_page (a struct of price, usp and what
    product_features reads), and any EMBEDDINGS. creative: a row per key at most, with any of CREATIVE and COLORS; features that it lacks are null,
    colours unknown. medians: (category, price_median), a row per category at most; without it no price makes an ad premium. Null texts count as empty,
    a null product_page as none, null platforms as none. Repeated ads give a row each.
    """
    rows = ads
    if medians is not None:
        rows = rows.join(medians.select(F.col("category").alias("_category"), "price_median"), F.col(category) == F.col("_category"), "left").drop("_category")
    found = ads.limit(0).select(F.col(key).alias("_key")) if creative is None else creative.withColumnRenamed(key, "_key")
    packed = found.select(
        F.col("_key"),
        F.struct(
            *[_or_null(found, c, "string").alias(c) for c in CREATIVE],
            *[_or_null(found, c, kind).alias(c) for c, kind in COLORS.items()],
        ).alias("_creative"),
    )
    rows = rows.join(packed, F.col(key) == F.col("_key"), "left")

    page, seen = F.col("product_page"), F.col("_creative")
    usp, price = page["usp"], page["price"].cast("double")
    said = F.concat_ws(" ", *[F.nullif(c, F.lit("")) for c in (F.col("title"), F.col("body"), usp)])
    palette = seen["dominant_hex_palette"]
    dominant = F.coalesce(F.nullif(seen["background_hex"], F.lit("")), F.get(palette, F.lit(0)))
    known = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))
    features = {
        **{c: F.coalesce(_or_null(ads, c, "array<double>"), F.array().cast("array<double>")) for c in EMBEDDINGS},
        "title_length": text.length_or_zero(F.col("title")),
        "body_length": text.length_or_zero(F.col("body")),
        "usp_length": text.length_or_zero(usp),
        "urgency_language": text.urgency(said),
        "social_proof_language": text.social_proof(said),
        "has_cta_text": text.text_or_empty(F.col("cta_text")) != "",
        "cta_type": text.cta_type(F.col("cta_text")),
        "premium_positioning": text.premium_positioning(said, price, F.col("price_median") if medians is not None else F.lit(None).cast("double")),
        "season_positioning": text.season(said),
        "dominant_color": color.bucket(dominant),
        "palette_vibrancy": color.vibrancy_or_default(palette),
        "psychological_warmth_index": color.is_warm(dominant).cast("double"),
        "contrast_ratio_type": known(seen["contrast_ratio_type"]),
        "background_style": known(seen["background_style"]),
        **product_features(rows),
        "days_active": F.coalesce("days_active", F.lit(0)),
        "collation_count": F.coalesce("collation_count", F.lit(0)),
        "has_product_page": page.isNotNull(),
        "has_step2_features": F.col("_key").isNotNull(),
        "publisher_count": F.when(F.col("publisher_platforms").isNull(), 0).otherwise(F.size("publisher_platforms")),
        **{f"creative_{c}": seen[c] for c in CREATIVE},
        **url.campaign_features(F.col("link_url")),
    }
    return rows.select(F.col(key), *[c.alias(name) for name, c in features.items()], money.price_tier(price).alias("price_tier"))
