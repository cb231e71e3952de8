"""Raw scraper items to flat ads, extraction documents to flat features, page records merged."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from admill.functions.dates import days_active, iso_date


def truthy(*columns: Column) -> Column:
    """The first that is neither null nor empty, zero or false."""

    def nothing(c: Column) -> Column:
        said = c.cast("string")
        number = (F.typeof(c) != "string") & said.rlike(r"^-?0(\.0+)?(E[+-]?\d+)?$")  # a negative zero, or a decimal's
        return said.isin("", "0", "0.0", "false") | number

    return F.coalesce(*[F.when(~nothing(c), c) for c in columns])


def present(column: Column) -> Column:
    """Not null and not empty; zero and false are present."""
    return column.isNotNull() & ~column.cast("string").isin("", "[]")


def _get(path: str, kind: str = "string", raw: str = "raw") -> Column:
    return F.try_variant_get(raw, path, kind)


def _urls(group: str, *keys: str) -> Column:
    items = F.coalesce(_get(f"$.snapshot.{group}", "array<variant>"), F.array().cast("array<variant>"))
    found = F.transform(items, lambda v: F.coalesce(*[F.nullif(F.try_variant_get(v, f"$.{k}", "string"), F.lit("")) for k in keys]))
    return F.filter(found, lambda u: u.isNotNull())


def media_urls() -> tuple[Column, Column]:
    """(images, videos) of an item; an item without images shows its videos' previews."""
    images = F.concat(*[_urls(g, "original_image_url", "resized_image_url") for g in ("images", "cards")])
    videos = F.concat(*[_urls(g, "video_hd_url", "video_sd_url") for g in ("videos", "cards")])
    previews = F.concat(*[_urls(g, "video_preview_image_url") for g in ("videos", "cards")])
    return F.when(F.size(images) > 0, images).otherwise(previews), videos


def normalize_ads(items: DataFrame, as_of: str, link: str = "https://www.facebook.com/ads/library/?id=") -> DataFrame:
    """Items as variants (column raw) as ads: fallbacks in order, empty and zero values falling through."""
    ad_id = F.coalesce(truthy(_get("$.ad_archive_id"), _get("$.adArchiveID"), _get("$.id")), F.lit(""))
    start, end = (iso_date(truthy(_get(f"$.{k}_date"), _get(f"$.{k}Date"))) for k in ("start", "end"))
    images, videos = media_urls()
    platforms = F.coalesce(_get("$.publisher_platform", "array<string>"), _get("$.publisherPlatform", "array<string>"))
    one = truthy(_get("$.publisher_platform"), _get("$.publisherPlatform"))
    empty = lambda c: F.coalesce(c, F.lit(""))
    constructed = F.when(ad_id != "", F.concat(F.lit(link), ad_id))
    index = _get("$.impressions_with_index.impressions_index", "int")
    return items.select(
        ad_id.alias("ad_archive_id"),
        empty(truthy(_get("$.page_id"), _get("$.snapshot.page_id"))).alias("page_id"),
        empty(truthy(_get("$.page_name"), _get("$.snapshot.page_name"))).alias("page_name"),
        start.alias("start_date"),
        end.alias("end_date"),
        F.coalesce(_get("$.is_active", "boolean"), end.isNull()).alias("is_active"),
        days_active(start.try_cast("date"), end.try_cast("date"), F.lit(as_of).cast("date")).alias("days_active"),
        F.coalesce(_get("$.collation_count", "int"), F.lit(0)).alias("collation_count"),
        empty(F.coalesce(_get("$.snapshot.body.text"), F.when(F.schema_of_variant(F.try_variant_get("raw", "$.snapshot.body", "variant")) == "STRING", _get("$.snapshot.body")))).alias("body"),
        *[empty(_get(f"$.snapshot.{c}")).alias(c) for c in ("title", "caption", "link_url", "cta_text")],
        images.alias("image_urls"),
        videos.alias("video_urls"),
        F.coalesce(F.when(F.size(platforms) > 0, platforms), F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>")).alias("publisher_platforms"),
        empty(truthy(_get("$.ad_snapshot_url"), constructed, _get("$.url"))).alias("snapshot_url"),
        _get("$.impressions_with_index.impressions_text").alias("impressions_text"),
        F.nullif(index, F.lit(-1)).alias("impressions_index"),
    )


def flatten_extraction(docs: DataFrame) -> DataFrame:
    """Nested extraction documents as one flat row each: scalars, flags as 0 or 1, sizes of lists, the first person's traits."""
    copy = ["copy_block_count", "total_word_count", "total_char_count", "headline_word_count", "headline_char_count", "avg_words_per_block", "uppercase_ratio", "exclamation_count", "question_count", "emoji_count", "reading_grade_level", "claimed_benefits_count"]
    place = ["copy_canvas_coverage", "asset_canvas_coverage", "whitespace_ratio", "copy_vs_image_balance", "text_alignment", "headline_x_center", "headline_y_center", "headline_zone", "n_blocks_top", "n_blocks_middle", "n_blocks_bottom"]
    flag = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0))
    size = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c))
    person = F.get("human_model_analysis.details", F.lit(0))
    trait = lambda c: F.coalesce(person[c], F.lit(""))
    return docs.select(
        "ad_id",
        F.col("technical_metadata.aspect_ratio").alias("aspect_ratio"),
        *[F.col(f"copywriting_features.{c}").alias(c) for c in copy],
        *[flag(f"copywriting_features.{c}").alias(c) for c in ("cta_present", "has_price", "has_badge", "has_legal")],
        F.coalesce("marketing_psychology.hook_framework", F.lit("Unknown")).alias("hook_framework"),
        F.col("typography_hierarchy.headline_to_subtext_scale_ratio").alias("headline_to_subtext_scale_ratio"),
        *[F.col(f"placement.{c}").alias(c) for c in place],
        F.col("spatial_and_nested_objects.primary_product.visual_state").alias("product_visual_state"),
        size("spatial_and_nested_objects.secondary_props").alias("secondary_prop_count"),
        size("spatial_and_nested_objects.object_relationships").alias("object_relationship_count"),
        flag("spatial_and_nested_objects.texture_demonstration.visible").alias("texture_visible"),
        F.col("spatial_and_nested_objects.texture_demonstration.texture_type").alias("texture_type"),
        flag("human_model_analysis.human_presence").alias("human_presence"),
        F.col("human_model_analysis.model_count").alias("human_model_count"),
        trait("estimated_demographic").alias("primary_human_demographic"),
        trait("action_performed").alias("primary_human_action"),
        trait("micro_expression").alias("primary_human_expression"),
        trait("wardrobe_style").alias("primary_human_wardrobe"),
        size("marketing_psychology.authority_flags").alias("authority_flag_count"),
    )


def merge_pages(base: DataFrame, other: DataFrame, key: str, fill: list[str], either: list[str]) -> DataFrame:
    """base with empty fields filled from other, flags of either, and filled: whether anything changed."""
    b, o = base.alias("b"), other.alias("o")
    joined = b.join(o, F.col(f"b.{key}") == F.col(f"o.{key}"), "left")
    kept = [c for c in base.columns if c not in (*fill, *either)]
    gains = [truthy(F.col(f"b.{c}")).isNull() & truthy(F.col(f"o.{c}")).isNotNull() for c in fill]
    return joined.select(
        *[F.col(f"b.{c}") for c in kept],
        *[F.coalesce(truthy(F.col(f"b.{c}"), F.col(f"o.{c}")), F.col(f"b.{c}")).alias(c) for c in fill],
        *[(F.coalesce(F.col(f"b.{c}"), F.lit(False)) | F.coalesce(F.col(f"o.{c}"), F.lit(False))).alias(c) for c in either],
        reduce(lambda x, y: x | y, gains).alias("filled"),
    )
