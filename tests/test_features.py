"""Feature rows with missing parts, artifact readers, and the predicate of incomplete extractions."""

import json

import pytest
from pyspark.sql import functions as F

from admill.operators import features
from admill.sources import readers

ADS = """ad_id string, title string, body string, cta_text string, link_url string, days_active long, collation_count long, publisher_platforms array<string>, product_category string,
product_page struct<price: double, usp: string, rating: double, rating_count: long, marketing_copy: string, subscription_status: string, shows_all_variants: boolean, variants_featured: array<string>, cultural_branding: array<string>>"""


def test_rows_without_anything_get_defaults(spark):
    ads = spark.createDataFrame([("a", *[None] * 9), ("b", "Summer sale", "", " ", None, 3, 1, [], "x", (80.0, "", None, 0, "", None, True, [], ["c"]))], ADS)
    rows = {r["ad_id"]: r for r in features.feature_rows(ads).collect()}
    a, b = rows["a"], rows["b"]
    assert len(a) == len(set(a.asDict())) == 1 + 3 + 9 + 5 + 10 + 4 + 1 + len(features.CREATIVE) + 5 + 1
    assert (a["cta_type"], a["dominant_color"], a["palette_vibrancy"], a["subscription_status"], a["campaign_role_signal"], a["price_tier"]) == ("none", "unknown", 0.5, "unknown", "unknown", "unknown")
    assert (a["title_embedding"], a["publisher_count"], a["days_active"], a["has_product_page"], a["has_step2_features"], a["rating"]) == ([], 0, 0, False, False, None)
    assert (b["cta_type"], b["has_cta_text"], b["season_positioning"], b["urgency_language"], b["price_tier"], b["premium_positioning"]) == ("other", True, "summer", True, "luxury_bundle", False)
    assert (b["rating_count_log1p"], b["shows_all_variants"], b["cultural_branding_count"], b["product_description_word_count"]) == (0.0, True, 1, None)
    medians = spark.createDataFrame([("x", 53.0)], "category string, price_median double")
    creative = spark.createDataFrame([("b", 4, ["#00ff00"], "zone")], "ad_id string, emoji_count int, dominant_hex_palette array<string>, headline_zone string")
    b = features.feature_rows(ads, creative, medians).filter("ad_id = 'b'").first()
    assert b["premium_positioning"] and b["has_step2_features"] and (b["creative_emoji_count"], b["creative_headline_zone"], b["creative_hook_framework"], b["dominant_color"]) == (4, "zone", None, "green")
    assert features.feature_rows(ads.limit(0)).count() == 0 and features.feature_rows(ads.union(ads)).count() == 4


def test_medians_of_known_prices(spark):
    ads = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 4.0), ("c", "y", None), ("d", None, 9.0)], "ad_id string, product_category string, p double").withColumn("product_page", F.struct(F.col("p").alias("price")))
    assert [tuple(r) for r in features.price_medians(ads).collect()] == [("x", 2.5)]


def test_incomplete_extractions(spark):
    kind = "s struct<primary_product: struct<name: string>, secondary_props: array<string>, object_relationships: array<string>, texture_demonstration: struct<visible: boolean>>"
    rows = [(None,), ((None, None, None, None),), ((("",), [], [], (False,)),), ((("Jar",), [], [], (False,)),), ((("",), ["cup"], [], (None,)),), ((None, None, ["on"], None),), ((None, None, None, (True,)),)]
    out = spark.createDataFrame([r for r in rows], kind).coalesce(1).select(features.cognitive_incomplete(F.col("s")).alias("x")).collect()
    assert [r["x"] for r in out] == [True, True, True, False, False, False, False]


def test_artifact_readers(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    told = {"ad_id": "1", "typography_hierarchy": {"primary_headline": {"text": "Rest"}, "secondary_copy": [{"text": "now"}, {}]}, "human_model_analysis": {"human_presence": True, "model_count": 2}}
    for name, text in {"a.json": json.dumps({"ad_id": "1"}), "b.json": json.dumps(told), "c.json": json.dumps({"ad_id": ""}), "d.json": json.dumps({"ad_id": "2", "marketing_psychology": {"hook_framework": "PAS"}})}.items():
        (docs / name).write_text(text)
    tidy = str(docs / "*.json")
    ads, found, matrix = readers.local_artifacts(spark, str(docs / "a.json"), tidy, "ad_id string", "ad_id string")
    assert (ads.count(), found.count(), matrix.count()) == (1, 4, 0)
    (tmp_path / "matrix.json").write_text(json.dumps([{"ad_id": 7, "x": 1}, {"ad_id": 8, "x": 2}, {"ad_id": 7, "x": 3}]))
    matrix = readers.local_artifacts(spark, tidy, tidy, "ad_id string", "ad_id string", str(tmp_path / "matrix.json"), "ad_id string, x int")[2]
    assert sorted(map(tuple, matrix.collect())) == [("7", 3), ("8", 2)]
    (docs / "e.json").write_text("{broken")
    got = {r["ad_id"]: tuple(r)[1:] for r in readers.predictions(spark, tidy).collect()}
    assert got == {"1": ("Rest", ["now", ""], "Unknown", True, 2), "2": ("", [], "PAS", False, 0)}
    with pytest.raises(Exception):
        readers.local_artifacts(spark, tidy, tidy, "ad_id string", "ad_id string")[1].collect()
    (tmp_path / "golden.json").write_text(json.dumps([{"ad_id": "1", "expected_human_presence": None, "more": 1}, {"ad_id": "2", "expected_human_presence": False}]))
    gold = readers.golden_set(spark, str(tmp_path / "golden.json"), "expected_human_presence boolean")
    assert sorted((r["ad_id"], r["expected_human_presence"]) for r in gold.collect()) == [("1", None), ("2", False)]
