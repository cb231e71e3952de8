"""Queries of model inputs, models, guides and product pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from admill.functions import url
from admill.operators import features, guide, modelling, products, shap, splits
from admill.operators.storage import stored
from admill.plans.registry import query
from admill.plans.views import ADS, AS_OF, ads, table


@query("""WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT o_orderkey, CASE WHEN n >= 12 THEN CAST(o_custkey AS VARCHAR) ELSE 'infrequent' END AS level FROM orders JOIN c USING (o_custkey)""")
def rare_levels(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("level"))
    return modelling.pool_rare(rows, "level", 12)


@query()
def boosted_regression(spark, sf):
    """Trees depend on the library, so rows only: test error beside the training median's."""
    rows = splits.advertiser_holdout(ads(spark, sf), "start_date", F.col("page_id").cast("string")).withColumn("target", F.col("days_active").cast("double"))
    rows = stored(modelling.pool_rare(rows, "hook", 5, ~F.col("is_test")), "model-rows")
    train, test = rows.filter("NOT is_test"), rows.filter("is_test")
    numeric, categorical = ["price", "collation_count"], ["hook", "segment"]
    model = modelling.train_boosted(train, "target", numeric, categorical, rounds=5)
    return modelling.evaluate(model, train, test, "target", numeric)


_FOLDS = 3


@query(f"""WITH {ADS}, p AS (SELECT ad_id, start_date, row_number() OVER (ORDER BY start_date, ad_id) - 1 AS place, count(*) OVER () AS n FROM ads),
f AS (SELECT *, CAST(greatest(-1, floor((place - (n - {_FOLDS} * (n // {_FOLDS + 1}))) / (n // {_FOLDS + 1}))) AS INT) AS fold FROM p)
SELECT fold, count(*) AS n, min(start_date) AS first_day, max(start_date) AS last_day, sum(ad_id) AS ids FROM f GROUP BY fold""")
def time_folds(spark, sf):
    rows = modelling.time_folds(ads(spark, sf), "start_date", "ad_id", _FOLDS)
    return rows.groupBy("fold").agg(F.count("*").alias("n"), F.min("start_date").alias("first_day"), F.max("start_date").alias("last_day"), F.sum("ad_id").alias("ids"))


def _model_rows(spark, sf):
    return ads(spark, sf).withColumn("target", F.col("days_active").cast("double"))


@query()
def boosted_search(spark, sf):
    """Errors of the whole grid's models on five expanding time folds; trees depend on the library, so rows only. The folds have an SQL twin of their own."""
    rows = stored(modelling.time_folds(_model_rows(spark, sf), "start_date", "ad_id"), "folds")
    return modelling.time_search(rows, "target", ["price", "collation_count"], ["hook", "segment"])


@query()
def shap_ranking(spark, sf):
    """Shapley values of a model fitted on older ads over the newest, with the direction that a guide reads from them; rows only, since trees depend on the library."""
    rows = stored(modelling.time_folds(_model_rows(spark, sf), "start_date", "ad_id", 1), "folds")
    numeric, categorical = ["price", "collation_count"], ["hook", "segment"]
    model = modelling.train_boosted(rows.filter("fold < 0"), "target", numeric, categorical, rounds=5)
    test = model.transform(modelling.with_indicators(rows.filter("fold = 0"), numeric))
    names = modelling.encoded_names(test, numeric, categorical)
    ranked = shap.ranking(test, model.stages[-1], names).withColumn("source", F.lit("shap:days_active"))
    buckets = spark.createDataFrame([("hook", "text"), ("segment", "audience"), ("price", "offer"), ("collation_count", "variants")], "dimension string, bucket string")
    return guide.directives(guide.parse_features(ranked, ["hook", "segment"]), buckets)


@query()
def cox_coefficients(spark, sf):
    """Newton steps over daily sums; checked in tests against a direct solution."""
    rows = ads(spark, sf).withColumn("ended", F.col("end_date").isNotNull())
    fitted = modelling.proportional_hazards(rows, "days_active", "ended", ["price", "collation_count"], rounds=6)
    return ads(spark, sf).agg(F.count("*").alias("n")).select("n", F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), F.lit(v).alias("coefficient")) for k, v in fitted.items()])).alias("c")).select("n", "c.*")


@query(f"WITH {ADS} SELECT ad_id, CAST(CASE hook WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN -1 ELSE 0 END + CASE segment WHEN 'O' THEN 1 ELSE 0 END AS BIGINT) AS alignment FROM ads")
def directive_alignment(spark, sf):
    effects = spark.createDataFrame(
        [("categorical__hook_1-URGENT", 0.4, 0.5, "shap"), ("categorical__hook_5-LOW", -0.4, 0.5, "shap"), ("categorical__hook_2-HIGH", 0.01, 0.5, "shap"), ("categorical__segment_O", 0.3, 0.3, "shap")],
        "feature string, signed double, absolute double, source string",
    )
    buckets = spark.createDataFrame([("hook", "visual"), ("segment", "visual")], "dimension string, bucket string")
    rules = guide.directives(guide.parse_features(effects, ["hook", "segment"]), buckets)
    return guide.alignment(ads(spark, sf), "ad_id", rules, ["hook", "segment"])


@query(f"WITH {ADS} SELECT ad_id, is_active, days_active FROM ads WHERE NOT is_active OR date_diff('day', start_date, DATE '{AS_OF}') >= 400")
def mature_targets(spark, sf):
    rows = ads(spark, sf).withColumn("stopped", ~F.col("is_active"))
    return products.mature(rows, "start_date", "stopped", F.lit(AS_OF).cast("date"), 400).select("ad_id", "is_active", "days_active")


@query("""SELECT page_id, lower(regexp_extract(url, '//([^/?#]*)', 1)) AS host, count(*) OVER (PARTITION BY lower(regexp_extract(url, '//([^/?#]*)', 1))) AS host_pages FROM pages""")
def url_fan_out(spark, sf):
    """Hosts are looked up once each and joined back."""
    pages = table(spark, sf, "pages").select("page_id", url.host(F.col("url")).alias("host"))
    sizes = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    return products.fan_out(pages, "host", lambda hosts: hosts.join(sizes, "host")).select("page_id", "host", "host_pages")


@query("""SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size / 10.0 END AS rating, CASE WHEN p_size > 25 THEN round(ln(1 + p_partkey), 9) END AS rating_count_log1p, p_size > 25 AS has_rating, length(trim(p_name)) > 0 AS has_product_description,
CAST(len(string_split(p_name, ' ')) AS BIGINT) AS product_description_word_count, CAST(2 AS BIGINT) AS variants_featured_count FROM part""")
def product_features(spark, sf):
    rated = F.col("p_size") > 25
    page = F.struct(
        F.when(rated, F.col("p_size") / 10.0).alias("rating"), F.when(rated, F.col("p_partkey")).alias("rating_count"), F.col("p_name").alias("marketing_copy"), F.lit("").alias("usp"), F.lit("").alias("subscription_status"),
        F.lit(None).cast("boolean").alias("shows_all_variants"), F.array("p_brand", "p_type").alias("variants_featured"), F.lit(None).cast("array<string>").alias("cultural_branding"),
    )
    rows = table(spark, sf, "part").withColumn("product_page", page)
    f = products.product_features(rows)
    f["rating_count_log1p"] = F.round(f["rating_count_log1p"], 9)
    f = {k: v.cast("long") if k.endswith("_count") else v for k, v in f.items()}
    names = ["rating", "rating_count_log1p", "has_rating", "has_product_description", "product_description_word_count", "variants_featured_count"]
    return rows.select("p_partkey", *[f[n].alias(n) for n in names])


@query(f"""WITH {ADS}, t AS (SELECT *, ad_id % 4 AS m, price > 20 AS paged, CASE WHEN segment <> 'P' THEN 'Try it' END AS body, CASE WHEN price > 20 THEN CASE WHEN segment = 'P' THEN 'Luxury ease' ELSE '' END END AS usp FROM ads),
c AS (SELECT segment, median(price) AS middle FROM t WHERE paged GROUP BY 1),
f AS (SELECT t.*, c.middle, lower(hook || coalesce(' ' || body, '') || coalesce(' ' || nullif(usp, ''), '')) AS said, CASE WHEN m = 1 THEN '#ff0000' WHEN m > 1 THEN '#102030' END AS hex FROM t LEFT JOIN c ON c.segment = t.segment)
SELECT ad_id, length(hook) AS title_length, length(coalesce(body, '')) AS body_length, length(coalesce(usp, '')) AS usp_length, contains(said, 'urgent') AS urgency_language, segment = 'F' AS has_cta_text, CASE WHEN segment = 'F' THEN 'shop_now' ELSE 'none' END AS cta_type,
contains(said, 'luxury') OR (paged AND price >= 1.5 * middle) AS premium_positioning, CASE WHEN hex IS NULL THEN 'unknown' WHEN m = 1 THEN 'red' ELSE 'blue' END AS dominant_color, CASE WHEN hex IS NULL THEN 0.5::DOUBLE ELSE round(2 / 3 / sqrt(2), 9) END AS palette_vibrancy,
CASE WHEN m = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS psychological_warmth_index, CASE WHEN m = 0 THEN 'unknown' ELSE 'High' END AS contrast_ratio_type, 'unknown' AS background_style, paged AS has_product_page, m <> 0 AS has_step2_features,
CASE WHEN usp <> '' THEN 2::BIGINT END AS product_usp_word_count, CASE WHEN ad_id % 2 = 0 THEN 2::BIGINT ELSE 0::BIGINT END AS publisher_count, CASE WHEN m <> 0 THEN collation_count END AS creative_total_word_count,
CASE WHEN ad_id % 3 = 0 THEN 'likely_test' ELSE 'unknown' END AS campaign_role_signal, CASE WHEN ad_id % 3 = 0 THEN 2::BIGINT ELSE 0::BIGINT END AS utm_content_granularity_score,
CASE WHEN NOT paged THEN 'unknown' WHEN price < 35 THEN 'mid' WHEN price < 60 THEN 'premium' ELSE 'luxury_bundle' END AS price_tier FROM f""")
def feature_rows(spark, sf):
    """Ads with pages and creatives as whole model rows; every column of them, the tests look at the rest."""
    a = ads(spark, sf)
    page = F.struct(
        "price", F.when(F.col("segment") == "P", "Luxury ease").otherwise("").alias("usp"), (F.col("price") / 20).alias("rating"), F.col("collation_count").alias("rating_count"), F.lit("two words").alias("marketing_copy"),
        F.lit("").alias("subscription_status"), F.lit(None).cast("boolean").alias("shows_all_variants"), F.array("hook").alias("variants_featured"), F.lit(None).cast("array<string>").alias("cultural_branding"),
    )
    rows = a.select(
        "ad_id", "days_active", "collation_count", F.col("hook").alias("title"), F.when(F.col("segment") != "P", "Try it").alias("body"), F.when(F.col("segment") == "F", "Shop Now").alias("cta_text"), F.col("segment").alias("product_category"),
        F.when(F.col("ad_id") % 3 == 0, "https://x.example/p?utm_content=ugc_video").otherwise("https://x.example/p").alias("link_url"), F.when(F.col("ad_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).alias("publisher_platforms"), F.when(F.col("price") > 20, page).alias("product_page"),
    )
    creative = a.filter("ad_id % 4 <> 0").select(
        "ad_id", F.col("collation_count").alias("total_word_count"), F.array(F.lit("#102030"), F.lit("#ffffff")).alias("dominant_hex_palette"), F.when(F.col("ad_id") % 4 == 1, "#ff0000").alias("background_hex"), F.lit("High").alias("contrast_ratio_type"),
    )
    out = features.feature_rows(rows, creative, features.price_medians(rows))
    longs = ["product_usp_word_count", "publisher_count", "utm_content_granularity_score"]
    names = ["ad_id", "title_length", "body_length", "usp_length", "urgency_language", "has_cta_text", "cta_type", "premium_positioning", "dominant_color", "psychological_warmth_index", "contrast_ratio_type", "background_style", "has_product_page", "has_step2_features"]
    return out.select(*names, *[F.col(c).cast("long").alias(c) for c in longs], F.round("palette_vibrancy", 9).alias("palette_vibrancy"), "creative_total_word_count", "campaign_role_signal", "price_tier")
