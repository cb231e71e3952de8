"""Queries of the column packs over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from admill.functions import color, geometry, html, money, text, url
from admill.plans.registry import query
from admill.plans.views import table


def _any(column: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{t}')" for t in terms) + ")"


def _first(column: str, rules: dict[str, list[str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {_any(column, terms)} THEN '{name}'" for name, terms in rules.items()) + f" ELSE '{otherwise}' END"


_CTA = {t.replace(" ", "_"): [t] for t in text.CTA_TYPES}


@query(f"""SELECT doc_id, length(text) AS body_length, {_any('text', text.URGENCY)} AS urgency_language, {_any('text', text.SOCIAL_PROOF)} AS social_proof_language,
CASE WHEN text = '' THEN 'none' ELSE {_first('text', _CTA, 'other')} END AS cta_type, {_any('text', text.PREMIUM)} AS premium_positioning,
{_first('text', text.SEASONS, 'none')} AS season_positioning, {_first('text', text.SUBCATEGORIES, 'other supplements')} AS subcategory FROM documents""")
def text_features(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", text.length_or_zero(t).cast("long").alias("body_length"), text.urgency(t).alias("urgency_language"), text.social_proof(t).alias("social_proof_language"),
        text.cta_type(t).alias("cta_type"), text.premium_positioning(t).alias("premium_positioning"), text.season(t).alias("season_positioning"), text.subcategory(t).alias("subcategory"),
    )


@query("""WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z0-9'']+') AS w FROM documents), s AS (SELECT doc_id, len(w) AS n,
list_sum(list_transform(w, lambda x: greatest(1, len(regexp_extract_all(lower(x), '[aeiouy]+')) - CASE WHEN ends_with(lower(x), 'e') THEN 1 ELSE 0 END))) AS syl,
greatest(1, len(regexp_extract_all(text, '[.!?]+'))) AS sent FROM w)
SELECT doc_id, CAST(n AS BIGINT) AS words, round(CASE WHEN n = 0 THEN 0.0 ELSE 0.39 * (n / sent) + 11.8 * (syl / n) - 15.59 END, 6) AS grade FROM s""")
def reading_grade(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", F.size(text.words(t)).cast("long").alias("words"), F.round(text.reading_grade(t), 6).alias("grade"))


@query(f"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z0-9'']+')) AS BIGINT) AS total_word_count, length(text) AS total_char_count,
CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS exclamation_count, CAST(length(text) - length(replace(text, '?', '')) AS BIGINT) AS question_count,
{_any('text', text.CTA_PHRASES)} AS cta_present, regexp_matches(text, '(?i)terms (and|&) conditions|results may vary|individual results|fda has not evaluated|not intended to diagnose|consult (a|your) (doctor|physician)|\\*see|see store for details|while supplies last') AS has_legal FROM documents""")
def copy_signals(spark, sf):
    f = text.copy_features(F.col("text"))
    longs = [f[c].cast("long").alias(c) for c in ("total_word_count", "total_char_count", "exclamation_count", "question_count")]
    return table(spark, sf, "documents").select("doc_id", *longs, f["cta_present"].alias("cta_present"), f["has_legal"].alias("has_legal"))


_HEX = "lpad(lower(to_hex((p_partkey * 2654435761) % 16777216)), 6, '0')"


@query(f"""WITH h AS (SELECT p_partkey, '#' || {_HEX} AS hex, (p_partkey * 2654435761) % 16777216 AS v FROM part), c AS (SELECT *, v // 65536 AS r, (v // 256) % 256 AS g, v % 256 AS b FROM h),
l AS (SELECT *, greatest(r, g, b) AS hi, least(r, g, b) AS lo, list_transform([r, g, b], lambda x: CASE WHEN x / 255.0 <= 0.03928 THEN x / 255.0 / 12.92 ELSE pow((x / 255.0 + 0.055) / 1.055, 2.4) END) AS lin FROM c)
SELECT p_partkey, hex, CASE WHEN hi - lo < 30 THEN CASE WHEN hi > 200 THEN 'white' WHEN hi < 50 THEN 'black' ELSE 'gray' END WHEN r = hi THEN 'red' WHEN g = hi THEN 'green' ELSE 'blue' END AS bucket,
round(0.2126 * lin[1] + 0.7152 * lin[2] + 0.0722 * lin[3], 6) AS luminance, r > 150 AND b < 150 AS warm, round(CASE WHEN hi = 0 THEN 0.0 ELSE (hi - lo) / hi END, 6) AS saturation,
round(1.05 / (0.2126 * lin[1] + 0.7152 * lin[2] + 0.0722 * lin[3] + 0.05), 6) AS white_contrast FROM l""")
def color_features(spark, sf):
    value = F.pmod(F.col("p_partkey") * 2654435761, F.lit(16777216))
    rows = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("#"), F.lpad(F.lower(F.hex(value)), 6, "0")).alias("hex"))
    c = F.col("hex")
    return rows.select(
        "p_partkey", "hex", color.bucket(c).alias("bucket"), F.round(color.luminance(c), 6).alias("luminance"), color.is_warm(c).alias("warm"),
        F.round(color.saturation(c), 6).alias("saturation"), F.round(color.contrast(F.lit("#ffffff"), c), 6).alias("white_contrast"),
    )


@query("""WITH s AS (SELECT l_orderkey, l_partkey % 256 AS r, l_suppkey % 256 AS g FROM lineitem), t AS (SELECT l_orderkey, CASE WHEN greatest(r, g) = 0 THEN 0.0 ELSE (greatest(r, g) - 0) / greatest(r, g) END AS x, r, g FROM s),
u AS (SELECT l_orderkey, CASE WHEN greatest(r, g, 40) = 0 THEN 0.0 ELSE (greatest(r, g, 40) - least(r, g, 40)) / greatest(r, g, 40) END AS sat FROM t)
SELECT l_orderkey, CASE WHEN count(*) >= 2 THEN round(stddev_samp(sat), 6) END AS vibrancy FROM u GROUP BY l_orderkey""")
def palette_vibrancy(spark, sf):
    two = lambda c: F.lpad(F.lower(F.hex(F.pmod(c, F.lit(256)))), 2, "0")
    hex_color = F.concat(F.lit("#"), two(F.col("l_partkey")), two(F.col("l_suppkey")), F.lit("28"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.round(color.group_vibrancy(hex_color), 6).alias("vibrancy"))


@query("""WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice / 5000 END AS price FROM orders)
SELECT o_orderkey, CASE WHEN price IS NULL THEN 'unknown' WHEN price < 15 THEN 'budget' WHEN price < 35 THEN 'mid' WHEN price < 60 THEN 'premium' ELSE 'luxury_bundle' END AS price_tier FROM p""")
def price_tier(spark, sf):
    price = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice") / 5000)
    return table(spark, sf, "orders").select("o_orderkey", money.price_tier(price).alias("price_tier"))


@query("""SELECT o_orderkey, o_totalprice AS cleaned, CAST(o_orderkey AS BIGINT) AS reviews FROM orders""")
def price_cleaner(spark, sf):
    """Prices and counts written into text come back."""
    o = table(spark, sf, "orders")
    raw = F.concat(F.lit("was $1.00 now $"), F.format_number("o_totalprice", 2))
    count = F.concat(F.format_number("o_orderkey", 0), F.lit(" reviews"))
    return o.select("o_orderkey", money.clean_price(raw).alias("cleaned"), html.review_count(count).alias("reviews"))


@query("""WITH u AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+', 0) AS scheme, lower(regexp_extract(url, '//([^/?#]*)', 1)) AS host, regexp_replace(regexp_extract(url, '//[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages), k AS (SELECT page_id, string_agg(p, '&' ORDER BY p) AS q FROM (SELECT page_id, unnest(string_split(q, '&')) AS p FROM u WHERE q <> '')
WHERE p <> '' AND NOT starts_with(lower(p), 'utm_') AND split_part(lower(p), '=', 1) NOT IN ('fbclid','gclid','ttclid','ad_id','adset_id','campaign_id','placement','site_source_name','variant','_ke','_pos','_ss','preview_theme_id','affiliate_id','ref') GROUP BY page_id)
SELECT u.page_id, scheme || '://' || host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN k.q IS NULL THEN '' ELSE '?' || k.q END AS canonical FROM u LEFT JOIN k USING (page_id)""")
def url_canonical(spark, sf):
    return table(spark, sf, "pages").select("page_id", url.canonical(F.col("url")).alias("canonical"))


@query("""SELECT page_id, regexp_matches(lower(url), '[?&]utm_[a-z]+=[^&]') AS has_utm_tracking, 'unknown' AS utm_medium_category, false AS utm_dynamic_naming, CAST(0 AS BIGINT) AS utm_content_granularity_score, 'unknown' AS campaign_role_signal FROM pages""")
def utm_features(spark, sf):
    """The pages carry only utm_source; the other rules are tested on literal rows."""
    f = url.campaign_features(F.col("url"))
    f["utm_content_granularity_score"] = f["utm_content_granularity_score"].cast("long")
    return table(spark, sf, "pages").select("page_id", *[c.alias(n) for n, c in f.items()])


_DETECT = lambda rules, otherwise: "CASE " + " ".join(f"WHEN regexp_matches(html, '{p}') THEN '{n}'" for n, p in rules.items()) + f" ELSE {otherwise} END"


@query(f"SELECT page_id, {_DETECT(html.BUILDERS, 'NULL')} AS builder, {_DETECT(html.SUBSCRIPTION_APPS, 'NULL')} AS subscription_app FROM pages")
def page_detectors(spark, sf):
    h = F.col("html")
    return table(spark, sf, "pages").select("page_id", html.builder(h).alias("builder"), html.subscription_app(h).alias("subscription_app"))


_TEXT = "html"
for _tag in ("script", "style", "svg", "noscript", "iframe"):
    _TEXT = f"regexp_replace({_TEXT}, '<{_tag}\\b[^>]*>.*?</{_tag}\\s*>', ' ', 'gis')"
_TEXT = f"trim(regexp_replace(regexp_replace({_TEXT}, '<[^>]+>', ' ', 'gs'), '[ \\t\\n\\f\\r\\x0B]+', ' ', 'g'))"


@query(f"""WITH t AS (SELECT page_id, {_TEXT} AS t FROM pages), c AS (SELECT page_id, regexp_replace(regexp_replace(t, '\\b[0-9a-f]{{16,}}\\b', '', 'gi'),
'\\b[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}(\\.[0-9]+)?Z?\\b', '', 'g') AS t FROM t)
SELECT page_id, sha256(trim(regexp_replace(t, '[ \\t\\n\\f\\r\\x0B]+', ' ', 'g'))) AS content_hash FROM c""")
def content_hash(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.content_hash(F.col("html")).alias("content_hash"))


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey % 97 + 5 AS xc, (l_suppkey % 89) / 100.0 AS y FROM lineitem)
SELECT l_orderkey, count(*) FILTER (y + 0.05 < 1.0/3) AS n_top, count(*) FILTER (y + 0.05 >= 1.0/3 AND y + 0.05 < 2.0/3) AS n_middle, count(*) FILTER (y + 0.05 >= 2.0/3) AS n_bottom,
CASE WHEN bool_and(abs(xc - 50) < 12) THEN 'center' WHEN sum(xc) < 40 * count(*) THEN 'left' WHEN sum(xc) > 60 * count(*) THEN 'right' ELSE 'mixed' END AS text_alignment, round(CAST(count(*) AS DOUBLE) * 0.01, 6) AS copy_canvas_coverage FROM b GROUP BY l_orderkey""")
def placement_zones(spark, sf):
    """The SQL counts x in whole hundredths: means of exactly 0.4 or 0.6 hung on the order of a sum of doubles."""
    x, y = F.pmod("l_partkey", F.lit(97)) / 100, F.pmod("l_suppkey", F.lit(89)) / 100
    box = F.struct(x.alias("x0"), y.alias("y0"), (x + 0.1).alias("x1"), (y + 0.1).alias("y1"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", (x + 0.05).alias("xc"), (y + 0.05).alias("yc"), geometry.box_metrics(box, F.lit(1.0), F.lit(1.0))["coverage"].alias("c"))
    zone = geometry.zone(F.col("yc"))
    grouped = rows.groupBy("l_orderkey").agg(*[F.count_if(zone == z).alias(f"n_{z}") for z in ("top", "middle", "bottom")], geometry.group_alignment(F.col("xc")).alias("text_alignment"), F.sum("c").alias("c"))
    return grouped.select("l_orderkey", "n_top", "n_middle", "n_bottom", "text_alignment", F.round("c", 6).alias("copy_canvas_coverage"))


@query("""WITH d AS (SELECT p_partkey, 100 + p_partkey % 1000 AS w, 100 + p_size * 20 AS h FROM part), r AS (SELECT *, w / h AS r FROM d)
SELECT p_partkey, CASE WHEN abs(r - 1) <= 0.03 THEN '1:1' WHEN abs(r - 0.8) / 0.8 <= 0.03 THEN '4:5' WHEN abs(r - 0.5625) / 0.5625 <= 0.03 THEN '9:16' WHEN abs(r - 16.0/9) / (16.0/9) <= 0.03 THEN '16:9'
WHEN abs(r - 4.0/3) / (4.0/3) <= 0.03 THEN '4:3' WHEN abs(r - 0.75) / 0.75 <= 0.03 THEN '3:4' WHEN abs(r - 2.0/3) / (2.0/3) <= 0.03 THEN '2:3' WHEN abs(r - 1.5) / 1.5 <= 0.03 THEN '3:2'
ELSE (w // gcd(w, h)) || ':' || (h // gcd(w, h)) END AS aspect FROM r""")
def aspect_ratio(spark, sf):
    w, h = 100 + F.pmod("p_partkey", F.lit(1000)), 100 + F.col("p_size") * 20
    return table(spark, sf, "part").select("p_partkey", geometry.aspect_label(w, h).alias("aspect"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_props(spark, sf):
    """Schemaless payloads are read as variants."""
    return table(spark, sf, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))
