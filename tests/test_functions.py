"""Column packs on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from admill.functions import color, dates, geometry, html, money, text, url


def lit(x):
    return F.lit(x)


def cases():
    return [
        (text.urgency(lit("I know it")), True),  # a term inside a word counts
        (text.urgency(lit(None).cast("string")), False),
        (text.cta_type(lit("  SHOP NOW! ")), "shop_now"),
        (text.cta_type(lit("")), "none"),
        (text.cta_type(lit("  ")), "other"),
        (text.season(lit("one shot")), "summer"),
        (text.premium_positioning(lit("plain"), lit(30.0), lit(20.0)), True),
        (text.premium_positioning(lit("plain"), lit(None).cast("double"), lit(20.0)), False),
        (text.subcategory(lit("Whey isolate"), lit("vitamin")), "protein"),
        (text.reading_grade(lit("")), 0.0),
        (text.joined_ad_text(lit("a"), lit(""), lit("b")), "a | b"),
        (text.cut_at_paragraph(lit("ab\n\ncdef"), 6), "ab"),
        (text.grounded_number(lit(1299.0), lit("for $1,299 today")), True),
        (text.grounded_number(lit(12.5), lit("112.50")), False),
        (money.clean_price(lit("was $1,200.50 now $99.99")), 99.99),
        (money.clean_price(lit("free")), None),
        (money.clean_count(lit("(1,234 reviews)")), 1234),
        (money.price_tier(lit(None).cast("double")), "unknown"),
        (money.price_tier(lit(15.0)), "mid"),
        (money.price_tier(lit(60.0)), "luxury_bundle"),
        (money.accepted_price(lit(1.0)), None),
        (money.marketplace(lit("www.amazon.co.uk"))["currency"], "GBP"),
        (money.marketplace(lit("amazon.com.mx"))["region"], "mx"),
        (money.marketplace(lit("notamazon.com"))["region"], None),
        (color.bucket(lit("#ffffff")), "white"),
        (color.bucket(lit("#0a0a0a")), "black"),
        (color.bucket(lit("#ff8000")), "red"),
        (color.bucket(lit("nope")), "unknown"),
        (color.luminance(lit("bad")), 0.5),
        (color.is_warm(lit("#ff0000")), True),
        (color.vibrancy(F.array(lit("#ff0000"))), None),
        (color.vibrancy_or_default(F.array(lit("#ff0000"), lit("#00ff00"))), 0.5),
        (color.legible(lit("#777777"), lit("#888888")), "#000000"),
        (geometry.aspect_label(lit(1080), lit(1350)), "4:5"),
        (geometry.aspect_label(lit(500), lit(100)), "5:1"),
        (geometry.aspect_label(lit(0), lit(100)), ""),
        (geometry.zone(lit(0.5)), "middle"),
        (geometry.alignment(F.array(lit(0.1), lit(0.9))), "mixed"),
        (dates.iso_date(lit("1704067200")), "2024-01-01"),
        (dates.iso_date(lit("2024-03-05T10:00:00Z")), "2024-03-05"),
        (dates.iso_date(lit("")), None),
        (dates.iso_date(lit("not a date at all")), "not a date"),
        (url.canonical(lit("HTTPS://Shop.Example.COM/p/?b=2&utm_source=x&a=1&fbclid=9#top")), "https://shop.example.com/p?a=1&b=2"),
        (url.canonical(lit("https://x.com")), "https://x.com/"),
        (url.canonical(lit("https://x.com/a?k=")), "https://x.com/a?k="),
        (url.expired(lit("https://x/a?oe=5F000000"), lit(1_700_000_000)), True),
        (url.expired(lit("https://x/a"), lit(1_700_000_000)), False),
        (html.builder(lit("<div class='PF-Container'>")), "pagefly"),
        (html.subscription_status(lit(""), lit("Subscription only. Cancel anytime")), "subscription_required"),
        (html.subscription_status(lit(""), lit("Subscribe & save or one-time purchase")), "subscription_optional"),
        (html.subscription_status(lit(""), lit("hello")), "unknown"),
        (html.subscription_price(lit("$1.50/day or $29.95/month")), 29.95),
        (html.subscription_price(lit("just $1.50 per day")), 45.0),
        (html.offer(lit("3 Bottles - $89.97 Best Value"))["tier_label"], "3 Bottles"),
        (html.offer(lit("3 Bottles"))["quantity"], None),
        (html.visible_text(lit("<p>a</p><script>var b='</p>'</script> <b>c</b>")), "a c"),
        (html.star_rating(lit("4.9 stars, 88 reviews")), 4.9),
        (html.review_count(lit("$34.99 rating 4.9 stars, 88 reviews")), 88),
    ]


def test_values(spark):
    got = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(cases())]).first()
    for (column, expected), value in zip(cases(), got):
        assert value == (pytest.approx(expected) if isinstance(expected, float) else expected), str(column)


def test_campaign_features(spark):
    address = lit("https://x.com/?utm_medium=Paid-Social&utm_campaign=spring&utm_content=hook_video&UTM_term=%7B%7Bad.name%7D%7D")
    f = spark.range(1).select(*[c.alias(n) for n, c in url.campaign_features(address).items()]).first()
    assert f.asDict() == {"has_utm_tracking": True, "utm_medium_category": "dedicated_paid_social", "utm_dynamic_naming": True, "utm_content_granularity_score": 2, "campaign_role_signal": "likely_test"}
    f = spark.range(1).select(*[c.alias(n) for n, c in url.campaign_features(lit("https://x.com/?utm_medium=cpc&utm_campaign=spring&utm_campaign=b")).items()]).first()
    assert (f["utm_medium_category"], f["campaign_role_signal"]) == ("legacy_generic", "likely_scale")


def test_structured_data(spark):
    page = '<script type="application/ld+json">{"@type":"Product","name":"A","brand":{"name":"B"},"offers":{"price":"9.5","priceCurrency":"EUR"},"aggregateRating":{"ratingValue":0,"reviewCount":12}}</script><meta property="og:title" content="T">'
    r = spark.range(1).select(html.product_of(html.json_ld(lit(page))).alias("p"), html.open_graph(lit(page), "title").alias("t")).first()
    assert r["p"].asDict() == {"name": "A", "brand": "B", "price": 9.5, "currency": "EUR", "rating": None, "rating_count": 12}
    assert r["t"] == "T"


def test_content_hash_ignores_noise(spark):
    a, b = ("<p>same</p><style>x</style> 2024-01-01T00:00:00Z", "<div>same</div><script>1</script> deadbeefdeadbeef00")
    r = spark.range(1).select(html.content_hash(lit(a)).alias("a"), html.content_hash(lit(b)).alias("b")).first()
    assert r["a"] == r["b"]


def test_copy_features(spark):
    f = spark.range(1).select(*[c.alias(n) for n, c in text.copy_features(lit("BUY now! 😀 $9.99 Results may vary?")).items()]).first()
    assert (f["emoji_count"], f["exclamation_count"], f["has_price"], f["has_legal"]) == (1, 1, True, True)
    assert math.isclose(f["uppercase_ratio"], 4 / 20)


def test_offer_cards_and_product_cascade(spark):
    from admill.functions import dom

    page = """<meta property="og:title" content="Gummies"><div class="Offer-Card"><b>1 Bottle</b> $39.99<br></div>
    <div class="bundle best"><p>3 Bottles - Best Value</p><p>$89.97</div><div class="tier">no price here, 2 packs</div>
    <div class="offer">1 bottle $39.99 or 3 bottles $89.97</div><p>4.8 stars, 1,204 reviews</p><script>class="offer" 9 packs $1</script>"""
    r = spark.createDataFrame([(page,), ("<p>plain</p>",), (None,)], "h string").select(dom.offers(F.col("h")).alias("o"), dom.product(F.col("h")).alias("p")).collect()
    assert [(o["quantity"], o["total_price"], o["is_best_value"]) for o in r[0]["o"]] == [(1, 39.99, False), (3, 89.97, True)]
    assert (r[0]["p"]["name"], r[0]["p"]["rating"], r[0]["p"]["rating_count"]) == ("Gummies", 4.8, 1204)
    assert not r[1]["o"] and not r[2]["o"]
