"""Product tiers by cases, and the whole cascade with its provenance."""

import json

from admill.functions import tiers


def cascaded(spark, *rows):
    """Rows of (page, fetched, url), the last two optional; one plan for all, since the plan is the slow part."""
    full = [(i, *(r + (None, "https://shop.example/p")[len(r) - 1 :])) for i, r in enumerate(rows)]
    pages = spark.createDataFrame(full, "i int, html string, fetched string, url string").coalesce(1)
    return sorted(tiers.cascade(pages, fetched="fetched").collect(), key=lambda r: r["i"])


FETCHED = [
    ({"product": {"variants": [{"title": "A", "price": "19.99"}, {"title": "", "price": "9.50"}], "body_html": "<p>Fine</p>"}}, (9.5, ["A"], "Fine", None, None)),
    ([{"body": {"products": [{"variants": [{"price": "$12"}]}, {"variants": [{"price": "1"}]}]}}, {"rating": "4.7", "total_reviews": "1,204 reviews"}], (12.0, None, None, 4.7, 1204)),
    ([7, "x", {"product": "text", "products": [{"variants": [{"price": "3"}]}]}], (None, None, None, None, None)),
    ({"product": {}, "products": [{"variants": {"title": "no list"}}], "average_rating": None, "rating": 4, "review_count": 0}, (None, None, None, None, 0)),
    ([{"score": 3.5}, {"score": 4.5, "reviews_count": 8}], (None, None, None, 3.5, 8)),
    ([], (None, None, None, None, None)),
]


def test_fetched_json_of_any_shape(spark):
    for r, (_, expected) in zip(cascaded(spark, *[(None, json.dumps(p)) for p, _ in FETCHED]), FETCHED, strict=True):
        assert (r["product_price"], r["variants"], r["product_description"], r["rating"], r["rating_count"]) == expected
        assert set(r["told_by"].values()) <= {"xhr"} and r["subscription_status"] == "unknown"


WIDGETS = [
    ('<div class="yotpo-bottomline" data-score="4.6" data-total-reviews="31"></div>', (4.6, 31)),
    ('<div class="yotpo-bottomline" data-total-reviews="31"></div><loox-rating data-rating="4.1"></loox-rating>', (4.1, 31)),
    ('<b data-loox-rating="4.9" data-raters="7"></b><div class="a jdgm-widget" data-average-rating="2" data-number-of-reviews="9"></div>', (4.9, 7)),
    ('<div class="jdgm-prev-badge" data-number-of-reviews="9"></div><i data-oke-reviews-product-rating="3.3" data-oke-reviews-product-review-count="12"></i>', (3.3, 12)),
    ('<span itemprop="ratingValue" content="4.0">5</span><div class="jdgm-widget" data-average-rating="2" data-number-of-reviews="9"></div>', (4.0, 9)),
    ("<div class='jdgm-widgets' data-average-rating='2'></div>", (None, None)),
]


def test_review_widgets(spark):
    for r, (_, expected) in zip(cascaded(spark, *[(p,) for p, _ in WIDGETS]), WIDGETS, strict=True):
        assert (r["rating"], r["rating_count"]) == expected


def test_selectors():
    page = '<div id="o"><p class="a b">one<i data-price="7">two</i></p></div><p class="b">three</p><div class="product-price"><s>$59.99</s><span>$39.99</span></div>'
    found = tiers.Selected(tiers.Elements(page))
    text = lambda s: found.e.text(found.first(s))
    assert text("#o .b") == "one two" and text(".c, .b") == "one two" and text('[data-price="7"]') == "two" and text("#o i") == "two"
    assert found.first(".ab") is None and found.first("#o #o") is None and found.first('[data-price="8"]') is None
    assert found.told([".product-price"]) == "$59.99 $39.99" and found.told([".none", "[data-price]"]) == "7" and found.joined(".a") == "onetwo"


def test_earlier_tiers_win_by_field(spark):
    page = """<title>Calm Gummies | Rest | Shop</title><script type="application/ld+json">[{"@type": "Organization", "name": "Maker"},
    {"@type": "Product", "description": "<b>Sleep</b> well", "offers": {"price": 0}}]</script><script type="application/ld+json">{"@type": "Product", "offers": {"price": "24.5"}}</script>
    <script>window.ShopifyAnalytics.meta.product = {"price": 2999, "variants": [{"title": "One"}, {"name": "Two"}]};</script><span class="money">$11</span><b class="review-count">(88)</b>
    Subscribe & save $20 per month"""
    (r,) = cascaded(spark, (page, '{"rating": "4.4"}'))
    assert (r["product_name"], r["brand_name"], r["product_price"], r["product_description"]) == ("Calm Gummies", "Maker", 24.5, "Sleep well")
    assert (r["variants"], r["rating"], r["rating_count"]) == (["One", "Two"], 4.4, 88)
    assert r["told_by"] == {"product_name": "json_ld", "brand_name": "json_ld", "product_price": "json_ld", "product_description": "json_ld", "variants": "window", "rating": "xhr", "rating_count": "dom"}
    assert (r["subscription_status"], r["subscription_price"]) == ("subscription_optional", 20.0)


def test_builders_and_marketplaces_come_last(spark):
    cards = '<h1>Deal</h1><div class="pf-container"></div><div class="offer">3 bottles $90</div><p>4.8 stars, 120 reviews</p>'
    market = """<span id="productTitle"> Pills </span><a id="bylineInfo">Visit the Acme Store</a><div id="apex_desktop"><b class="a-price"><i class="a-offscreen">EUR 1,024.50</i></b></div>
    <i class="a-icon-alt">4.3 out of 5</i><span id="acrCustomerReviewText">2,001 ratings</span>"""
    r = cascaded(spark, (cards,), (cards.replace("pf-container", "plain"),), (market, None, "https://www.amazon.de/dp/1"), (market,))
    assert (r[0]["product_name"], r[0]["product_price"], r[0]["variants"], r[0]["rating"], r[0]["rating_count"]) == ("Deal", 30.0, ["3 bottles"], 4.8, 120)
    assert set(r[0]["told_by"].values()) == {"builder"} and r[1]["product_price"] is None and r[3]["brand_name"] is None
    assert (r[2]["product_name"], r[2]["brand_name"], r[2]["product_price"], r[2]["rating"], r[2]["rating_count"]) == ("Pills", "Acme", 1024.5, 4.3, 2001)
    assert (r[2]["marketplace_region"], r[2]["product_currency"]) == ("de", "EUR")


def test_odd_pages(spark):
    rows = spark.createDataFrame([(None, None, None), ("", "", ""), ("<p>" * 3000, "::", "{broken"), ("<div class='price'>", "x", "[[1], null]")], "html string, url string, fetched string")
    out = tiers.cascade(rows, fetched="fetched")
    assert all(r["told_by"] == {} and r["product_price"] is None for r in out.collect()) and tiers.cascade(rows.limit(0)).count() == 0
    assert tiers.cascade(rows.drop("fetched")).count() == 4
