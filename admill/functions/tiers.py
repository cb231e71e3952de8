"""Product data of pages by tiers: fetched JSON, structured data, script objects, the element tree with review widgets, page builders.

An earlier tier wins, field by field, and every field names the tier that told it. Pages are parsed once, in Arrow batches; that
gives raw texts, and all cleaning is columns.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from admill.functions import dom, html
from admill.functions.money import clean_count, clean_price, marketplace
from admill.functions.text import text_or_empty
from admill.functions.tree import Elements
from admill.functions.url import host
from admill.operators import relational as rel

FIELDS = ["product_name", "brand_name", "product_price", "product_description", "variants", "rating", "rating_count"]

# Where pages keep prices, descriptions, ratings and counts, in the order they are tried.
SELECTORS = {
    "price": [
        '[itemprop="price"]', "[data-price]", ".price-item--sale", ".price-item--regular", ".price-item", ".price__regular", ".price__sale",
        ".product__price", ".product-price", ".woocommerce-Price-amount", ".price", ".money",
    ],
    "description": ['[itemprop="description"]', ".product-description", ".product__description"],
    "rating": ['[itemprop="ratingValue"]', ".rating-value", "[data-rating]"],
    "count": ['[itemprop="reviewCount"]', ".review-count", "[data-review-count]"],
}
# Attributes that stand for an element's text, then review widgets with their attributes for rating and count.
TOLD_BY = ["content", "data-price", "data-rating"]
WIDGETS = [
    ("[data-yotpo-average-rating], .yotpo-bottomline", ["data-yotpo-average-rating", "data-score"], ["data-yotpo-total-reviews", "data-total-reviews"]),
    ("loox-rating, [data-loox-rating]", ["data-rating", "data-loox-rating"], ["data-raters", "data-reviews-count"]),
    (".jdgm-prev-badge, .jdgm-widget", ["data-average-rating"], ["data-number-of-reviews"]),
    ("[data-oke-reviews-product-rating], [data-oke-reviews-product-review-count]", ["data-oke-reviews-product-rating"], ["data-oke-reviews-product-review-count"]),
]
# Parts of a marketplace's product page, what its host ends in, and keys of review payloads.
MARKET = {
    "market_title": "#productTitle",
    "market_brand": "#bylineInfo",
    "market_rating": ".a-icon-alt, #acrPopover",
    "market_count": "#acrCustomerReviewText",
    "market_price": "#corePrice_feature_div .a-price .a-offscreen, #apex_desktop .a-price .a-offscreen",
}
MARKET_HOST = r"(?i)(?:^|\.)amazon\.[a-z.]+$"
BYLINE = r"(?i)^\s*(?:visit the|brand:)\s*|\s*store\s*$"
RATING_KEYS = ["average_rating", "rating", "score"]
COUNT_KEYS = ["total_reviews", "review_count", "reviews_count"]

_SIMPLE = re.compile(r'#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w-]+)(?:="(?P<value>[^"]*)")?\]|(?P<tag>[A-Za-z][\w-]*)')


class Selected:
    """First elements of a page by selector: tags, #ids, .classes and [attributes], below one another, or one of several."""

    def __init__(self, e: Elements):
        self.e = e
        self._found: dict[tuple[str, str], list[int]] = defaultdict(list)
        for i in range(1, len(e.tag)):
            for key in self._keys(i):
                self._found[key].append(i)

    def _keys(self, i: int) -> Iterator[tuple[str, str]]:
        attrs = self.e.attrs[i]
        yield "tag", self.e.tag[i]
        for name in attrs:
            yield "attr", name
        for name in set(attrs.get("class", "").split()):
            yield "cls", name
        if attrs.get("id"):
            yield "id", attrs["id"]

    def _fits(self, i: int, part: str) -> bool:
        attrs = self.e.attrs[i]
        for m in _SIMPLE.finditer(part):
            kind, name = m.lastgroup, m[m.lastgroup]
            if kind == "value":
                if attrs.get(m["attr"]) != name:
                    return False
            elif kind == "attr" and name not in attrs or kind == "cls" and name not in attrs.get("class", "").split():
                return False
            elif kind == "id" and attrs.get("id") != name or kind == "tag" and self.e.tag[i] != name:
                return False
        return True

    def _below(self, i: int, outer: list[str]) -> bool:
        for part in reversed(outer):
            i = self.e.parent[i]
            while i > 0 and not self._fits(i, part):
                i = self.e.parent[i]
            if i <= 0:
                return False
        return True

    def first(self, selector: str) -> int | None:
        best = None
        for one in selector.split(","):
            *outer, last = one.split()
            m = _SIMPLE.match(last)
            kind = "attr" if m["attr"] else m.lastgroup
            for i in self._found.get((kind, m[kind]), ()):
                if best is not None and i >= best:
                    break
                if self._fits(i, last) and self._below(i, outer):
                    best = i
                    break
        return best

    def told(self, selectors: list[str]) -> str | None:
        """The first text of the selectors' elements: what an attribute says, else the text below."""
        for selector in selectors:
            i = self.first(selector)
            if i is not None:
                attrs = self.e.attrs[i]
                text = next((attrs[a] for a in TOLD_BY if attrs.get(a)), None) or self.e.text(i)
                if text:
                    return text
        return None

    def joined(self, selector: str) -> str | None:
        """Strings below an element without anything between them."""
        i = self.first(selector)
        return None if i is None else "".join(self.e.strings[slice(*self.e.text_span[i])])

    def widgets(self) -> list[dict[str, str | None]]:
        """Raw rating and count of each kind of review widget on the page, in order."""
        out = []
        for selector, rating, count in WIDGETS:
            i = self.first(selector)
            if i is not None:
                attrs = self.e.attrs[i]
                out.append({k: next((attrs[a] for a in names if attrs.get(a)), None) for k, names in (("rating", rating), ("count", count))})
        return out


_RAW = [*SELECTORS, *MARKET, "heading"]
RAW = ", ".join(f"{c} string" for c in _RAW) + ", widgets array<struct<rating: string, count: string>>"


def raw_texts(page: str | None) -> dict:
    found = Selected(Elements(page))
    texts = {c: found.told(s) for c, s in SELECTORS.items()} | {c: found.joined(s) for c, s in MARKET.items()}
    return texts | {"heading": found.joined("h1"), "widgets": found.widgets()}


def _raw(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([raw_texts(x) for x in batch], columns=[*_RAW, "widgets"])


def tree_texts(page: Column) -> Column:
    """Raw texts of a page's element tree, for dom_tier and builder_tier."""
    return F.pandas_udf(_raw, RAW)(page)


def _kind(v: Column, path: str = "$") -> Column:
    """OBJECT, ARRAY, STRING and so on; null where there is nothing at the path."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, path, "variant")), "^[A-Z]+", 0)


def _is(v: Column, kind: str, path: str = "$") -> Column:
    return F.coalesce(_kind(v, path) == kind, F.lit(False))


def _list(v: Column, path: str = "$") -> Column:
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def _objects(v: Column) -> Column:
    """The objects of a value that is one or a list of them."""
    return F.filter(F.when(_is(v, "ARRAY"), _list(v)).otherwise(F.array(v)), lambda x: _is(x, "OBJECT"))


def _told(v: Column, path: str) -> Column:
    """Text of a scalar; null for zero, false, an empty text and anything else."""
    raw = F.to_json(F.try_variant_get(v, path, "variant"))
    return F.when(~raw.isin("0", "0.0", '""', "false", "null"), F.try_variant_get(v, path, "string"))


def _string(v: Column, path: str) -> Column:
    return F.when(_is(v, "STRING", path), F.nullif(F.trim(F.try_variant_get(v, path, "string")), F.lit("")))


def _first(values: Column, of: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(F.transform(values, of), lambda x: x.isNotNull()), F.lit(0))


def _description(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) != "", html.description(text))


def _filled(names: Column) -> Column:
    return F.when(F.size(names) > 0, names)


def fetched_tier(payload: Column) -> dict[str, Column]:
    """From JSON that a page fetched (a variant): an answer or a list of them, each maybe below body; storefront products and review payloads."""
    answers = F.transform(_objects(payload), lambda e: F.when(_is(e, "OBJECT", "$.body"), F.try_variant_get(e, "$.body", "variant")).otherwise(e))

    def product(b: Column) -> Column:
        own = F.to_json(F.try_variant_get(b, "$.product", "variant"))
        none = own.isNull() | own.isin("null", '""', "{}", "[]", "0", "false")
        found = F.when(none, F.get(_list(b, "$.products"), F.lit(0))).otherwise(F.try_variant_get(b, "$.product", "variant"))
        return F.when(_is(found, "OBJECT"), found)

    def variants(b: Column) -> Column:
        return F.filter(_list(product(b), "$.variants"), lambda v: _is(v, "OBJECT"))

    def titles(b: Column) -> Column:
        return _filled(F.filter(F.transform(variants(b), lambda v: _told(v, "$.title")), lambda t: t.isNotNull()))

    def price(b: Column) -> Column:
        return F.array_min(F.filter(F.transform(variants(b), lambda v: clean_price(F.try_variant_get(v, "$.price", "string"))), lambda p: p.isNotNull()))

    def keyed(keys: list[str], clean) -> Callable[[Column], Column]:
        """The first of the keys that an answer has counts, whether or not it holds a number."""

        def of(b: Column) -> Column:
            out = F.lit(None)
            for key in reversed(keys):
                out = F.when(F.try_variant_get(b, f"$.{key}", "variant").isNotNull(), clean(F.try_variant_get(b, f"$.{key}", "string"))).otherwise(out)
            return out

        return of

    return {
        "product_price": _first(answers, price),
        "product_description": _first(answers, lambda b: _description(_told(product(b), "$.body_html"))),
        "variants": _first(answers, titles),
        "rating": _first(answers, keyed(RATING_KEYS, clean_price)),
        "rating_count": _first(answers, keyed(COUNT_KEYS, clean_count)),
    }


def structured_tier(page: Column) -> dict[str, Column]:
    """From JSON-LD: all products of all blocks; then organisations, the site's name and the title for names."""
    blocks = F.regexp_extract_all(text_or_empty(page), F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    items = F.flatten(F.transform(blocks, lambda b: _objects(F.try_parse_json(F.trim(b)))))
    kind = lambda v: F.coalesce(F.try_variant_get(v, "$['@type'][0]", "string"), F.try_variant_get(v, "$['@type']", "string"))
    products = F.filter(items, lambda v: F.coalesce(kind(v) == "Product", F.lit(False)))
    makers = F.filter(items, lambda v: F.coalesce(kind(v) == "Organization", F.lit(False)))
    return {
        "product_name": F.coalesce(_first(products, lambda v: _string(v, "$.name")), html.product_name(html.title(page))),
        "brand_name": F.coalesce(
            _first(products, lambda v: F.coalesce(_string(v, "$.brand"), _string(v, "$.brand.name"))),
            _first(makers, lambda v: _string(v, "$.name")),
            F.nullif(F.trim(html.open_graph(page, "site_name")), F.lit("")),
        ),
        "product_price": _first(products, lambda v: clean_price(F.coalesce(_told(v, "$.offers[0].price"), _told(v, "$.offers.price")))),
        "product_description": _first(products, lambda v: _description(_told(v, "$.description"))),
        "rating": _first(products, lambda v: clean_price(_told(v, "$.aggregateRating.ratingValue"))),
        "rating_count": _first(products, lambda v: clean_count(_told(v, "$.aggregateRating.reviewCount"))),
    }


def script_tier(page: Column) -> dict[str, Column]:
    told = html.window_product(page)
    return {"brand_name": told["brand"], "product_price": told["price"], "variants": told["variants"]}


def dom_tier(texts: Column) -> dict[str, Column]:
    """From tree_texts; review widgets fill what the page's own elements don't tell. A widget counts while none before it gave a rating."""
    start = F.struct(F.lit(None).cast("double").alias("rating"), F.lit(None).cast("long").alias("count"))
    step = lambda acc, w: F.when(acc["rating"].isNotNull(), acc).otherwise(F.struct(clean_price(w["rating"]).alias("rating"), F.coalesce(clean_count(w["count"]), acc["count"]).alias("count")))
    widget = F.aggregate(texts["widgets"], start, step)
    return {
        "product_price": clean_price(texts["price"]),
        "product_description": _description(texts["description"]),
        "rating": F.coalesce(clean_price(texts["rating"]), widget["rating"]),
        "rating_count": F.coalesce(clean_count(texts["count"]), widget["count"]),
    }


def _market(url: Column) -> Column:
    return F.coalesce(host(url).rlike(MARKET_HOST), F.lit(False))


def builder_cards(page: Column, url: Column) -> Column:
    """Offer cards of pages that a known builder made, for builder_tier."""
    return dom.offers(F.when(html.builder(page).isNotNull() & ~_market(url), page))


def builder_tier(page: Column, url: Column, texts: Column, cards: Column) -> dict[str, Column]:
    """From marketplaces' own parts, or the offer cards and social proof of pages that a known builder made."""
    market = _market(url)
    built = html.builder(page).isNotNull() & ~market
    cards = F.transform(cards, lambda o: o.withField("price_per_unit", F.round(o["price_per_unit"], 2)))
    text = html.visible_text(F.when(built, page))
    got = rel.direct_response({}, cards, {"rating": html.star_rating(text), "rating_count": html.review_count(text)})
    useful = built & ((F.coalesce(F.size(cards), F.lit(0)) > 0) | got["rating"].isNotNull() | got["rating_count"].isNotNull())
    number = lambda c, pattern, kind: F.translate(F.regexp_extract(text_or_empty(texts[c]), pattern, 1), ",", "").try_cast(kind)
    named = lambda c: F.nullif(F.trim(c), F.lit(""))
    either = lambda there, card: F.when(market, there).when(useful, card)
    return {
        "product_name": either(named(texts["market_title"]), F.coalesce(named(html.title(page)), named(texts["heading"]))),
        "brand_name": F.when(market, named(F.regexp_replace(texts["market_brand"], BYLINE, ""))),
        "product_price": either(number("market_price", r"([0-9,]+\.[0-9]{2})", "double"), got["price"]),
        "variants": F.when(useful, got["variants"]),
        "rating": either(number("market_rating", r"(?i)([0-9](?:\.[0-9])?)\s*out of 5", "double"), got["rating"]),
        "rating_count": either(number("market_count", "([0-9,]+)", "long"), got["rating_count"]),
    }


def cascade(pages: DataFrame, page: str = "html", url: str = "url", fetched: str | None = None) -> DataFrame:
    """pages with FIELDS, told_by (field to tier), subscription_status, subscription_price, marketplace_region and product_currency.

    fetched names a column of JSON text, if there is one; texts that don't parse tell nothing. The builder tier is asked only where the
    others leave the price or everything else open. Null and empty pages tell what their fetched JSON tells.
    """
    p, u = F.col(page), F.col(url)
    rows = pages.withColumn("_texts", tree_texts(p))
    tiers = {"xhr": fetched_tier(F.try_parse_json(F.col(fetched)))} if fetched else {}
    tiers |= {"json_ld": structured_tier(p), "window": script_tier(p), "dom": dom_tier(F.col("_texts"))}
    struct = lambda tier: F.struct(*[c.alias(f) for f, c in tier.items()])
    rows = rows.withColumns({f"_{name}": struct(tier) for name, tier in tiers.items()})
    reached = lambda names, f: F.coalesce(*[F.col(f"_{n}")[f] for n in names if f in tiers[n]], F.lit(None))
    first = {f: reached(tiers, f) for f in FIELDS}
    told = html.has_min_fields(first["product_description"], first["variants"], first["rating"], first["rating_count"])
    open_ = ~told | F.coalesce(first["product_price"] == 0, F.lit(True))
    rows = rows.withColumn("_page", F.when(open_, p)).withColumn("_cards", builder_cards(F.col("_page"), u))
    tiers["builder"] = builder_tier(F.col("_page"), u, F.col("_texts"), F.col("_cards"))
    rows = rows.withColumn("_builder", F.when(open_, struct(tiers["builder"])))
    source = lambda f: F.coalesce(*[F.when(F.col(f"_{n}")[f].isNotNull(), F.lit(n)) for n in tiers if f in tiers[n]], F.lit(None).cast("string"))
    by = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(f).alias("k"), source(f).alias("v")) for f in FIELDS]), lambda x: x["v"].isNotNull()))
    text = html.visible_text(p, 20000)
    status = F.when(text_or_empty(p) == "", "unknown").otherwise(html.subscription_status(p, text))
    region = marketplace(host(u))
    return rows.select(
        *[F.col(f"`{c}`") for c in pages.columns],
        *[reached(tiers, f).alias(f) for f in FIELDS],
        by.alias("told_by"),
        status.alias("subscription_status"),
        F.when(status != "unknown", html.subscription_price(text)).alias("subscription_price"),
        region["region"].alias("marketplace_region"),
        region["currency"].alias("product_currency"),
    )
