"""What needs a page's element tree: offer cards. Parsed in Arrow batches; the offers themselves are columns."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F

from admill.functions import html

#: Parts of class names that offer cards carry, elements without an end tag, and unread ones.
CARD_CLASSES = ["offer", "tier", "bundle", "pricing", "plan", "package"]
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
UNREAD = {"script", "style", "svg", "noscript", "iframe"}


class CardTexts(HTMLParser):
    """Collects the texts of elements whose class names a card; broken nesting closes what it must."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str] | None, bool]] = []
        self.cards: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        names = (dict(attrs).get("class") or "").lower()
        self.open.append((tag, [] if any(c in names for c in CARD_CLASSES) else None, tag in UNREAD))

    def handle_endtag(self, tag):
        if all(t != tag for t, _, _ in self.open):
            return
        while True:
            t, text, _ = self.open.pop()
            if text is not None:
                self.cards.append(" ".join(" ".join(text).split()))
            if t == tag:
                return

    def handle_data(self, data):
        if not any(unread for _, _, unread in self.open):
            for _, text, _ in self.open:
                if text is not None:
                    text.append(data)

    def close(self):
        super().close()
        for _, text, _ in self.open:
            if text is not None:
                self.cards.append(" ".join(" ".join(text).split()))


def card_texts(page: str | None) -> list[str]:
    parser = CardTexts()
    parser.feed(page or "")
    parser.close()
    return list(dict.fromkeys(t for t in parser.cards if t))


def _texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([card_texts(x) for x in batch])


def offers(page: Column) -> Column:
    """The offers of a page's cards: texts with one quantity and a price, each text once. Pages without card classes aren't parsed."""
    likely = page.rlike(r"(?i)class=[^>]*(" + "|".join(CARD_CLASSES) + ")")
    texts = F.pandas_udf(_texts, "array<string>")(F.when(likely, page))
    single = F.filter(texts, lambda t: F.regexp_count(t, F.lit(html.QUANTITY)) == 1)
    return F.filter(F.transform(single, lambda t: html.offer(t)), lambda o: o.isNotNull())


def product(page: Column) -> Column:
    """(name, brand, price, currency, rating, rating_count): JSON-LD first, then OpenGraph, then the visible text."""
    ld, text = html.product_of(html.json_ld(page)), html.visible_text(page)
    graph_price = html.open_graph(page, "price:amount").try_cast("double")
    return F.struct(
        F.coalesce(ld["name"], html.open_graph(page, "title")).alias("name"),
        F.coalesce(ld["brand"], html.open_graph(page, "site_name")).alias("brand"),
        F.coalesce(ld["price"], graph_price).alias("price"),
        F.coalesce(ld["currency"], html.open_graph(page, "price:currency")).alias("currency"),
        F.coalesce(ld["rating"], html.star_rating(text)).alias("rating"),
        F.coalesce(ld["rating_count"], html.review_count(text)).alias("rating_count"),
    )
