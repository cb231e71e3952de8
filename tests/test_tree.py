"""Zones and Markdown of pages against nested nodes walked plainly, and literal pages."""

from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from admill.functions import tree


class Node:
    def __init__(self, tag, attrs, up):
        self.tag, self.attrs, self.up, self.kids = tag, attrs, up, []

    def walk(self):
        for k in self.kids:
            if isinstance(k, Node):
                yield k
                yield from k.walk()

    def texts(self):
        if self.tag in tree.NOT_TEXT:
            return []
        out = []
        for k in self.kids:
            out += k.texts() if isinstance(k, Node) else [k.strip()]
        return [t for t in out if t]

    def text(self):
        return " ".join(self.texts())

    def line(self):
        out = [self]
        while out[-1].up is not None:
            out.append(out[-1].up)
        return out


class Nested(HTMLParser):
    def __init__(self, page):
        super().__init__()
        self.root = self.at = Node("[document]", {}, None)
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(node)
        if tag not in tree.VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        match = next((n for n in self.at.line() if n.tag == tag), None)
        if match is not None and tag not in tree.VOID:
            self.at = match.up

    def handle_data(self, data):
        if self.at.kids and isinstance(self.at.kids[-1], str):
            self.at.kids[-1] += data
        else:
            self.at.kids.append(data)


def plain_zones(page):
    """Texts of hero, social proof and specs."""
    root = Nested(page).root
    body = next((n for n in root.walk() if n.tag == "body"), root)
    all_of = list(body.walk())
    near = lambda n, p: any(p.search(f"{m.attrs.get('id', '')} {m.attrs.get('class', '')}") for m in n.line()[:6])
    hidden = lambda n: any(tree.HIDDEN.search(m.attrs.get("style", "")) for m in n.line()[:6])
    hero = [n.up for n in all_of if n.tag == "form" and "/cart" in n.attrs.get("action", "") and not near(n, tree.DRAWER) and not hidden(n) and not tree.CHECKOUT.search(n.up.text()[:500])]
    hero = hero or [n for n in all_of if "offer-grid" in n.attrs.get("class", "")]
    if not hero:
        content = [n for n in all_of if not any(m.tag in tree.FRAMES for m in n.line()[1:])]
        scored = []
        for i, n in enumerate(content[: max(1, int(len(content) * 0.4))]):
            t = n.text()
            if n.tag in tree.HERO_TAGS and 0 < len(t) < 300 and tree.CURRENCY.search(t) and not tree.SHIPPING.search(t) and not hidden(n) and not any(near(n, p) for p in (tree.BANNER, tree.CART_WIDGET, tree.DRAWER)):
                wide = n.up.tag not in ("body", "html") and len(n.up.text()) < 2000
                scored.append((-bool(tree.PURCHASE.search(t)), i, n.up if wide else n))
        hero = [min(scored, key=lambda s: s[:2])[2]] if scored else []
    proof = [n for n in all_of if n.tag in ("section", "div") and 0 < len(n.text()) < 2000 and tree.PROOF.search(n.text())]
    specs = [n for n in all_of if n.tag == "ul" and sum(isinstance(k, Node) and k.tag == "li" for k in n.kids) >= 2]
    return [x[0].text() if x else None for x in (hero, proof, specs)]


def found_texts(page):
    e = tree.Elements(page)
    return [None if i is None else e.text(i) for i in (f(e, e.body()) for f in (tree.hero, tree.social_proof, tree.specs))]


FILL = "".join(f"<p>A paragraph, the {i}th, about nothing that is sold.</p>" for i in range(12))
DRAWER = '<div id="CartDrawer" class="drawer right"><form action="/cart"><button>Update</button></form></div>'
FORM = '<product-form><form action="/cart/add"><span>$59.95</span><button>Add</button></form></product-form>'
PAGES = {
    "form": ("<body><div id=a><h1>Beet $39.95</h1><form action='/cart/add'><button>Add to cart</button></form></div></body>", "Beet $39.95"),
    "drawer": (f"<body>{DRAWER}{FORM}</body>", "$59.95"),
    "hidden": (f'<body><div style="DISPLAY : none"><form action="/cart/add">$1.00</form></div>{FORM}</body>', "$59.95"),
    "checkout": (f'<body><div>View Cart <form action="/gp/cart/go"><button>Proceed to checkout</button></form></div>{FORM}</body>', "$59.95"),
    "grid": ('<body><div class="x main-offer-grid"><p>1 bottle $19</p></div></body>', "$19"),
    "heading": (f'<body><span class="tag">$49.95</span>{FILL}</body>', "49.95"),
    "nav": (f"<body><nav>{'<a href=x>link</a>' * 100}</nav><main><div>Only $49.95 today</div>{FILL}</main></body>", "$49.95"),
    "banner": (f'<body><div class="announcement-bar">Over $50 sent for nothing</div><main><div>Only $39.95, buy now</div>{FILL}</main></body>', "39.95"),
    "shipping": (f"<body><div>Free shipping on orders over $50</div><main><div>Only $39.95, buy now</div>{FILL}</main></body>", "39.95"),
    "rhetoric": (f"<body><p>They ask $1,029 a month.</p><main><div>Buy now for $59</div>{FILL}</main></body>", "$59"),
    "subtotal": (f'<body><div class="cart__item-sub"><div class="ajaxcart__subtotal">Sum</div><div>$0.00</div></div><main><div>Buy now for $44.99</div>{FILL}</main></body>', "44.99"),
    "drawer price": (f'<body><div class="cart-drawer"><p>Buy for $2</p></div><main><div>Buy now for $44.99</div>{FILL}</main></body>', "44.99"),
    "no body": ("<p>Buy two for $9<p>More", "$9"),
    "broken": ("<body><div><p>Save $5<b>now</div></p></i><span>tail</body>", "$5"),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_hero(name):
    page, price = PAGES[name]
    hero = found_texts(page)[0]
    assert price in hero and found_texts(page) == plain_zones(page)
    assert not any(x in hero for x in ("Update", "Proceed", "1,029", "$0.00", "$2 ", "shipping", "sent for nothing"))


def test_no_zones():
    assert found_texts("<body><p>Plain words.</p></body>") == [None] * 3
    assert found_texts("") == found_texts(None) == [None] * 3
    assert tree.zone_rows(None)[3:] == ("", False, None)


def test_lists_need_items_of_their_own():
    e = found_texts("<body><ul><li><ul><li>a</li><li>b</li></ul></li></ul><ul><li>c</li><li>d</li></ul></body>")
    assert e[2] == "a b"


def test_markdown():
    page = "<body><h2>Head &amp; line</h2><p>One <b>two </b> three<br>four</p><ul><li>a</li><li>b<ol><li>c</li></ol></li></ul><blockquote><p>said</p></blockquote><table><tr><th>k</th><th>v</th></tr><tr><td>1</td><td>2</td></tr></table><hr><script>no()</script><pre>x\n  y</pre><a href=u>link</a><img src=i></body>"
    e = tree.Elements(page)
    assert tree.Markdown(e, tree.SILENT).write(e.body()) == "## Head & line\n\nOne **two** three  \nfour\n\n  * a\n  * b\n    1. c\n\n> said\n\nk | v\n1 | 2\n\n* * *\n\nx\n  y\n\nlink"


def test_markup_reads_back():
    page = '<body><div class="a  b" data-x=\'1 "2"\' hidden>1 &lt; 2<!--c--><br><script>if (a<b) {}</script></div></body>'
    e = tree.Elements(page)
    assert e.markup(2) == '<div class="a b" data-x="1 &quot;2&quot;" hidden="">1 &lt; 2<!--c--><br/><script>if (a<b) {}</script></div>'
    assert tree.Elements(e.markup(2)).markup(1) == e.markup(2)


def test_deep_and_long_pages_take_linear_time():
    assert tree.Elements("<p>" * 50_000 + "$5 buy").length(1) == 6
    assert tree.zone_rows("<div>" * 3000 + "word " * 300_000)[0] is None


def test_all_pages(spark, tiny):
    pages = spark.read.parquet(f"{tiny.replace('sf0.001', 'sf0.01')}/pages.parquet")
    for r in pages.collect():
        assert found_texts(r["html"]) == plain_zones(r["html"])
    shop = pages.select("page_id", F.concat(F.lit("<div class='hero'><h1>Save $"), "page_id", F.lit("</h1>"), "html", F.lit("</div>")).alias("html"), F.lit(1).alias("z"))
    zoned = shop.select("page_id", "html", tree.zones(F.col("html")).alias("f")).withColumn("p", tree.pruned(F.col("f"), 100))
    for r in zoned.collect():
        e = tree.Elements(r["html"])
        hero, proof, specs = plain_zones(r["html"])
        for zone, text in (("hero", hero), ("social_proof", proof), ("specs", specs)):
            assert (r["f"][zone] is None) == (text is None) and (text is None or tree.Elements(r["f"][zone]).text(0) == text)
        assert r["f"]["title"] == next((e.text(i) for i, t in enumerate(e.tag) if t == "title"), None)
        assert len(r["p"]) <= (400 if r["f"]["from_zones"] else 800) + 220


class Paragraphs(HTMLParser):
    """Closed paragraphs as they end, by plain events; a paragraph that starts another is given up."""

    def __init__(self, page):
        super().__init__()
        self.at, self.found = None, []
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        if tag in tree.PARAGRAPHS:
            self.at = [tag, ""]
        elif tag == "br" and self.at:
            self.at[1] += "\n"

    def handle_endtag(self, tag):
        if self.at and self.at[0] == tag:
            text = "\n".join(" ".join(x.split()) for x in self.at[1].split("\n")).strip()
            self.found += [(tag, text)] if text else []
            self.at = None

    def handle_data(self, data):
        if self.at:
            self.at[1] += data


def test_block_runs(spark, tiny):
    block = '<p style="COLOR: #fff; text-align:center">Big <b>sale</b><br/>now</p><h2><i>Half</i>  price</h2><p style="display:none">A dog.</p><img alt=" "><img alt="Dog"><p>open<p> </p><p style="display:none">It runs.</p>'
    runs, alt, told = tree.block_content(block)
    assert [tuple(r.values()) for r in runs] == [("Big sale\nnow", "p", "#fff", "center", True, False), ("Half price", "h2", None, None, False, True)]
    assert (alt, told) == ("Dog", "A dog. It runs.") and tree.block_content(None) == ([], None, None)
    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    for r in pages.select("html", tree.block_runs(F.col("html")).alias("b")).collect():
        assert [(x["tag"], x["text"]) for x in r["b"]["runs"]] == Paragraphs(r["html"]).found
