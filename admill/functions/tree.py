"""Zones of product pages by element tree: hero, social proof and specs, pruned to Markdown.

A page is parsed once, in Arrow batches, into its elements in document order. Every element knows its parent, the
stretch of strings and of markup below it, so text lengths are differences and a rule looks at each element once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, functions as F

from admill.functions.text import cut_at_paragraph

# Elements without an end tag, those whose text isn't the page's, and those that only frame a page.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NOT_TEXT = {"script", "style", "template"}
UNREAD = {"script", "style", "svg", "noscript", "iframe"}
FRAMES = {"nav", "header", "footer", "aside"}
HERO_TAGS = {"h1", "h2", "h3", "h4", "div", "span", "p"}

# What marks an offer, what only looks like one, and where zones end.
CURRENCY = re.compile(r"[$€£]\s?\d")
PROOF = re.compile(r"reviews?|ratings?|\d+\s*stars", re.I)
DRAWER = re.compile(r"drawer", re.I)
BANNER = re.compile(r"announcement|topbar|top-bar|above-header|promo-bar|header-group", re.I)
CART_WIDGET = re.compile(r"subtotal|ajaxcart|minicart|cart__item", re.I)
SHIPPING = re.compile(r"free\s+shipping|shipping\s+on|orders?\s+over|spend\s+\$", re.I)
PURCHASE = re.compile(r"buy|order|bottle|add\s+to\s+cart|subscribe|one[- ]time|per\s+bottle|/\s*mo\b|save|\boff\b|checkout", re.I)
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
CHECKOUT = re.compile(r"proceed to checkout|view cart\b|choose how often|delivery frequency|potential.{0,20}savings", re.I)
TOP_SHARE, NEAR, SHORT, WIDE, WIDGET, HERO_LEAST, TOKEN_CHARS = 0.4, 6, 300, 2000, 500, 100, 4


class Elements(HTMLParser):
    """Elements of a page in document order; number 0 stands for the page. An end tag closes all that was opened since its start tag; without one it is ignored."""

    def __init__(self, page: str | None):
        super().__init__(convert_charrefs=True)
        self.tag, self.attrs, self.parent, self.framed = ["[document]"], [{}], [-1], [False]
        self.last, self.text_span, self.mark_span = [0], [[0, 0]], [[0, 0]]
        self.strings: list[str] = []
        self.marks: list[tuple[str, object]] = []
        self.closed: set[int] = set()  # elements with an end tag of their own
        self._open, self._counts, self._data = [0], {}, []
        self.feed(page or "")
        self.close()
        self._flush()
        while self._open:
            self._end()
        self._sums = [0, *accumulate(map(len, self.strings))]

    def _flush(self) -> None:
        data = "".join(self._data)
        self._data = []
        if not data:
            return
        keeps = any(self._counts.get(t) for t in ("pre", "textarea"))
        if not keeps and not data.strip("\n\t\r\f\x0b "):
            data = "\n" if "\n" in data else " "
        self.marks.append(("text", data))
        if (stripped := data.strip()) and not any(self._counts.get(t) for t in NOT_TEXT):
            self.strings.append(stripped)

    def _end(self) -> None:
        i = self._open.pop()
        self._counts[self.tag[i]] = self._counts.get(self.tag[i], 1) - 1
        if i:
            self.marks.append(("end", self.tag[i]))
        self.last[i], self.text_span[i][1], self.mark_span[i][1] = len(self.tag), len(self.strings), len(self.marks)

    def handle_starttag(self, tag, attrs):
        self._flush()
        held = {k: v or "" for k, v in attrs}
        if "class" in held:
            held["class"] = " ".join(held["class"].split())
        parent = self._open[-1]
        self.parent.append(parent)
        self.framed.append(self.framed[parent] or self.tag[parent] in FRAMES)
        self.tag.append(tag)
        self.attrs.append(held)
        self.last.append(0)
        self.text_span.append([len(self.strings), 0])
        self.mark_span.append([len(self.marks), 0])
        self.marks.append(("start", len(self.tag) - 1))
        self._open.append(len(self.tag) - 1)
        self._counts[tag] = self._counts.get(tag, 0) + 1
        if tag in VOID:
            self._end()

    def handle_endtag(self, tag):
        self._flush()
        if tag in VOID or not self._counts.get(tag, 0) > 0:
            return
        while self.tag[self._open[-1]] != tag:
            self._end()
        self.closed.add(self._open[-1])
        self._end()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_data(self, data):
        self._data.append(data)

    def handle_comment(self, data):
        self._flush()
        self.marks.append(("comment", data))

    def below(self, i: int, tags: set[str] | None = None) -> list[int]:
        return [j for j in range(i + 1, self.last[i]) if tags is None or self.tag[j] in tags]

    def length(self, i: int) -> int:
        """Length of text(i)."""
        a, b = self.text_span[i]
        return self._sums[b] - self._sums[a] + max(0, b - a - 1)

    def text(self, i: int) -> str:
        """Strings below an element, trimmed and joined by spaces."""
        return " ".join(self.strings[slice(*self.text_span[i])])

    def near(self, i: int) -> Iterator[int]:
        """An element and the ancestors next to it."""
        for _ in range(NEAR):
            if i < 0:
                return
            yield i
            i = self.parent[i]

    def named(self, i: int, pattern: re.Pattern) -> bool:
        return any(pattern.search(f"{self.attrs[j].get('id', '')} {self.attrs[j].get('class', '')}") for j in self.near(i))

    def hidden(self, i: int) -> bool:
        return any(HIDDEN.search(self.attrs[j].get("style", "")) for j in self.near(i))

    def body(self) -> int:
        return next((i for i, t in enumerate(self.tag) if t == "body"), 0)

    def markup(self, i: int) -> str:
        """An element as HTML, its attributes quoted and its end tags written."""
        out, raw = [], 0
        for kind, value in self.marks[slice(*self.mark_span[i])]:
            if kind == "start":
                tag = self.tag[value]
                raw += tag in ("script", "style")
                held = "".join(f' {k}="{escape(v)}"' for k, v in self.attrs[value].items())
                out.append(f"<{tag}{held}{'/' if tag in VOID else ''}>")
            elif kind == "end":
                raw -= value in ("script", "style")
                out.append("" if value in VOID else f"</{value}>")
            elif kind == "comment":
                out.append(f"<!--{value}-->")
            else:
                out.append(value if raw else escape(value, quote=False))
        return "".join(out)


def cart_form(e: Elements, body: int) -> int | None:
    """What holds the first visible cart form outside of drawers and checkouts."""
    for i in e.below(body, {"form"}):
        if "/cart" in e.attrs[i].get("action", "") and not e.named(i, DRAWER) and not e.hidden(i):
            around = max(e.parent[i], 0)
            if not CHECKOUT.search(e.text(around)[:WIDGET]):
                return around
    return None


def priced(e: Elements, body: int) -> int | None:
    """The likeliest short element with a price in the page's upper part, widened to its parent; the first of equals."""
    content = [i for i in e.below(body) if not e.framed[i]]
    best, found = 0, None
    for i in content[: max(1, int(len(content) * TOP_SHARE))]:
        if e.tag[i] not in HERO_TAGS or not 0 < e.length(i) < SHORT:
            continue
        text = e.text(i)
        if not CURRENCY.search(text) or SHIPPING.search(text) or e.hidden(i) or any(e.named(i, p) for p in (BANNER, CART_WIDGET, DRAWER)):
            continue
        score = 2 if PURCHASE.search(text) else 1
        if score > best:
            up = e.parent[i]
            best, found = score, up if e.tag[up] not in ("body", "html") and e.length(up) < WIDE else i
    return found


def hero(e: Elements, body: int) -> int | None:
    if (found := cart_form(e, body)) is not None:
        return found
    grid = next((i for i in e.below(body) if "offer-grid" in e.attrs[i].get("class", "")), None)
    return priced(e, body) if grid is None else grid


def social_proof(e: Elements, body: int) -> int | None:
    return next((i for i in e.below(body, {"section", "div"}) if 0 < e.length(i) < WIDE and PROOF.search(e.text(i))), None)


def specs(e: Elements, body: int) -> int | None:
    """The first list with two or more items of its own."""
    items: dict[int, int] = {}
    for i in e.below(body, {"li"}):
        items[e.parent[i]] = items.get(e.parent[i], 0) + 1
    return next((i for i in e.below(body, {"ul"}) if items.get(i, 0) >= 2), None)


HEADINGS = {f"h{n}": "#" * n + " " for n in range(1, 7)}
BLOCKS = {"p", "div", "section", "article", "main", "form", "ul", "ol", "table", "tr", "header", "footer", "nav", "aside", "dl", "dt", "dd", "figure", "address", "fieldset", "body", "html"} | set(HEADINGS)
SIGNS = {"b": "**", "strong": "**", "i": "_", "em": "_", "u": "_", "code": "`"}
SILENT = {"script", "style", "head", "title", "template"}


class Markdown:
    """Writes marks of an element as Markdown: headings, paragraphs, lists, quotes, tables, emphasis; no links or images."""

    def __init__(self, e: Elements, skip: set[str]):
        self.e, self.skip = e, skip
        self.lines: list[str] = []
        self.line, self.lead = [], ""
        self.lists: list[int | None] = []
        self.quotes = self.quiet = self.pre = 0

    def cut(self, blank: bool = True) -> None:
        text = "".join(self.line) if self.pre else re.sub(r"[ \t]*\n[ \t]*", "\n", re.sub(r"[ \t]+", " ", "".join(self.line))).strip().replace("\n", "  \n")
        if text.strip():
            self.lines.append("> " * self.quotes + self.lead + text)
            self.lead = ""
        self.line = []
        if blank and self.lines and self.lines[-1]:
            self.lines.append("")

    def start(self, i: int) -> None:
        tag = self.e.tag[i]
        self.quiet += tag in self.skip
        if self.quiet:
            return
        if tag == "br":
            self.line.append("\n")
        elif tag == "hr":
            self.cut()
            self.lines += ["* * *", ""]
        elif tag in SIGNS:
            self.line.append(SIGNS[tag])
        elif tag == "li":
            self.cut(blank=False)
            depth = max(1, len(self.lists))
            if self.lists and self.lists[-1] is not None:
                self.lists[-1] += 1
            self.lead = "  " * depth + (f"{self.lists[-1]}. " if self.lists and self.lists[-1] is not None else "* ")
        elif tag in ("td", "th"):
            if "".join(self.line).strip():
                self.line.append(" | ")
        elif tag in BLOCKS or tag in ("pre", "blockquote"):
            self.cut(blank=tag != "tr" and not (tag in ("ul", "ol") and self.lists) and not self.lead)
            if tag in ("ul", "ol"):
                self.lists.append(0 if tag == "ol" else None)
            self.pre += tag == "pre"
            self.quotes += tag == "blockquote"
            self.lead = HEADINGS.get(tag, self.lead)

    def end(self, tag: str) -> None:
        if self.quiet:
            self.quiet -= tag in self.skip
        elif tag in SIGNS:
            tail = ""
            while self.line and not self.line[-1].strip(" "):  # a sign stands next to its word
                tail = self.line.pop() + tail
            last = self.line.pop() if self.line else ""
            word = last.rstrip(" ")
            self.line += [last[len(word) :] + tail] if word == SIGNS[tag] else [word, SIGNS[tag], last[len(word) :] + tail]
        elif tag == "li":
            self.cut(blank=False)
            self.lead = ""
        elif tag in BLOCKS or tag in ("pre", "blockquote"):
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()
            self.cut(blank=not self.lists and tag != "tr" or tag in HEADINGS)
            self.pre -= tag == "pre"
            self.quotes -= tag == "blockquote"
            self.lead = "" if tag in HEADINGS else self.lead

    def write(self, i: int) -> str:
        for kind, value in self.e.marks[slice(*self.e.mark_span[i])]:
            if kind == "start":
                self.start(value)
            elif kind == "end":
                self.end(value)
            elif kind == "text" and not self.quiet:
                self.line.append(value if self.pre else re.sub(r"\s+", " ", value))
        self.cut()
        return "\n".join(self.lines).strip()


def zone_rows(page: str | None) -> tuple[str | None, str | None, str | None, str, bool, str | None]:
    """Markup of the three zones, the page's Markdown, whether that comes from the zones, and its title."""
    e = Elements(page)
    body = e.body()
    found = [f(e, body) for f in (hero, social_proof, specs)]
    zoned = "\n\n".join(m for m in (Markdown(e, SILENT).write(i) for i in found if i is not None) if m) if found[0] is not None else ""
    enough = len(zoned) >= HERO_LEAST
    markdown = zoned if enough else Markdown(e, SILENT | UNREAD).write(body)
    title = next((i for i, t in enumerate(e.tag) if t == "title"), None)
    name = None if title is None else e.text(title)
    return (*(None if i is None else e.markup(i) for i in found), markdown, enough, name or None)


def _zones(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([zone_rows(x) for x in batch], columns=["hero", "social_proof", "specs", "markdown", "from_zones", "title"])


def zones(page: Column) -> Column:
    """Struct of hero, social_proof and specs (markup, null where there is none), markdown, from_zones and title. Null pages have no zones."""
    return F.pandas_udf(_zones, "hero string, social_proof string, specs string, markdown string, from_zones boolean, title string")(page)


def pruned(found: Column, most_tokens: int = 4000) -> Column:
    """Title and Markdown of zones() for a language model, cut at a paragraph; a whole page gets twice the budget of zones."""
    budget = most_tokens * TOKEN_CHARS
    text = F.when(found["from_zones"], cut_at_paragraph(found["markdown"], budget)).otherwise(cut_at_paragraph(found["markdown"], 2 * budget))
    return F.concat(F.when(found["title"].isNotNull(), F.concat(F.lit("Page title: "), F.substring(found["title"], 1, 200), F.lit("\n\n"))).otherwise(""), text)


# Elements that hold a block's paragraphs, and their emphasis.
PARAGRAPHS = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
BOLD, ITALIC = {"b", "strong"}, {"i", "em"}


def style_of(declared: str | None) -> dict[str, str]:
    """Declarations of an inline style; names in lower case, the last of equals counts."""
    pairs = [d.partition(":") for d in (declared or "").split(";") if ":" in d]
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def block_content(block: str | None) -> tuple[list[dict], str | None, str | None]:
    """Visible runs of a block's HTML, its first image's alt text, and the text of its hidden paragraphs.

    A run is the text of a closed paragraph that holds no other, lines kept where br breaks them.
    """
    e = Elements(block)
    runs, told = [], []
    for i in e.below(0, PARAGRAPHS):
        inner = {e.tag[j] for j in e.below(i)}
        if i not in e.closed or inner & PARAGRAPHS:
            continue
        parts = [v if kind == "text" else "\n" for kind, v in e.marks[slice(*e.mark_span[i])] if kind == "text" or (kind == "start" and e.tag[v] == "br")]
        text = "\n".join(" ".join(line.split()) for line in "".join(parts).split("\n")).strip()
        style = style_of(e.attrs[i].get("style"))
        if text and style.get("display") == "none":
            told.append(text)
        elif text:
            runs.append({"text": text, "tag": e.tag[i], "color": style.get("color"), "text_align": style.get("text-align"), "bold": bool(inner & BOLD), "italic": bool(inner & ITALIC)})
    alts = (e.attrs[i].get("alt", "").strip() for i in e.below(0, {"img"}))
    return runs, next((a for a in alts if a), None), " ".join(told) or None


RUNS = "array<struct<text: string, tag: string, color: string, text_align: string, bold: boolean, italic: boolean>>"


def _blocks(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([block_content(x) for x in batch], columns=["runs", "image_alt", "image_description"])


def block_runs(block: Column) -> Column:
    """Struct of runs, image_alt and image_description of a block's HTML."""
    return F.pandas_udf(_blocks, f"runs {RUNS}, image_alt string, image_description string")(block)
