"""Main text of a page by composite text density.

A page becomes a tree of elements.  Scripts, styles, forms, navigation, headers,
footers, sidebars, notices, adverts and comment areas, named by element, role, or a
token of class or id, carry no text; a class or id silences nothing that holds the
page's articles or, with no article beside it, most of the characters outside links.  For every other element the composite density is its
characters per tag, adjusted by the share of link characters and link tags in
it and in the body; inline elements belong to the block around them.  The density sum of a block
is the sum over its blocks and the text directly in it; the element with the largest sum is the core.  The smallest
density on the path from the core to the body is the threshold.  Of every element, on
the path or off it, that reaches the threshold, the element with the largest sum below
it is main text as a whole, and so is text directly in an element that reaches it by
itself; what stays below is dropped.  An article that reaches the threshold is main text as a
whole.  A heading goes with the text that follows it.

The text is decoded, white space inside a block becomes one space, blocks are
trimmed and joined in page order by one space.  Nothing is capped.

Defined results: null and empty pages, and pages without text, give an empty
text; text without any element counts as the body's; unclosed elements and
comments end with the page; repeated rows are treated alike; of elements with
equal sums the first wins; an empty table gives an empty result; extra columns
stay untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare_workers, quoted

# a comment, a declaration, or a tag; quoted attribute values may hold ">"
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: Elements without article text.
SILENT = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea iframe svg canvas"
    " object menu dialog noembed noframes xmp audio video math datalist fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar"
                  " toolbar tablist status".split())
#: Whole tokens of a class or id that name such an area; "_" counts as "-".
AREAS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsors sponsored promo promos"
    " promotion promotions banner cookie cookies consent gdpr notice notices notification alert popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended recommendations sidebar"
    " widget widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer comment comments"
    " commentlist respond replies disqus toolbar"
    # exact compounds
    " ad-banner ad-container ad-slot ad-wrapper google-ad cookie-notice cookie-banner cookie-bar cookie-consent"
    " cookie-popup consent-banner gdpr-banner site-footer page-footer site-nav site-navigation main-nav main-menu"
    " nav-menu nav-bar skip-link comment-list comments-area comments-section comment-form disqus-thread social-links"
    " social-share share-buttons share-bar related-posts related-articles recommended-posts newsletter-signup"
    " newsletter-form login-form signup-form widget-area".split())
#: Tokens that name an area by a part: numbered, placed or typed adverts, comments, sidebars, cookie bars.
AREA_PARTS = re.compile(
    r"(?:ad|ads|advert)-(?:unit|box|slot|space|block|label|area|zone|top|bottom|left|right|side|inline|frame|holder|\d+)"
    r"|[a-z0-9]+-(?:ad|ads|advert)|(?:comments?|cookies?|sidebar)-[a-z0-9-]+|[a-z0-9-]+-(?:comments?|cookies?|sidebar)")
#: Tokens that tell of an area elsewhere on the page.
ABOUT = frozenset("has no with without show hide is".split())
HEADERS = frozenset("header masthead site-header topbar".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul"
    .split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element: tag -> elements ended, looked for up to a border.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
BORDERS = frozenset("ul ol dl table body html article section div main td th select".split())


def _names_area(token: str) -> bool:
    return token in AREAS or AREA_PARTS.fullmatch(token) is not None and token.split("-", 1)[0] not in ABOUT


class Open:
    """The elements that are open, outermost first, and where those of each tag stand among them."""

    def __init__(self, tags: list[str]):
        self.tags, self.nodes = tags, [0]
        self.places: dict[str, list[int]] = {}

    def top(self) -> int:
        return self.nodes[-1]

    def push(self, node: int) -> None:
        self.places.setdefault(self.tags[node], []).append(len(self.nodes))
        self.nodes.append(node)

    def last(self, names: Iterable[str]) -> int:
        """The place of the innermost open element with one of the names; 0 if there is none."""
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=0)

    def cut(self, place: int) -> None:
        """Close the element at a place and all inside it."""
        while len(self.nodes) > place:
            self.places[self.tags[self.nodes.pop()]].pop()


class Page:
    """The tree of a page; children come after their parents in every list."""

    def __init__(self, html: str):
        self.tags, self.parents, self.silent, self.in_link = ["#"], [-1], [False], [False]
        self.texts: list[tuple[int, str]] = []  # (element, text), and (-1, "") for a border of blocks
        self.inside_article = [False]
        self.areas: list[int] = []  # elements named as areas by class or id, judged when the page is read
        self._read(html)
        if self.areas:
            self._silence_areas()

    def _read(self, html: str) -> None:
        stack = Open(self.tags)
        at = 0
        while True:
            found = MARKUP.search(html, at)
            if found is None:
                self._text(stack.top(), html[at:])
                return
            if found.start() > at:
                self._text(stack.top(), html[at:found.start()])
            at = found.end()
            name = found[2] or found[5]
            if not name:
                continue
            name = name.lower()
            if found[1] or found[4]:
                self._close(stack, name)
                continue
            self._open(stack, name, found[3] or found[6] or "")
            if name in RAW:  # no markup in there: straight to the end tag
                end = re.compile(f"</{name}\\b[^>]*>", re.IGNORECASE).search(html, at)
                at = len(html) if end is None else end.end()
                if stack.top() == len(self.tags) - 1:
                    stack.cut(len(stack.nodes) - 1)

    def _text(self, node: int, raw: str) -> None:
        if not self.silent[node]:
            self.texts.append((node, unescape(raw) if "&" in raw else raw))

    def _open(self, stack: Open, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.texts.append((-1, ""))
            if name != "br":
                self._end_open(stack, {"p"}, BORDERS)  # a block ends an open paragraph
        if name in ENDS:
            self._end_open(stack, ENDS[name], frozenset({"ul", "ol", "dl", "table", "select"}))
        parent = stack.top()
        article = self.inside_article[parent]
        silent = self.silent[parent] or name in SILENT or (name == "header" and not article)
        node = len(self.tags)
        if not silent and attributes and name not in ("html", "body", "article", "main"):
            silent, area = self._area(attributes, article, article and name in HEADINGS)
            if area and not silent:
                self.areas.append(node)
        self.tags.append(name)
        self.parents.append(parent)
        self.silent.append(silent)
        self.in_link.append(self.in_link[parent] or name == "a")
        self.inside_article.append(article or name in ("article", "main"))
        if name not in VOID and not attributes.endswith("/"):
            stack.push(node)

    @staticmethod
    def _area(attributes: str, article: bool, title: bool) -> tuple[bool, bool]:
        """Whether an element is silent for certain, and whether a class or id names an area.

        An id of a heading in an article is its anchor and names nothing.
        """
        area = False
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name == "class" or name == "id" and not title:
                tokens = value.lower().replace("_", "-").split()
                area = area or any(_names_area(t) or not article and t in HEADERS for t in tokens)
            if name == "role" and value.lower() in ROLES or name == "hidden" or (
                    name == "aria-hidden" and value.lower() == "true") or (
                    name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE)):
                return True, area
        return False, area

    def _silence_areas(self) -> None:
        """Silence the named areas, but none that holds the page's articles or most of its characters.

        An article or main beside an area shows that the area is not the page's text.
        """
        n = len(self.tags)
        chars, articles, above = [0] * n, [0] * n, [0] * n
        for node, text in self.texts:
            if node >= 0 and not self.in_link[node]:
                chars[node] += len(text.strip())
        for node in range(1, n):
            is_article = self.tags[node] in ("article", "main") and not self.silent[node]
            articles[node] = int(is_article)
            above[node] = above[self.parents[node]] + is_article
        for node in range(n - 1, 0, -1):
            chars[self.parents[node]] += chars[node]
            articles[self.parents[node]] += articles[node]
        for node in self.areas:
            beside = articles[0] - articles[node] - above[node]
            if beside or not articles[node] and 2 * chars[node] <= chars[0]:
                self.silent[node] = True
        for node in range(1, n):
            self.silent[node] = self.silent[node] or self.silent[self.parents[node]]
        self.texts = [(node, text) for node, text in self.texts if node < 0 or not self.silent[node]]

    def _end_open(self, stack: Open, names: set[str], borders: frozenset[str]) -> None:
        place = stack.last(names)
        if place and place >= stack.last(borders - names):
            stack.cut(place)

    def _close(self, stack: Open, name: str) -> None:
        if name in BLOCKS:
            self.texts.append((-1, ""))
        place = stack.last((name,))
        if not place or name in ("body", "html"):  # what follows those still belongs to the body
            return
        if name in BLOCKS or place > stack.last(BORDERS):
            stack.cut(place)

    def densities(self) -> tuple[list[float], list[float], list[int]]:
        """Composite text density of every element, of what is directly in it, and its characters.

        Inline elements belong to the block around them: what is directly in a block is its text outside
        its blocks, with the inline elements there.
        """
        n = len(self.tags)
        chars, linked, tags, links = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text in self.texts:
            if node >= 0 and (size := len(text.strip())):
                chars[node] += size
                linked[node] += size * self.in_link[node]
        own = [[c, lc, 0, 0] for c, lc in zip(chars, linked, strict=True)]
        for node in range(n - 1, 0, -1):
            up = self.parents[node]
            if self.silent[node]:
                continue
            chars[up] += chars[node]
            linked[up] += linked[node]
            tags[up] += tags[node] + 1
            links[up] += links[node] + (self.tags[node] == "a")
            if self.tags[node] not in BLOCKS or self.tags[node] == "br":
                for k, more in enumerate((0, 0, 1, self.tags[node] == "a")):
                    own[up][k] += own[node][k] + more
        share = linked[0] / max(chars[0], 1)

        def density(c: int, link_chars: int, t: int, link_tags: int) -> float:
            if not c:
                return 0.0
            t, lc, lt = max(t, 1), max(link_chars, 1), max(link_tags, 1)
            base = log(c / max(c - link_chars, 1) * lc + share * c + e)
            return c / t * max(log(c / lc * t / lt), 0.0) / log(base)

        out = [0.0 if self.silent[k] else density(chars[k], linked[k], tags[k], links[k]) for k in range(n)]
        return out, [0.0 if self.silent[k] else density(*own[k]) for k in range(n)], chars

    def held(self) -> tuple[list[bool], list[bool]]:
        """Whether an element's whole subtree, and the text directly in it, is main text."""
        density, loose, chars = self.densities()
        n = len(density)
        block = [node == 0 or self.tags[node] in BLOCKS or self.tags[node] in ("html", "body") for node in range(n)]
        around = list(range(n))  # the block that an element stands in
        for node in range(1, n):
            up = self.parents[node]
            around[node] = up if block[up] else around[up]
        sums = [loose[k] if block[k] else 0.0 for k in range(n)]
        for node in range(1, n):
            if block[node]:
                sums[around[node]] += density[node]
        body = self.tags.index("body") if "body" in self.tags else 0
        best = max(range(n), key=lambda node: (sums[node], -node))
        path = [best]
        while path[-1] not in (body, 0):
            path.append(around[path[-1]])
        threshold = min(density[node] for node in path)
        richest = list(range(n))  # the element with the largest sum in each subtree, the first of equals
        for node in range(n - 1, 0, -1):
            up, one = self.parents[node], richest[node]
            if (sums[one], -one) > (sums[richest[up]], -richest[up]):
                richest[up] = one
        whole = [False] * n
        whole[best] = True
        direct = [False] * n
        for node in range(n):
            up = self.parents[node]
            if up >= 0 and (whole[up] or direct[up] and not block[node]):
                whole[node] = True
            if block[node] and not whole[node] and chars[node] and density[node] >= threshold:
                whole[node if self.tags[node] == "article" else richest[node]] = True
            direct[node] = whole[node] or block[node] and loose[node] >= threshold > 0
        return whole, direct

    def text(self) -> str:
        _, direct = self.held()
        titles = [False] * len(self.tags)
        for node in range(1, len(self.tags)):
            titles[node] = titles[self.parents[node]] or self.tags[node] in HEADINGS
        parts, follows = [], False
        for node, text in reversed(self.texts):  # a heading goes with the text that follows it
            if node < 0:
                parts.append(" ")
            elif text.strip():
                if direct[node] or not titles[node]:
                    follows = direct[node]
                parts.append(text if follows else " ")
            else:
                parts.append(text)
        return " ".join("".join(reversed(parts)).split())


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


def extracted(html: Column) -> Column:
    """The main text of every page, Arrow batches."""
    prepare_workers()

    @F.arrow_udf("string")
    def composite_text_density(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(page) for page in pages.to_pylist()], pa.string())

    return composite_text_density(html)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text in place of the page (column ``text``)."""
    rest = [F.col(quoted(c)) for c in pages.columns if c not in (html, text)]
    return pages.select(*rest, extracted(F.col(quoted(html))).alias(text))
