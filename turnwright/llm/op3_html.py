"""HTML extraction by line-block distribution: markup is stripped, text lengths are summed up over sliding windows of lines, and
the text between the points where the sums surge and dive is kept.

A line is a block of the page. Stripping empties the lines of scripts, styles, menus, page headers and footers, sidebars, notices,
adverts, forms and reader comments, told by elements (DROPPED) and by words in class, id and role (NAMES), which count beside words of place
only (BESIDE) and don't strip what is or holds an article or main element. Lines that mostly are links have no length of their own.

The sums of lengths over WINDOW lines surge where text begins and dive to nothing where it ends; a region between is kept if one of its
windows reaches SURGE characters, or a quarter of the page's largest window. Where a page has an article or main element, the lines outside
are empty too, and as nothing but boilerplate may go there, any text makes a window surge: what the windows then tell is which lines of
links belong to the text. One of a single link stays where it stands in a region; rows of links, runs of WINDOW lines of links and those
after the last text (shares, related pages, menus without telling names) go. An article of nothing but links is kept as it is.

Markup is read once from left to right in time proportional to the page's length, whatever is left open in it.

Defined results: a null or empty page has an empty text; unclosed and stray tags are tolerated; a page is read whole whatever its size;
equal pages get equal texts; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from turnwright.llm.clusterio import table
from turnwright.llm.words import slices

WINDOW, SURGE = 3, 80
# Elements without text of their own, elements that are never the article, elements that don't end a line, and void ones.
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea", "title", "head")
DROPPED = ("nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "label", "fieldset", "audio", "video")
INLINE = ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "input")
OUTER = ("article", "main", "body", "html")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
NAMES = (
    "ad", "ads", "advert", "advertisement", "adverts", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "complementary", "consent", "contentinfo", "cookie",
    "cookies", "disclaimer", "disqus", "footer", "form", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "promotion", "related",
    "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toc", "toolbar", "widget",
)
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/<>]*)")
_NAMED_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)(?=[\s/>])")
_STOP = re.compile(r"""[>"']""")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_SPLIT = re.compile(r"[^a-z0-9]+")
#: Words that may stand beside one of NAMES in a class or id ("site-footer", "comment-list"); beside others ("no-sidebar", "category-social") it says something else.
BESIDE = frozenset(NAMES) | {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "global", "header", "inner", "item", "left", "links", "list", "main", "page", "post", "posts", "primary", "right", "secondary", "section", "site", "slot", "top", "unit", "wrap", "wrapper", "", *map(str, range(10))}
# Elements that end where the next of the second ones begins, unless it lies in one of the third ones, or where what holds them ends.
_BLOCKS = ("address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul", "li", "dt", "dd", "search", "summary")
IMPLIED = {"p": (_BLOCKS, ()), "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option", "optgroup"), ())}
# Readers' words, which may be written as articles; what else holds an article or main is never stripped for its name.
_READERS = frozenset(("comment", "comments", "commentlist", "disqus", "related", "replies", "reply", "respond"))
_KEPT = re.compile(r"<(?:article|main)(?=[\s/>])", re.I)


def unwanted(name: str, attributes: str, in_article: bool, holds: Callable[[], bool] = lambda: False) -> bool:
    """Whether an element can't be part of the article. holds: whether it holds an article or main element."""
    if name in DROPPED or name == "header" and not in_article:
        return True
    if not attributes or name in OUTER:
        return False
    if re.search(r"""(?:^|\s)(?:hidden(?=\s|$|=)|aria-hidden\s*=\s*["']?true)""", attributes):
        return True
    tokens = [_SPLIT.split(token) for m in _NAMED.finditer(attributes) for token in (m[1] or m[2] or m[3] or "").lower().split()]
    words = {w for token in tokens for w in token}
    if not in_article and "header" in words and words <= {"header", "site", "page", "top", "main", "global", ""}:
        return not holds()
    named = {w for token in tokens if BESIDE.issuperset(token) for w in token if w in NAMES}
    if in_article and name == "p":
        named.discard("disclaimer")  # a paragraph of the article
    return bool(named) and (in_article or not named.isdisjoint(_READERS) or not holds())


class Markup:
    """Finds a page's tags one by one; what it didn't find once it doesn't look for again."""

    def __init__(self, html: str):
        self.html = html
        self.closer, self.asked = -1, 0  # the first ">" from a place on
        self.no_section_end = False
        self.no_raw_end: set[str] = set()
        self.failed: set[int] = set()  # places outside quotes from which no ">" outside quotes follows
        self.ends: dict[int, int] | None = None
        self.kept = [m.start() for m in _KEPT.finditer(html)]

    def close(self, at: int) -> int:
        """The place after the next ">", or 0."""
        if not self.asked <= at <= self.closer and self.closer < len(self.html):
            found = self.html.find(">", at)
            self.asked, self.closer = at, found if found >= 0 else len(self.html)
        return 0 if self.closer >= len(self.html) else self.closer + 1

    def tag_end(self, at: int) -> int:
        """The place after the ">" that ends a tag, outside quotes if there is one, else the next; or 0."""
        plain, passed, k = self.close(at), [], at
        while plain:
            m = _STOP.search(self.html, k)
            if not m:
                break
            if m[0] == ">":
                return m.end()
            k = self.html.find(m[0], m.end()) + 1
            if not k or k in self.failed:
                break
            passed.append(k)
        self.failed.update(passed)
        return plain

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Of the next tag or comment: begin, end, whether it closes, name (none: no element), attributes."""
        html = self.html
        while (begin := html.find("<", at)) >= 0:
            at = begin + 1
            if html.startswith(("!", "?"), at):
                if html.startswith("!--", at):
                    end = html.find("-->", at + 3)
                    return begin, end + 3 if end >= 0 else len(html), False, "", ""
                if html.startswith("![CDATA[", at) and not self.no_section_end:
                    end = html.find("]]>", at)
                    if end >= 0:
                        return begin, end + 3, False, "", ""
                    self.no_section_end = True
                end = self.close(at)
                if end:
                    return begin, end, False, "", ""
            elif m := _NAME.match(html, at):
                end = self.tag_end(m.end())
                if end:
                    return begin, end, bool(m[1]), m[2].lower(), html[m.end() : end - 1]
        return None

    def raw_end(self, name: str, at: int) -> int:
        """Where what follows such an element begins, or 0."""
        m = None if name in self.no_raw_end else _RAW_END[name].search(self.html, at)
        if not m:
            self.no_raw_end.add(name)
        return m.end() if m else 0

    def holds(self, begin: int, name: str) -> bool:
        """Whether the element whose tag begins at a place has an article or main element before its end; what never ends holds nothing for sure."""
        k = bisect_left(self.kept, begin + 1)
        if k == len(self.kept) or name in ("p", "dt", "option", *VOID):
            return False
        if self.ends is None:
            self.ends, opened = {}, {}
            for m in _NAMED_TAG.finditer(self.html):
                stack = opened.setdefault(m[2].lower(), [])
                if not m[1]:
                    stack.append(m.start())
                elif stack:
                    self.ends[stack.pop()] = m.start()
        return self.ends.get(begin, 0) > self.kept[k]


class Page:
    """Lines of a page: text, characters in links, number of links, and whether they lie in an article or main element; gaps for what was stripped."""

    def __init__(self, html: str):
        self.lines: list[tuple[str, int, int, int]] = []
        self.text: list[str] = []
        self.linked, self.links, self.anchors, self.articles, self.mains = 0, 0, 0, 0, 0
        skip, depth, inner, at = "", 0, 0, 0
        opened: dict[str, int] = {}
        markup = Markup(html)
        while True:
            tag = markup.next(at)
            if not skip:
                self.add(html[at : tag[0] if tag else len(html)])
            if not tag:
                break
            begin, at, close, name, attributes = tag
            if not name:
                continue
            if name in RAW and not close and not attributes.endswith("/"):
                end = markup.raw_end(name, at)
                at = end or (at if name == "head" else len(html))
                continue
            if skip in IMPLIED:
                nexts, lists = IMPLIED[skip]
                if close and name == skip and not depth:
                    skip = ""
                    continue
                if name in INLINE or name in VOID and name not in nexts:
                    continue
                if name in nexts and not close and not depth:
                    skip = ""  # its end is implied by the next one
                elif name in lists and not close:
                    depth += 1
                    continue
                elif name in lists and depth:
                    depth -= 1
                    continue
                elif close and opened.get(name, 0) <= 0 and (name not in IMPLIED or not depth and name != "p"):
                    skip = ""  # or by the end of what holds it
                else:
                    opened[name] = opened.get(name, 0) + (-1 if close else 1)
                    continue
            elif skip:
                if name == skip:
                    depth += -1 if close else 1
                    skip = skip if depth else ""
                    continue
                if name not in OUTER:
                    continue
                inner += -1 if close else 1
                if inner >= 0:
                    continue
                skip = ""  # what was stripped never ended, but what holds it does
            if name not in INLINE:
                self.end()
            if close:
                self.links -= name == "a" and self.links > 0
                self.articles -= name == "article" and self.articles > 0
                self.mains -= name == "main" and self.mains > 0
            elif unwanted(name, attributes, self.articles > 0, lambda: markup.holds(begin, name)):
                self.end()
                self.lines.append(("", 0, 0, 0))
                if name not in VOID and not attributes.endswith("/"):
                    skip, depth, inner, opened = name, int(name not in IMPLIED), 0, {}
            else:
                self.links += name == "a"
                self.anchors += name == "a"
                self.articles += name == "article"
                self.mains += name == "main"
        self.end()

    def add(self, text: str) -> None:
        if text:
            self.text.append(text)
            self.linked += len(text) if self.links else 0

    def end(self) -> None:
        text = " ".join(unescape("".join(self.text)).split())
        if text:
            self.lines.append((text, self.linked, self.anchors, 2 * (self.articles > 0) + (self.mains > 0)))
        self.text, self.linked, self.links, self.anchors = [], 0, 0, 0


def windows(lengths: list[int], size: int = WINDOW) -> list[int]:
    """Of each line, the sum of its length and those of the next lines."""
    out, total = [0] * len(lengths), 0
    for k in range(len(lengths) - 1, -1, -1):
        total += lengths[k] - (lengths[k + size] if k + size < len(lengths) else 0)
        out[k] = total
    return out


def main_text(html: str | None) -> str:
    lines = Page(html or "").lines
    own = [len(t) if 2 * linked <= len(t) else 0 for t, linked, _, _ in lines]
    inside, stays = [place > 0 for *_, place in lines], [False] * len(lines)
    surge = 1
    if any(t and place for t, _, _, place in lines):
        # a main element with articles is taken whole; of others, the one with more text in a window
        articles = [n if place & 2 else 0 for n, (*_, place) in zip(own, lines, strict=True)]
        rest = [n if place == 1 else 0 for n, (*_, place) in zip(own, lines, strict=True)]
        if any(place == 3 for *_, place in lines):
            lengths = [a or r for a, r in zip(articles, rest, strict=True)]
        elif max(windows(rest), default=0) > max(windows(articles), default=0):
            lengths, inside = rest, [place == 1 for *_, place in lines]
        else:
            lengths, inside = articles, [place >= 2 for *_, place in lines] if any(articles) else inside
        if any(lengths):
            stays = [i and bool(t) and count == 1 for i, (t, _, count, _) in zip(inside, lines, strict=True)]
        else:
            lengths = [len(t) if i else 0 for i, (t, *_) in zip(inside, lines, strict=True)]
    else:
        lengths = own
        surge = min(SURGE, max(windows(lengths), default=0) / 4)
    sums, kept, k, first = windows(lengths), [], 0, inside.index(True) if True in inside else -1
    while k < len(lengths):
        dive = k
        while dive < len(lengths) and sums[dive]:
            dive += 1
        if dive > k and max(sums[k:dive]) >= surge:
            text = next(j for j in range(k, dive) if lengths[j])  # links before it are a run of WINDOW lines, but where the article begins
            kept += [lines[j][0] for j in range(k if k <= first else text, dive) if lengths[j] or stays[j]]
        k = max(dive, k + 1)
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
