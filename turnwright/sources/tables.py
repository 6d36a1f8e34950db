"""Table functions over whole pages and caption files, for what patterns can't tell: attributes in any order and quotes, character references, nested elements.

Each parses one text as it is read and gives its rows one by one. `register` names them for SQL (LATERAL list_links(html)); `links`, `points`, `elements` and `cues` are the same on a
DataFrame. A null or empty text has no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Elements that have no end.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Seen(HTMLParser):
    """Collects what a page is made of: (kind, name or text, attributes)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.all: list[tuple[str, str, dict]] = []
        self.handle_starttag = lambda tag, attrs: self.all.append(("start", tag, {k: v or "" for k, v in reversed(attrs)}))
        self.handle_endtag = lambda tag: self.all.append(("end", tag, {}))
        self.handle_data = lambda data: self.all.append(("text", data, {}))


def _parts(html: str | None) -> Iterator[tuple[str, str, dict]]:
    """Start tags, end tags and texts in order."""
    page = _Seen()
    for k in range(0, len(html or ""), 1 << 16):
        page.feed(html[k : k + (1 << 16)])
        yield from page.all
        page.all.clear()
    page.close()
    yield from page.all


def _elements(html: str | None) -> Iterator[tuple[str, dict, str, list[str]]]:
    """Name, attributes, text and the names around, of elements as they end. An end tag ends what is open within its element too; what scripts and styles hold is no text."""
    open_: list[tuple[str, dict, list[str]]] = []

    def ended() -> tuple[str, dict, str, list[str]]:
        tag, attributes, text = open_.pop()
        return tag, attributes, " ".join("".join(text).split()), [t for t, *_ in open_]

    for kind, what, attributes in _parts(html):
        names = [t for t, *_ in open_]
        if kind == "start" and what not in VOID:
            open_.append((what, attributes, []))
        elif kind == "end" and what in names:
            while len(open_) > len(names) - 1 - names[::-1].index(what):
                yield ended()
        elif kind == "text" and not {"script", "style"} & {*names}:
            for *_, text in open_:
                text.append(what)
    while open_:
        yield ended()


class ListLinks:
    """What a page's list items link to, in order."""

    def eval(self, html: str):  # noqa: ANN201
        linked = ((attributes["href"], text) for tag, attributes, text, around in _elements(html) if tag == "a" and "href" in attributes and around[-1:] == ["li"])
        yield from ((k, *x) for k, x in enumerate(linked))


class Elements:
    """Elements of one name, as they end, with their attributes."""

    def eval(self, html: str, name: str):  # noqa: ANN201
        named = ((attributes, text) for tag, attributes, text, _ in _elements(html) if tag == name)
        yield from ((k, *x) for k, x in enumerate(named))


class Points:
    """Elements whose class has a token and whose attribute is a number, up to the next end of such an element, also one within; those without text are left out."""

    def eval(self, html: str, name: str, token: str, attribute: str):  # noqa: ANN201
        at, held = 0, None
        for kind, what, given in _parts(html):
            if kind == "text" and held:
                held[1].append(what)
            elif what == name and kind == "end" and held:
                if label := " ".join(" ".join(held[1]).split()):
                    yield at, held[0], label
                    at += 1
                held = None
            elif what == name and kind == "start" and token in given.get("class", "") and given.get(attribute, "").isdecimal():
                held = (int(given[attribute]), [])


class Cues:
    """A caption file's cues by a walk over its lines: start and end in milliseconds, and their lines; notes, headers and cue ids are none."""

    def eval(self, text: str):  # noqa: ANN201
        at, held = 0, None
        for line in [*(text or "").lstrip("﻿").splitlines(), ""]:
            span = self._span(line) if held is None else None
            if held is not None and line.strip():
                held[2].append(line.strip())
            elif held is not None:
                yield (at, *held)
                at, held = at + 1, None
            elif span:
                held = (*span, [])

    def _span(self, line: str) -> tuple[int, int] | None:
        start, arrow, rest = line.partition("-->")
        times = [self._millis(x) for x in (start.strip(), (rest.split() or [""])[0])]
        return (times[0], times[1]) if arrow and None not in times else None

    @staticmethod
    def _millis(stamp: str) -> int | None:
        clock, _, thousandths = stamp.partition(".")
        parts = clock.split(":")
        if len(parts) != 3 or not all(p.isdecimal() and len(p) == 2 for p in parts) or len(thousandths) != 3 or not thousandths.isdecimal():
            return None
        h, m, s = map(int, parts)
        return ((h * 60 + m) * 60 + s) * 1000 + int(thousandths)


#: Names for SQL, and what each gives.
FUNCTIONS = {
    "list_links": (ListLinks, "pos int, href string, label string"),
    "html_elements": (Elements, "pos int, attributes map<string,string>, label string"),
    "index_points": (Points, "pos int, start_seconds long, label string"),
    "vtt_cues": (Cues, "cue int, start_ms long, end_ms long, lines array<string>"),
}


def function(name: str) -> Callable:
    made, schema = FUNCTIONS[name]
    return F.udtf(made, returnType=schema, useArrow=name not in ("html_elements",))


def register(spark: SparkSession) -> None:
    """Name all of them for SQL."""
    for name in FUNCTIONS:
        spark.udtf.register(name, function(name))


def _beside(df: DataFrame, name: str, column: str, *more: Column) -> DataFrame:
    return df.lateralJoin(function(name)(F.col(column).outer(), *more)).drop(column)


def links(df: DataFrame, html: str = "html") -> DataFrame:
    """df's other columns with pos, href and label of each linked list item."""
    return _beside(df, "list_links", html)


def elements(df: DataFrame, name: str, html: str = "html") -> DataFrame:
    """df's other columns with pos, attributes and label of each element of a name."""
    return _beside(df, "html_elements", html, F.lit(name))


def points(df: DataFrame, name: str = "div", token: str = "index-point", attribute: str = "time", html: str = "html") -> DataFrame:
    """df's other columns with pos, start_seconds and label of each point of an index."""
    return _beside(df, "index_points", html, F.lit(name), F.lit(token), F.lit(attribute))


def cues(df: DataFrame, text: str = "text") -> DataFrame:
    """df's other columns with cue, start_ms, end_ms and lines of each cue."""
    return _beside(df, "vtt_cues", text)
