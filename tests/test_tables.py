"""Table functions on pages and captions that patterns would misread, from DataFrames and from SQL."""

import pytest

from turnwright.sources import tables

PAGE = """<UL><li class=x><a title="a > b" href='/one?a=1&amp;b=2'>One <b>&amp;</b> two</a></li>
<li><A HREF=/three>three</A><li><a>no link</a><li><p><a href="/deep">not at once</a></p></ul><a href="/out">outside</a><li><a href="">empty"""
POINTS = """<div time='12' class="a index-point b"> First <div>within</div> after </div><div class='index-point' time="soon">no</div>
<DIV data-x="1" CLASS=index-point TIME=90><script></script>Ninety &lt;x&gt;</DIV><div class="index-point" time="7"> </div>"""


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, POINTS)], "id int, html string")


def test_links(spark, pages):
    want = [(1, 0, "/one?a=1&b=2", "One & two"), (1, 1, "/three", "three"), (1, 2, "", "empty")]
    assert sorted(map(tuple, tables.links(pages).collect())) == want
    tables.register(spark)
    pages.createOrReplaceTempView("some_pages")
    assert sorted(map(tuple, spark.sql("SELECT id, l.* FROM some_pages, LATERAL list_links(html) l").collect())) == want


def test_points(spark, pages):
    want = [(4, 0, 12, "First within"), (4, 1, 90, "Ninety <x>")]
    assert sorted(map(tuple, tables.points(pages).collect())) == want
    tables.register(spark)
    pages.createOrReplaceTempView("some_pages")
    assert sorted(map(tuple, spark.sql("SELECT id, p.* FROM some_pages, LATERAL index_points(html, 'div', 'index-point', 'time') p").collect())) == want


def test_nested_elements(pages):
    got = [(r.id, r.pos, r.attributes.get("class"), r.label) for r in tables.elements(pages, "div").collect()]
    assert sorted(got, key=str) == [(4, 0, None, "within"), (4, 1, "a index-point b", "First within after"), (4, 2, "index-point", "no"), (4, 3, "index-point", "Ninety <x>"), (4, 4, "index-point", "")]


def test_cues(spark):
    vtt = "﻿WEBVTT\n\n7\n00:00:01.000 --> 00:00:02.500 align:left\n>> a\n  b --> c\n\nNOTE 00:00:01.000\nx\n\n00:00:03.000-->00:00:04.000\n\n0:00:05.000 --> 00:00:06.000\nno\n\n01:00:00.250 --> 01:00:01.000\nlast"
    got = tables.cues(spark.createDataFrame([(1, vtt), (2, None)], "id int, text string")).collect()
    assert sorted((r.id, r.cue, r.start_ms, r.end_ms, r.lines) for r in got) == [(1, 0, 1000, 2500, [">> a", "b --> c"]), (1, 1, 3000, 4000, []), (1, 2, 3_600_250, 3_601_000, ["last"])]
