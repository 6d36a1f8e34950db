import html
import random
import re
import time

import pytest

from turnwright.llm import op3_html as op3


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<article>a &amp; b&nbsp; c<br>d<p>e", "a & b c d e"),
        ("<nav>menu</nav><article><h1>T</h1><p>x <b>y</b>z</p><aside>side</aside><div class='ad'>buy<div>now</div></div><p>w</article><footer>f</footer>", "T x yz w"),
        ("<article><p>One</p><section id=comments><article class=comment>no</article></section><form>f<input></form></article>", "One"),
        ('<article><p title="a > b">q</p><script>var t="</p>";</script><style>p{}</style><!-- no --><p>r</p></article>', "q r"),
        ("<main><p>in</p></main><p>out</p>", "in"),
        ("<header><p>top</p></header><article><header><h1>Title</h1></header><p>x</p></article>", "Title x"),
        ("<div class='site-header'>top</div><main><p>a</p><div class='ad'>no<p>end</main><div>out</div>", "a"),
        ("<body><article><div class=promo>no<section class=comments><article>c</article></section><p>x</article><article><p>b</article></body>", "b"),
        ("<article><div class='post-header'><h1>T</h1></div><figure><figcaption>f</figcaption></figure></article>", "T f"),
        ("<p" + " a='" * 50, "<p a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a=' a='"),
    ],
)
def test_cases(page, text):
    assert op3.main_text(page) == text


def test_surge_and_dive_without_an_article():
    menu = "".join(f"<div><a href='/{k}'>item {k}</a></div>" for k in range(8))
    body = "".join(f"<p>{'long text of the page ' * 8}{k}</p>" for k in range(5))
    got = op3.main_text(f"<body><div>{menu}</div><div class='notice'>n</div>{body}{"<div class='notice'>n</div>" * 4}<p>tiny</p></body>")
    assert got == " ".join(f"{'long text of the page ' * 8}{k}" for k in range(5))


def test_windows_sum_the_next_lines():
    assert op3.windows([1, 2, 3, 4]) == [6, 9, 7, 4] and op3.windows([]) == []


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op3.query(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        assert r.text == " ".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_rows(spark):
    rows = [(1, None, None, "z"), (None, "u", "<p>", "z"), (2, "u", "<article>" + "<p>x</p>" * 50_000, "z"), (2, "u", "<article>" + "<p>x</p>" * 50_000, "z")]
    got = op3.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 99_999, 99_999]
    assert op3.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article class='post no-sidebar'><p>a</p></article>", "a"),
        ("<article class='post category-social'><p>a</p></article>", "a"),
        ("<article class='social'><p>a</p></article>", "a"),
        ("<div class='content has-sidebar'><article><p>a</p></article></div>", "a"),
        ("<div class='widget'><article><p>a</p></article></div><div class='widget'>w</div>", "a"),
        ("<article><p>a</p><p class='disclaimer'>b</p><div class='comment-list'>c</div><div class='ad-slot'>d</div></article>", "a b"),
        ("<section class='comments'><article>c</article></section><main><p>a</p></main>", "a"),
        ("<article><p class='ad'>buy<p>a<p>b</article>", "a b"),
        ("<article><p class='ad'>buy <b>now</b><br>!<div>a</div></article>", "a"),
        ("<article><div><p class='ad'>buy</div>a</article>", "a"),
        ("<article><ul><li class='ad'>buy<ul><li>x</ul><li>a</ul><dl><dt class=ad>q<dd>b</dl></article>", "a b"),
        ("<article><ul><li class='ad'>buy</ul><p>a</article>", "a"),
        ("<main><h1>T</h1><p>lead</p><article><p>the whole of the text</p></article><p>more</p><ul><li><a href=x>link</a></ul></main>", "T lead the whole of the text more"),
        ("<article><p>a teaser</p></article><main><p>the longer text of the page</p></main>", "the longer text of the page"),
        ("<article><ul><li class='ad'>x</p><ul><li>y</article><article>b</article>", "b"),
        (f"<main><p>{'own text ' * 30}</p><article>teaser</article></main>", ("own text " * 30 + "teaser")),
    ],
)
def test_text_that_stays(page, text):
    assert op3.main_text(page) == text


LINKS = "".join(f"<li><a href='/{k}'>Another page of the site {k}</a></li>" for k in range(5))


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><h1>T</h1><p>one</p><ul>{LINKS}</ul><p>two</p></article>", "T one two"),
        (f"<article><p>one</p><p>two</p><h4>x</h4><ul>{LINKS}</ul></article>", "one two x"),
        ("<article><p>one</p><p><a href=a>Tweet</a> <a href=b>Share</a></p><p>two</p></article>", "one two"),
        ("<article><p>one</p><p><a href=a>A whole paragraph that is a link.</a></p><p>two</p></article>", "one A whole paragraph that is a link. two"),
        ("<article><p>one</p><p>two</p><p><a href=a>Next article</a></p></article>", "one two"),
        ("<article><p>By <a href=a>An Author</a></p><p>one</p></article>", "By An Author one"),
        (f"<article><ul>{LINKS}</ul></article>", " ".join(f"Another page of the site {k}" for k in range(5))),
        (f"<main><ul>{LINKS}</ul><article><p>one</p><ul>{LINKS}</ul></article></main>", "one"),
    ],
)
def test_windows_decide_in_articles(page, text):
    assert op3.main_text(page) == text


def test_pages_without_article():
    draw = random.Random(3)
    for _ in range(30):
        blocks = ["".join(draw.choice("abcdefgh ") for _ in range(draw.randrange(90, 300))).strip() + "." for _ in range(draw.randrange(3, 9))]
        menu = "".join(f"<li><a href='/{k}'>{draw.choice('abcdef') * 5}</a></li>" for k in range(draw.randrange(4, 12)))
        body = "".join(f"<p>{b}</p>" if draw.random() < 0.5 else f"<div><span>{b}</span></div>" for b in blocks)
        page = f"<html><body><ul>{menu}</ul><div class='sidebar'>{blocks[0]}</div><div class='x'>{body}</div><div>{menu}</div><footer>{blocks[1]}</footer></body></html>"
        assert op3.main_text(page) == " ".join(" ".join(b.split()) for b in blocks)


@pytest.mark.parametrize("unit", ['<a "x', '<a ">" ', "<![CDATA[", "<!--x", "<a<a", "<p a='", "<div class=ad>", "<head>", "<script>x", "<p>", "<li class=ad>", "</div>", "<a '\"> ", "&amp", "<", "<a href=x>y", '<a "><b \'>'])
def test_markup_left_open_takes_linear_time(unit):
    for end in ("", "<article><p>x</p></article>", ">"):
        began = time.perf_counter()
        op3.main_text(unit * (1_000_000 // len(unit)) + end)
        assert time.perf_counter() - began < 4
