"""The main text of pages of many layouts."""

import time

import pytest

from veilframe.llm.main_text import extract, extraction_report, main_text

P1, P2, P3 = ("The first paragraph, long enough, says what the article is about, with commas, and goes on for a while.",
              "The second one, a little shorter, goes on.", "The third ends the article, at last, with a few more words than the one before it had.")
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/b">More, much, more</a></li></ul></nav>'
BODY = f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>"
ALL = f"{P1} {P2} {P3}"
LAYOUTS = {
    "article": f"<html><body>{NAV}<header><h1>Site</h1></header><article>{BODY}</article><footer>c 2020, all, rights</footer></body></html>",
    "divs": f"""<div id=wrap class='no-sidebar'><div class="top-menu"><a href=x>One</a> <a href=y>Two</a></div>
        <div class="content">{BODY}</div><div class="right sidebar"><p>Read this, and this, and this, and that, too, now.</p></div>
        <div id="comments"><p>I, as a reader, think, well, that this is long, longer, longest, and more, more, more.</p></div></div>""",
    "ads inside": f"<article><p>{P1}</p><div class='ad-slot'>Buy, buy, buy.</div><p>{P2}</p><aside>By the way, no.</aside><p>{P3}</p><form><p>Mail?</p></form></article>",
    "sections": f"<article><section><p>{P1}</p><p>{P2}</p></section><section><p>{P3}</p></section></article><div role=complementary><p>{P1}</p></div>",
    "open ends": f"<ul class=nav><li><a href=1>a<li><a href=2>b</ul><article><p>{P1}<p><b>{P2}<p>{P3}",
    "cut tag": f"<article>{BODY}<p class='x",
    "raw": f"<script>var a='<article><p>no</p></article>'; if (a<b) x('</div>')</script><style>p{{x}}</style><!-- <p>no</p> --><article>{BODY}</article><script>unclosed <p>no",
    "cookie": f"<body class='has-cookie-notice page'><div class='cookieNotice'><p>We use, as you know, cookies, and more.</p></div><main>{BODY}</main></body>",
    "table": f"<table><tr><td class=menu><a href=a>a</a><td>{BODY}<td class=related-links><p>x, y, z.</table>",
    "form around": f"<form action=x><input name=y><main>{BODY}</main></form>",
    "links list": f"<article>{BODY}<ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul></article>",
    "hidden": f"<article><p hidden>secret</p><p style='display: none'>secret</p>{BODY}<div aria-hidden=true>secret</div></article>",
    "loose text": f"<div class=menu>m</div><div>{P1}<br><br>{P2}<p>{P3}</div>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert main_text(LAYOUTS[name]) == ALL


def test_headings_belong_to_the_article():
    assert main_text(f"<article><h1>Title</h1>{BODY}</article>") == f"Title {ALL}"
    assert main_text(f"<div><h1>Title</h1><div class=body>{BODY}</div><div class=share>x</div></div>") == f"Title {ALL}"


def test_inline_marks_white_space_and_references():
    page = "<article><p>a<b>b</b>c <i> d</i>\n\te</p><p>&lt;p&gt; &amp;lt; &#65;&#x42; &copy &eacute;t&eacute;&nbsp;x &unknown; &am</article>"
    assert main_text(page) == "abc d e <p> &lt; AB © été x &unknown; &am"
    assert main_text("<article><div>one</div><div>two</div><table><tr><td>3<td>4</table><pre>a  b\nc</pre></article>") == "one two 3 4 a b c"


def test_pages_without_text():
    for page in (None, "", " ", "<html></html>", NAV, "<article></article>", "<!-- x", "<p", "<script>x"):
        assert main_text(page) == ""
    assert main_text("just words") == "just words" and main_text("a < b > c") == "a < b > c" and main_text("<") == "<"


def test_short_articles_are_whole():
    assert main_text(f"{NAV}<div class=ad>Buy this, now, and that.</div><article><h1>Hi</h1><p>Hi</p></article><footer>x</footer>") == "Hi Hi"


def test_long_and_deep_pages_take_little_time():
    began = time.monotonic()
    words = "word " * 400_000
    assert main_text(f"<article><p>{words}</article>") == words.strip()
    assert main_text("<div>" * 50_000 + P1) == P1
    assert main_text("<b>" * 50_000 + P1 + "</i>" * 50_000) == P1
    main_text("<a href='" * 50_000), main_text("<!-" * 50_000), main_text("</p>" * 50_000 + "<p><td>" * 20_000)
    assert len(main_text("<article>" + f"<p>{P1}" * 5_000)) == 5_000 * (len(P1) + 1) - 1
    assert time.monotonic() - began < 30


def test_rows(spark):
    rows = [(1, "u", LAYOUTS["article"], "old"), (1, "u", LAYOUTS["article"], "old"), (None, None, None, None), (3, "v", "", "old"),
            (4, "w", "<article>Straße \U0001f600</article>", "old")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    report = extraction_report(df)
    assert report.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, report.collect()), key=repr) == sorted(
        [(1, "u", ALL, len(ALL))] * 2 + [(None, None, "", 0), (3, "v", "", 0), (4, "w", "Straße \U0001f600", 8)], key=repr)
    assert extract(df).columns == df.columns and extract(df, name="found").columns == [*df.columns, "found"]
    assert extraction_report(df.where("false")).count() == 0
