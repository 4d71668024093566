"""Main texts of pages of several kinds, broken markup, and a second way to read marked pages."""

from __future__ import annotations

import html
import re

import duckdb
import pytest

from corpusloom.llm.catalog import QUERIES
from corpusloom.llm.maintext import extract_main_text, hinted, main_text, stretches

PROSE = [f"Paragraph {i} tells of the {i} ways in which long sentences fill a page, and of what comes after them." for i in range(6)]
TEXT = " ".join(PROSE)
PARAGRAPHS = "".join(f"<p>{p}</p>" for p in PROSE)
MENU = "".join(f'<li><a href="/{i}">Section number {i} of this site</a></li>' for i in range(9))


def test_registered_query_equals_a_plain_reading(spark, sf_dir):
    """All pages of the test tables mark their article and nest nothing in it."""
    got = {r["page_id"]: r for r in QUERIES["op11_main_text"](spark, sf_dir).collect()}
    pages = duckdb.sql(f"select page_id, url, html from '{sf_dir}/pages.parquet'").fetchall()
    assert len(got) == len(pages)
    for page_id, url, page in pages:
        article = re.search("<article>(.*)</article>", page, re.S)[1]
        lines = re.split("</?(?:p|h1|br)>", article.replace("<b>", "").replace("</b>", ""))
        want = " ".join(" ".join(html.unescape(line).split()) for line in lines if line.strip())
        assert (got[page_id]["text"], got[page_id]["n_chars"], got[page_id]["url"]) == (want, len(want), url)


@pytest.mark.parametrize(
    "page",
    [
        f"<body><header><h1>Site</h1></header><nav><ul>{MENU}</ul></nav><main>{PARAGRAPHS}<aside>Also read</aside></main></body>",
        f"<div id=menu>{MENU}</div><div id='content'>{PARAGRAPHS}</div><div class='footer'>All rights reserved by us, 2020</div>",
        f"<div class='site-header'>Words of a site</div><div class='post'>{PARAGRAPHS}</div><div id=comments><p>{TEXT}</p></div>",
        f"<table><tr><td><ul>{MENU}</ul><td>{PARAGRAPHS}</table><hr><form><p>Your name <input></p><p>Say it</p></form>",
        f"<article>{PARAGRAPHS[:300]}<div class=ad>Buy things</div>{PARAGRAPHS[300:]}<footer>Shared twice</footer></article>",
        f"<form action=/x><input name=a><div>{PARAGRAPHS}</div><select><option>One<option>Two</select></form>",
        f"<div class='cookie-notice'><p>{PROSE[0]}</p></div><div class='no-sidebar'>{PARAGRAPHS}</div><noscript>Switch it on</noscript>",
        f"<div style='display: none'>{TEXT}</div><div role=navigation>{MENU}</div><section>{PARAGRAPHS}</section>",
        f"<article><p>Teaser</p></article><article>{PARAGRAPHS}<section class=comments><article>{TEXT}</article></section></article>",
        f"<!-- <p>{TEXT}</p> --><script>var a = '<p>{TEXT}</p>'</script><style>p{{}}</style><title>T</title>{PARAGRAPHS}",
    ],
)
def test_kinds_of_pages(page):
    assert main_text(page) == TEXT


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("no markup at all", "no markup at all"),
        ("<article>a<b>b</b>c <i>d</i><br>e\n\t f</article>", "abc d e f"),
        ("<article><p>x &lt;b&gt; &amp;amp; &#8364;&nbsp;&eacute;&#x41; &bogus; 1 < 2 > 0</article>", "x <b> &amp; € éA &bogus; 1 < 2 > 0"),
        ("<article><p>One<p>Two<li>Three</article><p>after", "One Two Three"),
        ("<article><h1>Short.</h1></article><div class=x>" + TEXT, "Short."),
        ("<article></article><p>" + TEXT, TEXT),
        ("<article><div data-a='>' title=it's>in</div></article>", "in"),
        ("<p>open <b", "open <b"),
        ("<article>a<!-- no end > b</article>", "a b"),
        ("<ul><li><a href=1>only</a></li><li><a href=2>links</a></li></ul>", ""),
        ("<article></b></div>kept</article>", "kept"),
        ("<article class=comment>" + TEXT + "</article><article>own</article>", "own"),
    ],
)
def test_markup(page, want):
    assert main_text(page) == want


def test_hints():
    assert hinted("siteHeader x", False) and hinted("left-sidebar", False) and hinted("a  post-comments", True)
    assert not hinted("has-sidebar", False) and not hinted("entry-header", False) and not hinted("header", True)
    assert not hinted("adapter shaded", False)


def test_stretches():
    assert stretches([]) == [] == stretches([0, 0, 0, 0])
    assert stretches([0, 5, 0, 0, 7, 0, 0, 0, 9]) == [(1, 5, 7), (8, 9, 9)]


def test_rows_and_names(spark):
    rows = [(1, "u", "<p>" + TEXT, "n", 3), (1, "u", "<p>" + TEXT, "n", 3), (None, None, None, None, None), (2, "v", "<article>" + "word " * 400_000, "n", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extract_main_text(pages)
    assert dict(got.dtypes) == {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}
    assert sorted((r["page_id"] or 0, r["n_chars"], r["text"][:9]) for r in got.collect()) == [
        (0, 0, ""), (1, len(TEXT), TEXT[:9]), (1, len(TEXT), TEXT[:9]), (2, 1_999_999, "word word"),
    ]
    assert extract_main_text(pages.limit(0)).count() == 0
