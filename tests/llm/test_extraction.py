"""Main text of pages: the scan against all regions, real pages against the standard parser, planted pages."""

import html
from html.parser import HTMLParser

import numpy as np
import pytest
from conftest import MEDIUM
from hypothesis import given, settings, strategies as st

from pixelweave.llm import extraction

PRIOR = extraction.scores_of({})
TALK = "People who read long pages know where the article starts and where it ends, more or less."


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-6, 6), max_size=14))
def test_best_region(scores):
    sums = {(i, j): sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)}
    first, end = extraction.best_region(np.array(scores, float))
    most = max(sums.values(), default=0)
    if most <= 0:
        assert first == end
    else:
        assert sums[first, end] == most and end == min(j for (_, j), s in sums.items() if s == most)


class Article(HTMLParser):
    """Blocks inside the only article of a page, for the given tables' markup."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag in ("p", "h1", "article"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def by_parser(source):
    parser = Article()
    parser.feed(source)
    parser.close()
    return "\n\n".join(t for t in (" ".join(b.split()) for b in parser.blocks) if t)


def test_real_pages(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    got = extraction.extracted(pages).collect()
    assert len(got) == pages.count()
    for row in got:
        assert row["text"] == by_parser(row["html"])
        assert row["n_chars"] == len(row["text"])


def test_without_the_main_element(spark):
    """Scores of labelled pages find the region where nothing marks it."""
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    scores = extraction.learn(pages)
    assert scores["words"] > 0 > scores["p"] > scores["li"]
    found = 0
    rows = pages.collect()
    for row in rows:
        bare = row["html"].replace("<article>", "<div>").replace("</article>", "</div>")
        found += extraction.extract(bare, scores) == by_parser(row["html"])
    assert found >= 0.97 * len(rows)


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='post-body'>{}</div>",
                                  "<div id=content><div>{}</div></div>", "<body class='has-sidebar'><div class='layout with-sidebar'>{}</div>"])
@pytest.mark.parametrize("around", [
    ("<nav><a href=/>Home</a> <a href=/x>News of the day and more of it</a></nav>", ""),
    ("<header><p>The Daily Page</p></header>", "<footer>All rights reserved by somebody, everywhere.</footer>"),
    (f"<div class='cookie-notice'><p>{TALK}</p></div>", f"<section id=comments><h3>Comments</h3><p>{TALK} {TALK}</p></section>"),
    (f"<aside class=sidebar><p>{TALK}</p></aside>", f"<div class='ad-slot'>{TALK}</div>"),
    (f"<form><p>{TALK}</p><input name=q></form>", f"<div class='comment-list'><article class='comment'><p>{TALK}</p></article></div>"),
    (f"<script>var a = '<p>{TALK}</p>';</script><style>p {{ margin: 0 }}</style>", f"<noscript>{TALK}</noscript><!-- {TALK} -->"),
    ("<ul class=menu><li>One</li><li>Two</li></ul>", "<div class='related-posts'><ul><li>Other things</li></ul></div>"),
])
def test_planted(wrap, around):
    body = (f"<h1>A &amp; B</h1><p>{TALK}<br>{TALK}</p><p>Short.</p><ul><li>one</li><li>two words</li></ul>"
            f"<div class='ad'>Buy now</div><p>{TALK} <b>Bold</b>&nbsp;end<p>{TALK}")
    want = ["A & B", f"{TALK} {TALK}", "Short.", "one", "two words", f"{TALK} Bold end", TALK]
    page = f"<!DOCTYPE html><html><head><title>T</title></head>{around[0]}{wrap.format(body)}{around[1]}</html>"
    assert extraction.extract(page, PRIOR).split("\n\n") == want


@pytest.mark.parametrize("page, text", [
    ("", ""), ("   ", ""), ("<p></p>", ""), ("plain words", "plain words"), ("a < b && c > d", "a < b && c > d"),
    ("<p>one<p>two", "one\n\ntwo"), ("<p title='a > b'>x</p>", "x"), ("<p title=it's>x</p> don't", "x\n\ndon't"),
    ("<p>a<!-- <p>no</p> -->b</p>", "ab"), ("<p>a<!-->b</p>", "ab"), ("<p>x<script>if (a</p> b)</script>y</p>", "xy"),
    ("<p>x<script>never closed", "x"), ("<p>&lt;b&gt; &#233; &unknown; &eacute;</p>", "<b> é &unknown; é"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\n\nc"), ("<P>A<BR/>B</P>", "A B"), ("<p>a\n\t b c</p>", "a b c"),
    ("</div></p>x", "x"), ("<nav>menu</nav>", ""), ("<p>in<span class=ad>buy</span>side</p>", "inside"),
    ("<p>a<b>b<p>c</b>d", "ab\n\ncd"), ("<x-y>own element</x-y>", "own element"), ("<", "<"), ("<!", ""),
])
def test_markup(page, text):
    assert extraction.extract(page, PRIOR) == text


@settings(max_examples=300, deadline=None)
@given(st.text("<>/!-=\"' abp&;\n", max_size=80))
def test_any_markup_is_read(page):
    extraction.extract(page, PRIOR)


def test_deep_and_long_pages():
    assert extraction.extract("<div>" * 50_000 + "x" + "</span>" * 50_000, PRIOR) == "x"
    assert extraction.extract("<p>word</p>" * 50_000, PRIOR) == "\n\n".join(["word"] * 50_000)
    assert extraction.extract("<li>" * 20_000 + "<td>" * 20_000, PRIOR) == ""


def test_edge_rows(spark):
    page = f"<article><p>{html.escape(TALK)}</p></article>"
    rows = [(1, "u", page, "mine"), (1, "u", page, "mine"), (2, None, None, "x"), (None, "u", "", "x"), (3, "u", "<p>é😀</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extraction.extracted(pages).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got) == [
        (0, "", 0), (1, TALK, len(TALK)), (1, TALK, len(TALK)), (2, "", 0), (3, "é😀", 2),
    ]
    assert extraction.extracted(pages.limit(0)).collect() == []
