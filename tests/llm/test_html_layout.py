from __future__ import annotations

import re
from html.parser import HTMLParser

from conftest import SF_DIR
from llm_fixtures import _importable, hostile, nothing  # noqa: F401

from tallywind.llm import html_layout as H


class Visible(HTMLParser):
    """All text outside of scripts, styles and the title, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.off, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.off:
            self.words += data.split()


def test_no_visible_word_is_lost(spark):
    rows = H.extract(spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/pages.parquet")).collect()
    assert len(rows) == 250
    for r in rows:
        parser = Visible()
        parser.feed(r["html"])
        parser.close()
        got = [w for w in r["text"].split() if w != "-"]
        assert "".join(got) == "".join(w for w in parser.words if w != "-")


def test_blocks_lists_and_tables():
    page = """<!doctype html><title>x</title><h1>Head &amp; line</h1><p>one<p>two <b>bold</b>  x<br>y<ul><li>a<li>b<ul><li>c</ul><li>d</ul>
<ol start=3><li>q<li>r</ol><table><caption>Cap</caption><tr><th>Name<th>N<tr><td>long name<td>1<tr><td colspan=2>span</table>
<div hidden>no</div><div style="display: none">no</div><pre> a
  b</pre>tail<blockquote>q1<p>q2</blockquote><script>var a="</p>";</script><!-- c --><span aria-hidden=true>no</span>end"""
    want = """Head & line

one

two bold x
y

- a
- b
  - c
- d

3. q
4. r

Cap
Name      | N
long name | 1
span

 a
  b

tail

  q1

  q2

noend"""
    assert H.page_text(page) == want


def test_wide_characters_are_aligned():
    assert H.page_text("<table><tr><td>日本<td>x<tr><td>abc<td>y</table>") == "日本 | x\nabc  | y"


def test_broken_and_deep_markup():
    for page in ("", "<", "<p", "</p></p>", "<!-- open", "<script>never closed", "<a <b <c>>", "text &amp &#x41; &bogus;", "<table><td>loose", "<li>alone", "<p style='x"):
        H.page_text(page)
    assert H.page_text("text &amp; &#x41;") == "text & A"
    assert "deep" in H.page_text("<div>" * 50_000 + "deep")
    assert "deep" in H.page_text("<table><tr><td>" * 400 + "deep")
    assert H.page_text("<p>a<table><tr><td>b</table>c").split() == ["a", "b", "c"]
    assert H.page_text("<b>" * 3000 + "x" + "</i>" * 3000) == "x"


def test_odd_rows(hostile, nothing):
    rows = H.extract(hostile, "text", "kept").collect()
    assert len(rows) == hostile.count() and all((r["kept"] is None) == (r["text"] is None) for r in rows)
    one = re.sub(r"\s+", " ", next(r["text"] for r in rows if r["doc_id"] == 2))
    assert next(r["kept"] for r in rows if r["doc_id"] == 2) == one
    assert H.extract(nothing, "text", "kept").count() == 0


def test_raw_elements_end_where_they_end():
    """A capital with a longer small form does not move the end; a longer name does not end a script, a Kelvin sign is no k."""
    page = "İ" * 12 + "<script>var a = 1;</SCRIPT >kept one<p>two<script>x</scripts>y</script>z"
    assert H.page_text(page).split() == ["İ" * 12 + "kept", "one", "twoz"]


def test_numbers_of_lists():
    assert H.page_text("<ol start=1987><li>a<li>b<li value=7>c<li>d</ol>").split("\n") == ["1987. a", "1988. b", "7. c", "8. d"]
    assert H.page_text("<ol start=-1><li>a<li value=x>b</ol><ol start=99999999999999999999><li>c</ol>").split() == ["-1.", "a", "0.", "b", "1.", "c"]


def test_cells_over_rows():
    page = "<table><tr><td rowspan=2>ab<td>c<td>d<tr><td>e<td>f<tr><td>g<td rowspan=9 colspan=2>h<tbody><tr><td>i<td>j<td>k</table>"
    assert H.page_text(page).split("\n") == ["ab | c | d", "   | e | f", "g  | h", "i  | j | k"]


def test_what_a_browser_shows():
    assert H.page_text("<svg><title>t</title><desc>d</desc><g><text>label</text></g></svg><math><mi>x</mi></math>").split() == ["labelx"]
    assert H.page_text("<dialog>no</dialog><dialog open>yes</dialog><b aria-hidden=true>seen</b>").split() == ["yes", "seen"]
    page = "<div style='visibility:hidden'>no<p>no<b style='visibility: visible'>yes</b><i style='display:none'><u style='visibility:visible'>no</u></i></div>"
    assert H.page_text(page) == "yes"
    assert H.page_text("<table><tr><td style='visibility:hidden'>no<td>a<tr><td>bb<td>c</table>").split("\n") == ["   | a", "bb | c"]
