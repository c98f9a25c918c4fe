import html
import re

import pytest

from mise.llm import html_text as X
from mise.llm.common import read_table

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var a="<p>no</p>";</script></head><body>
<nav class="top"><ul><li><a href=/a>Menu</a></ul></nav><div class="ad">Buy now</div>
<div class=wrap><article class="post p12"><h1>Title &amp; more</h1><p>First <b>bold</b> para&#233;graph<br>next line
<p>Second   one with <a href="x">a link</a>.<div class="share">Share it</div><form><input name=q>Search</form>
<ul><li>one<li>two</ul><!-- no --><section id="comments"><p>{c}</p></section></article></div>
<aside><p>side side side</p></aside><footer>&copy; us</footer></body></html>""".replace("{c}", "A reader's comment. " * 30)
WANT = "Title & more\n\nFirst bold paraégraph next line\n\nSecond one with a link.\n\none\n\ntwo"


def test_article_only():
    assert X.extract(PAGE) == WANT


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain words &lt;only&gt;", "plain words <only>"), ("<p>open <b>and never closed", "open and never closed"),
    ("<div><p>a</p><p>b &am", "a\n\nb &am"), ("<script>if (a<b) x()", ""), ("<", "<"), ("a < b", "a < b"), ("<p a='>'>q</p>", "q"),
    ("<nav>menu</nav>", ""), ("<p>" + "x " * 50_000, ("x " * 50_000).strip()),
])
def test_odd_pages(page, text):
    assert X.extract(page or "") == text


def test_hosts_vote(spark):
    """A page whose advert outweighs its article follows the host's other pages."""
    body = "<html><body><div class=story><p>{a}</p></div><div class=box><p>{b}</p></div></body></html>"
    long, short = "many words of the story here " * 9, "tiny"
    rows = [(i, f"https://u@News.example.org:80/p{i}", body.format(a=long, b=short)) for i in range(9)]
    rows += [(9, "http://news.example.org", body.format(a="brief story", b=long * 2)), (9, "http://news.example.org", body.format(a="brief story", b=long * 2)),
             (10, "http://other.example.org", body.format(a="brief story", b=long * 2)), (11, None, PAGE), (None, "odd", None), (12, "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in X.main_text(df).collect()), key=str)
    text = {r[0]: r[1] for r in got}
    assert len(got) == len(rows)
    assert text[9] == "brief story" and text[10] == (long * 2).strip() and text[11] == WANT and text[12] == "" and text[None] == ""
    assert X.main_text(df.limit(0)).count() == 0


def test_many_hosts_join_with_salt(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}.org/{i}", PAGE) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(X, "BROADCAST_ROWS", 0)
    assert {r["text"] for r in X.main_text(df).collect()} == {WANT} and X.main_text(df).count() == 12


def test_given_pages(spark):
    """The tables' pages hold their text in one article of headings and paragraphs."""
    pages = read_table(spark, "/root/testdata/sf0.001", "pages")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        want[r["page_id"]] = "\n\n".join(b for b in blocks if b)
    assert {r["page_id"]: r["text"] for r in X.main_text(pages).collect()} == want


@pytest.mark.parametrize("wrap", [
    'class="wrap" style="overflow:hidden"', 'class="overflow-hidden"', 'aria-hidden="false"', 'class="content has-sidebar"', 'class="no-comments"',
    'class="with-ads"', 'data-note="hidden"', 'id="modal"', 'class="sidebar"', "hidden",
])
def test_wrappers_keep_their_article(wrap):
    page = "<body><nav>menu</nav><div {}>{}</div><p>after</p></body>"
    assert X.extract(page.format(wrap, "<article><p>The story of the page.</p></article>")) == "The story of the page."


@pytest.mark.parametrize("wrap", ["hidden", 'hidden=""', 'aria-hidden="true"', 'style="color:red; display: none"', "style='visibility:hidden'",
                                  'class="box sidebar"', "id=comments-2"])
def test_hidden_and_marked_elements_go(wrap):
    page = f"<body><article><p>The story.</p><div {wrap}><p>not this</p></div></article><div {wrap}><article><p>nor this</p></article></div></body>"
    assert X.extract(page) == "The story."


def test_deep_pages_take_time_in_proportion():
    import time
    began = time.monotonic()
    assert X.extract("<div>" * 100_000 + "<p>deep</p>") == "deep"
    assert X.extract("<div>x" * 50_000).count("x") == 50_000
    assert X.extract("<div>" * 50_000 + "</section>" * 50_000 + "z") == "z"
    X.vote("<b>" * 50_000 + "<p>y</p>" * 1_000)
    assert time.monotonic() - began < 60


def test_lists_and_tables_without_an_article():
    """Reading such a page ends, whatever elements it has."""
    assert X.extract("<div class=a><ul><li>one two three<li>four five six</ul></div>") == "one two three\n\nfour five six"
    assert X.extract("<table><tr><td>seven<td>eight<tr><td>nine</table>") == "seven\n\neight\n\nnine"
    assert X.vote("<ul hidden><li>a<main>b</main></ul>")


def test_paths_in_words_and_numbers_agree():
    page = X.parse('<div class="b2 a"><section id=x><p>text</p></section></div><div class="a b9"><p>more</p></div>')
    paths = [page.path_of(n) for n in page.nodes]
    assert paths == ["", "div.a.b#", "div.a.b#>section", "div.a.b#>section>p", "div.a.b#", "div.a.b#>p"]
    assert [page.number_of(p) for p in paths] == [n.path for n in page.nodes] and page.number_of("div>nav") is None
