import html
import re

import pytest

from eventloom.llm import html_text as ht


def plain(page):
    """The sample pages' article, by their own fixed form."""
    inner = re.search(r"<article>(.*?)</article>", page or "", re.S)
    if not inner:
        return ""
    inner = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner[1]))
    return " ".join(html.unescape(inner).split())


def test_sample_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in ht.page_texts(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == plain(r.html)
        assert (got[r.page_id].url, got[r.page_id].n_chars) == (r.url, len(plain(r.html)))


BODY = "<p>First &amp; foremost &eacute;&#33; <b>bo</b>ld</p>\n<p>Second<br>line &lt;tag&gt;</p>"
TEXT = "First & foremost é! bold Second line <tag>"


@pytest.mark.parametrize("page", [
    f"<article>{BODY}</article>",
    f"<nav>Menu</nav><main>{BODY}</main><footer>f</footer>",
    f"<header><h1>Site</h1></header><article>{BODY}<footer>tags</footer></article><aside>x</aside>",
    f"<article>{BODY}<section class='comments'><article>nice one</article></section></article>",
    f"<div id=sideBar>links</div><article>{BODY}<form><input value=a><label>mail</label></form></article>",
    f"<div class='cookie-notice'>We use cookies</div><article>{BODY}<div class=ad>Buy</div></article>",
    f"<ARTICLE CLASS='post with-sidebar'>{BODY}<script>if (a<b) '</p>';</script><style>p{{}}</style></ARTICLE>",
    f"<article>{BODY}<!-- <p>hidden > </p> --><noscript>no</noscript></article>",
    f"<article data-x='a>b'>{BODY}",
    f"<div role=main>{BODY}</div><div role=navigation>go</div>",
    f"<p>{BODY}",
    f"<div class='banner'>Top</div>{BODY}<div class='share-buttons'>Tweet</div>",
    f"<nav>go</nav><article class='post category-social'>{BODY}</article><div class=sidebar>x</div>",
    f"<p>Site</p><div class='layout-sidebar-right'><article>{BODY}<div class=share>t</div></article></div>",
    f"<p>Site</p><div class='newsletter-archive'><main>{BODY}</main></div>",
    f"<article><div class='search-results-study'>{BODY}</div></article><p>more</p>",
    f"<article>{BODY}</article><div class=sidebar><article>Teaser</article></div>",
    f"<article>{BODY}<div class='social'><article>Teaser</article></div></article>",
    f"<article>{BODY}</article><article class='comment'>Nice</article><article class='ad'>Buy</article>",
    f"<div class='comments'><article>Nice</article></div>{BODY}",
])
def test_parts_that_are_not_the_article(page):
    assert ht.main_text(page, {}) == TEXT


@pytest.mark.parametrize("page,text", [
    ("", ""), ("no markup", "no markup"), ("a < b > c", "a < b > c"), ("<", "<"), ("<p", ""),
    ("</div>x</p>y", "x y"), ("<ul><li>a<li>b</ul>", "a b"), ("<b>a<i>b</b>c", "abc"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<!-- open", ""), ("<script>x", ""),
    ("<p>a  b&nbsp;c</p>", "a b c"), ("<title>t</title>x", "x"), ("&copy &amp &am", "© & &am"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p title='\"'>q</p>", "q"),
])
def test_small_and_broken_pages(page, text):
    assert ht.main_text(page, {}) == text


def site(k, story):
    return (f"<html><body><div class='top'><span>Daily</span></div><div class='left'><ul><li>Home<li>News</ul></div>"
            f"<div class='story'><h2>Title {k}</h2><p>{story}</p><p>More {k}</p><div class='hint'>Never miss a story</div>"
            f"</div><div class='end'>All rights</div></body></html>")


def test_wrapper_finds_the_story_without_marks(spark):
    rows = [(k, f"http://a.example/{k}", site(k, f"Story number {k * 77} " * 9)) for k in range(9)]
    rows += [(20, None, None), (21, "nonsense", "<p>x</p>"), (21, "nonsense", "<p>x</p>"), (None, "http://b.example", "")]
    pages = spark.createDataFrame([(*r, "w", "h") for r in rows], "page_id long, url string, html string, wrapper string, host string")
    got = {r.page_id: r.text for r in ht.page_texts(pages).collect()}
    for k in range(9):
        assert got[k] == " ".join(f"Title {k} {f'Story number {k * 77} ' * 9} More {k}".split())
    assert (got[20], got[21], got[None]) == ("", "x", "")
    assert ht.page_texts(pages).count() == len(rows)
    assert ht.page_texts(pages.limit(0)).count() == 0


def test_alignment_is_union_free_and_order_keeping():
    a = ht.wrapper("<div class=a>1</div><p>x</p><div class=c>3</div>")
    b = ht.wrapper("<div class=a>1</div><div class=b>2</div><p>y</p><p>z</p>")
    both = ht.align(a, b)
    assert list(both.kids) == ["div.a", "div.b", "p", "div.c"]
    assert [k.pages for k in both.kids.values()] == [2, 1, 2, 1]
    assert both.kids["p"].many and both.kids["p"].text == 0 and both.kids["div.a"].text
    again = ht.Node.read(both.plain())
    assert again.plain() == both.plain()


def test_a_wrapper_does_not_grow_with_names_of_its_own():
    node = None
    for k in range(600):
        one = ht.wrapper(f"<div class='x{'abcdefghij'[k % 10] * (k // 10 + 1)}'>t</div>")
        node = ht.align(node, one) if node else one
    assert len(node.kids) <= ht.WIDE
