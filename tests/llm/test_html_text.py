"""Main text of pages: the test pages against their article element, and odd markup."""

import html
import re

from tests.harness import TESTDATA
import pytest

from tramline.llm import html_text, queries

SCHEMA = "page_id bigint, url string, html string, text int"


def got(spark, pages):
    rows = [(k, f"http://one.example/{k}", p, 1) for k, p in enumerate(pages)]
    return {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_query(spark):
    folder = f"{TESTDATA}/sf0.01"
    found = {r.page_id: r for r in queries.op10_html_extraction(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(found) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", body)]
        assert found[p.page_id].text == "\n\n".join(filter(None, parts)) and found[p.page_id].n_chars == len(found[p.page_id].text)


def test_template_runs_are_left_out(spark):
    page = "<html><body><div><p>Our motto: buy more</p><span>Log in here</span></div><div><h2>Story {0}</h2><p>News {0} of the &eacute;poque {0}</p><p>Common line</p></div><div><i>All rights reserved</i></div></body></html>"
    pages = [page.format(f"n{k}") for k in range(6)]
    pages[5] = pages[5].replace("<p>Common line</p>", "")
    texts = got(spark, pages)
    assert texts[0] == "Story n0\n\nNews n0 of the époque n0\n\nCommon line"
    assert texts[5] == "Story n5\n\nNews n5 of the époque n5"
    alone = got(spark, pages[:3])
    assert alone[0].startswith("Our motto: buy more") and alone[0].endswith("All rights reserved")


def test_copied_articles_stay(spark):
    page = "<html><body><nav>menu</nav><article><h1>{0}</h1><p>{1}</p></article></body></html>"
    texts = got(spark, [page.format("Same title", "Same words")] * 5 + [page.format(f"T{k}", f"Words {k}") for k in range(5)])
    assert texts[0] == "Same title\n\nSame words" and texts[7] == "T2\n\nWords 2"
    assert set(got(spark, [page.format("a", "b")] * 9).values()) == {"a\n\nb"}


def test_elements(spark):
    page = """<!DOCTYPE html><html><head><title>t</title><script>var t="</p><article>";</script></head><body class="with-sidebar">
    <header>top</header><div class="cookie-notice"><p>We use</p></div><main><article id=a><header><h1>Head &amp; line</h1></header>
    <p>One<b>two</b> <i>three</i>&nbsp;four<br>five<p>six <!-- no <p> --> seven</p><ul><li>x<li>y</ul><aside>side</aside><div class='ad'>buy</div>
    <form><label>l</label></form><table><tr><td>c1<td>c2</table><p title="a > b">q</p><footer>by me</footer></article>
    <section class="comments"><article class="comment"><p>first!</p></article></section></main><div id="sidebar">z</div><footer>f</footer></body></html>"""
    want = "Head & line\n\nOnetwo three four five\n\nsix seven\n\nx\n\ny\n\nc1\n\nc2\n\nq"
    assert got(spark, [page])[0] == want


def test_odd_pages(spark):
    rows = [(1, None, None, 1), (2, "", "", 1), (2, "", "", 1), (3, "no scheme", "just text &lt;b&gt; &am", 1), (4, "http://h/", "<p>a<p>b < c</p><div", 1),
            (5, "http://h/", "<!-- open", 1), (6, "http://h/", "<script>x", 1), (7, "http://h/", "</p></div>ok", 1), (8, "http://h/", "<div>" * 3000 + "deep", 1), (9, "http://h/", "<p>" + "w " * 100_000 + '<a title="x>', 1)]
    found = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {1: "", 2: "", 3: "just text <b> &am", 4: "a\n\nb < c\n\n<div", 5: "", 6: "", 7: "ok", 8: "deep", 9: ("w " * 100_000).strip()}
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_copied_articles_with_tags_of_their_own_stay(spark):
    page = "<html><body><nav>menu {0}</nav><article>{1}</article></body></html>"
    own = "<h1>Copied title</h1><table><tr><td>one cell</td></tr></table><ul><li>an item</li></ul><p>Copied words</p>"
    others = [page.format("m", f"<h1>T{k}</h1><p>Words {k}</p>") for k in range(35)]
    want = "Copied title\n\none cell\n\nan item\n\nCopied words"
    copies = got(spark, [page.format("m", own)] * 5 + others)
    assert [copies[k] for k in range(5)] == [want] * 5 and copies[7] == "T2\n\nWords 2"
    syndicated = got(spark, [page.format(k, own) for k in range(5)] + others)
    assert [syndicated[k] for k in range(5)] == [want] * 5


def test_left_out_elements_hold_at_any_depth():
    """What stands inside a sidebar stays out, however deep; elements closed again leave the text after them in."""
    for deep in (50, 500, 5_000):
        page = '<div class="sidebar">' + "<div>" * deep + "MENU" + "</div>" * deep + "</div><p>real</p>"
        assert html_text.blocks(page, {}) == ["real"]


@pytest.mark.parametrize("share", [0.0, 2.0])
def test_hot_hosts_give_the_same_text(spark, monkeypatch, share):
    monkeypatch.setattr(html_text, "HOT", share)
    page = "<html><body><div><span>Menu here</span><b>Login</b></div><article><h1>T{0}</h1><p>Words {0}</p></article></body></html>"
    rows = [(k % 60, f"http://h{k % 3}/{k}", page.format(k), 1) for k in range(120)] * 2
    found = [(r.page_id, r.url, r.text) for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(found) == sorted(2 * [(i, u, f"T{k}\n\nWords {k}") for k, (i, u, _, _) in enumerate(rows[:120])])
