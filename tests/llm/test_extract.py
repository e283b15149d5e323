from __future__ import annotations

import html
import re

import pytest

from retailgold.llm import extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div id="sideBar" class="sidebar-left">links</div>
<main id=content><article class="post post-12"><h1>T&eacute;st &lt;x&gt;</h1><p>One   two<!-- c --> th<b>ree</b><p>four &#x41;&nbsp;five
<ul><li>a<li>b</ul><script>var x='<p>no</p>'</script><pre>x
 y</pre><form><input>f</form><section class="comments"><p>a reader's comment</p></section></article></main><footer>f</footer>"""


def rows(spark, pages):
    return spark.createDataFrame([(i, u, h, "mine", "x") for i, u, h in pages], "page_id bigint, url string, html string, text string, path string").repartition(2)


def run(spark, pages):
    return {r["page_id"]: r for r in extract.extract(rows(spark, pages)).collect()}


def test_rules_of_a_page():
    assert extract.main_text(extract.blocks(PAGE), None) == "Tést <x>\nOne two three\nfour A five\na\nb\nx y"


def test_whole_table(table):
    pages = {r["page_id"]: r for r in table("pages").collect()}
    got = extract.extract(table("pages")).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in re.split(r"</?(?:p|h1|br)>", body))
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_the_host_outvotes_a_page(spark):
    usual = "<body><div class=story><p>" + "story text " * 20 + "</p></div><div class=box><p>short</p></div></body>"
    odd = "<body><div class=story><p>tiny</p></div><div class=box><p>" + "a long box " * 30 + "</p></div></body>"
    pages = [(i, f"http://one.example/{i}", usual) for i in range(4)] + [(9, "http://one.example/9", odd), (10, "http://two.example/9", odd)]
    got = run(spark, pages)
    assert got[9]["text"] == "tiny" and got[10]["text"] == ("a long box " * 30).strip()


def test_numbers_in_classes_are_one_path():
    a, b = (extract.best_path(extract.blocks(f"<body><div class='post-{n} main'><p>{'text ' * 9}</p></div></body>")) for n in (1, 22))
    assert a == b


def test_odd_pages(spark):
    long = "<article>" + "".join(f"<p>line {i}</p>" for i in range(20_000)) + "</article>"
    pages = [
        (1, None, None), (2, "http://a.example/", ""), (3, "no url", "just text &amp; more"), (4, "http://a.example/x", "<p>open <b>bold"),
        (5, None, long), (None, "http://b.example", "<article><p>k</p></article>"), (7, "http://b.example", "<<<>>> < a <!-- never closed"),
        (8, "http://b.example", "<script>only script"), (9, "http://c.example", "<article>r</article>"), (9, "http://c.example", "<article>r</article>"),
    ]
    result = extract.extract(rows(spark, pages))
    assert result.columns == ["page_id", "url", "text", "n_chars"] and result.count() == len(pages)
    got = {r["page_id"]: r["text"] for r in result.collect()}
    assert got[1] == got[2] == got[8] == "" and got[3] == "just text & more" and got[4] == "open bold" and got[None] == "k"
    assert got[5].count("\n") == 19_999 and got[9] == "r"


def test_empty_table(spark):
    assert extract.extract(rows(spark, [(1, "u", "h")]).where("false")).count() == 0


WRAPPERS = ["layout-with-sidebar", "no-sidebar", "has-header-image", "page-with-comments", "share-price-report", "widget-content", "related-work", "sans-menu"]
PARAGRAPHS = [f"Paragraph {w} says a good deal about its matter, and then it says some more of it, in whole sentences." for w in ("one", "two", "three")]


@pytest.mark.parametrize("name", WRAPPERS)
def test_a_wrapper_with_a_listed_word_keeps_its_article(name):
    said = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    replies = "".join(f"<p>Reply {i} is longer than the article if one puts all of them together, which is common.</p>" for i in range(9))
    page = (
        f'<html><body><div class="{name}"><div class="sidebar"><ul><li>Latest</li></ul></div><div class="story">{said}</div>'
        f'<div class="comments">{replies}</div></div><div class="cookie-notice"><p>We use cookies.</p></div></body></html>'
    )
    assert extract.main_text(extract.blocks(page), None) == "\n".join(PARAGRAPHS)


def test_named_elements_still_go():
    said = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    replies = "<p>Reply.</p>" * 400
    links = "".join(f'<a href="x">A link to an article about something else {i}</a>' for i in range(40))
    page = f'<body><div>{said}</div><div class="comments">{replies}</div><div class="related">{links}</div></body>'
    assert extract.main_text(extract.blocks(page), None) == "\n".join(PARAGRAPHS)
    assert extract.main_text(extract.blocks(f'<body><div class="related">{links}</div></body>'), None) == ""
