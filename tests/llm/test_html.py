"""Wrapper inference: pages written from known articles come back exactly."""

import html
import json
import random

import pytest

from retailcast.llm import wrappers as W
from retailcast.llm.html_tree import parse
from retailcast.llm.queries import table

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua café 日本 &amp <tag> x<y \"q\"".split()


def sentence(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def story(r):
    return [sentence(r, r.randint(3, 8)), *[sentence(r, r.randint(15, 60)) for _ in range(r.randint(1, 6))]]


def p(blocks, tag="p"):
    return "".join(f"<{tag}>{html.escape(b)}</{tag}>" for b in blocks)


def noise(r, n):
    return html.escape(sentence(r, n))


def semantic(r, a):
    return f"""<!DOCTYPE html><html><head><title>{html.escape(a[0])}</title><script>if (a < b) document.write("<p>no</p>")</script></head><body>
      <header><h1>My site</h1></header><nav><ul>{''.join(f'<li><a href="/{i}">{noise(r, 2)}</a></li>' for i in range(r.randint(2, 6)))}</ul></nav>
      <article><h1>{html.escape(a[0])}</h1>{p(a[1:])}<aside>see also {noise(r, 5)}</aside><div class="share-buttons">share me</div></article>
      <section id="comments"><h2>Comments</h2>{p([sentence(r, 20)] * r.randint(0, 3))}</section><footer>&copy; {noise(r, 9)}</footer></body></html>"""


def opaque(r, a):
    """No telling names: the article is the container with most of the host's text."""
    rows = "".join(f'<li><a href="/x{i}">{noise(r, 3)}</a></li>' for i in range(r.randint(3, 7)))
    return f"""<html><body><div class="c1"><ul>{rows}</ul></div><div class="c2"><div class="k9"><h2>{html.escape(a[0])}</h2>{p(a[1:])}</div></div>
      <div class="c3"><span>Copy of the year {r.randint(2000, 2020)}</span></div></body></html>"""


def cookie_form(r, a):
    """A form around everything, a cookie notice, a search form and reader comments as articles."""
    return f"""<body><form id="page"><div class="cookie-notice">We use cookies. {noise(r, 30)}</div><form class="search"><label>Find</label><input><button>Go</button></form>
      <div id="middle"><div class="text-0{r.randint(1, 9)}"><h1>{html.escape(a[0])}</h1>{p(a[1:])}<div class="tag-links"><a href=1>{noise(r, 3)}</a> <a href=2>{noise(r, 3)}</a></div></div></div>
      <div class="comment-list"><article class="comment"><p>{noise(r, 80)}</p></article></div></form></body>"""


def layout_table(r, a):
    return f"""<table><tr><td width=100><a href=a>{noise(r, 4)}</a><br><a href=b>{noise(r, 4)}</a></td><td><h3>{html.escape(a[0])}</h3>{p(a[1:])}</td></tr></table>"""


def broken(r, a):
    """Unclosed paragraphs and formatting, upper-case tags, no end of the page."""
    return f"<HTML><BODY><DIV CLASS='ad'>buy {noise(r, 40)}</DIV><!-- x --><ARTICLE><H1>{html.escape(a[0])}<P>" + "<P>".join(f"<b>{html.escape(b)}<br>" for b in a[1:]) + "</ARTICLE><FOOTER>bye"


@pytest.mark.parametrize("layout", [semantic, opaque, cookie_form, layout_table, broken])
def test_articles_come_back(spark, layout):
    r = random.Random(layout.__name__)
    stories = [story(r) for _ in range(40)]
    rows = [(i, f"https://Host{i % 2}.example:80/{i}", layout(r, a)) for i, a in enumerate(stories)]
    found = W.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
    want = {i: "\n".join(" ".join(b.split()) for b in a) for i, a in enumerate(stories)}
    assert len(found) == 40
    for x in found:
        assert x.text == want[x.page_id] and x.n_chars == len(x.text) and x.url == rows[x.page_id][1]


def test_odd_pages(spark):
    deep, many = "<div>" * 3000 + "deep" + "</div>" * 3000, "<article>" + "".join(f"<x{i}>w{i}</x{i}>" for i in range(300)) + "</article>"
    pages = [None, "", " ", "plain words", "<p>one", "a &lt; b &amp;amp; c&#233;&nbsp;d", "<nav>only a menu</nav>", "<script>x", "<!-- open", "<a href='x>y'>link</a>",
             "<<>< p </ ><p", "<p a=\"'>t</p>", deep, "<article><p>a</p>" + "<p>long</p>" * 20000 + "</article>", many, "<ul><li>a<li>b</ul>", "x\x00y", "</div></p>end"]
    rows = [(i, "http://a.example/", h, 1, "c") for i, h in enumerate(pages)] + [(None, None, "<p>no id</p>", 1, "c"), (3, "http://a.example/", "plain words", 1, "c"), (99, "::bad", "<p>b</p>", 1, "c")]
    found = W.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, pages int, host string")).collect()
    text = {x.page_id: x.text for x in found}
    assert len(found) == len(rows) and sum(x.page_id == 3 for x in found) == 2
    assert text[0] == text[1] == text[2] == text[6] == text[7] == text[8] == ""
    assert text[3] == "plain words" and text[4] == "one" and text[5] == "a < b &amp; cé d" and text[None] == "no id" and text[99] == "b"
    assert text[12] == "deep" and text[13].count("\n") == 20000 and text[14].split("\n") == [f"w{i}" for i in range(300)] and text[15] == "a\nb" and text[17] == "end"
    assert all(x.n_chars == len(x.text) for x in found)
    assert W.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_expressions():
    def of(page):
        return W.notation(W.expression(parse(page)))
    assert of("<p>a</p><p>b</p><p>c</p>") == "p<#>+"
    assert of("<h2>a</h2><p>b</p><h2>c</h2><p>d</p><p>e</p>") == "(h2<#> p<#>+)+"
    a, b = (W.expression(parse(x)) for x in ("<div class=x>same</div><p>one</p><ul><li>i</ul>", "<div class=x>same</div><p>two</p><p>three</p>"))
    assert W.notation(W.align(a, b)) == "div<'text'> p<#>+ ul<li<#>>?"
    assert W.notation(W.align(b, a)) == "div<'text'> p<#>+ ul<li<#>>?"


def test_wrappers_stay_small():
    """Pages of a host that have nothing in common, and rows of unlike elements."""
    r = random.Random(1)
    held = []
    for i in range(300):
        tags = [r.choice(["div", "p", "ul", "section", "h2", "table"]) for _ in range(200)]
        page = "".join(f'<{t} class="{"".join(r.choices("abcdefgh", k=4))}">{i}</{t}>' for t in tags)
        held = W.align(held, W.expression(parse(page))) if held else W.expression(parse(page))
    assert W.size(held) < 400


def test_given_pages_against_a_plain_reader(spark):
    """The given pages have one ``article`` each; its blocks, cut by plain string work, are the text."""
    import re
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    found = {x.page_id: x.text for x in W.main_text(pages).collect()}
    for x in pages.collect():
        inner = x.html[x.html.index("<article>") + 9:x.html.index("</article>")]
        cut = [" ".join(html.unescape(y).split()) for y in re.split(r"</?p>|</?h1>|<br>", re.sub(r"</?b>", "", inner))]
        assert found[x.page_id] == "\n".join(y for y in cut if y)


def test_one_wrapper_per_host_from_all_its_pages(spark):
    rows = [(i, f"http://h{i % 3}/", f"<div class=a>{i}</div>" + ("<p>x</p>" * (i % 4))) for i in range(60)]
    made = W.host_wrappers(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)).collect()
    assert sorted((x.host, x.pages) for x in made) == [("h0", 20), ("h1", 20), ("h2", 20)]
    for x in made:
        assert W.notation(json.loads(x.wrapper)) == "div<#> p<'text'>+?"


def test_decisions_too_large_to_ship_are_joined(spark, monkeypatch):
    """Hot hosts are dealt to pieces; the texts stay the same."""
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    want = sorted(map(tuple, W.main_text(pages).collect()))
    monkeypatch.setattr(W, "SHIPPED", 10)
    joined = W.main_text(pages)
    assert "_piece" in joined._jdf.queryExecution().analyzed().toString() and sorted(map(tuple, joined.collect())) == want
