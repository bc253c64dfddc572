"""Main text of pages whose article is known, in several layouts, and of broken ones."""

import html
import random
import re
import time

import pytest

from foliant.llm.html_text import extracted, main_text
from foliant.llm.queries import op13_html_extraction

WORDS = "über the of and, thing. 1 < 2 R&D “quoted” entre éane it's 3 > 2 naïve well; 文字、 x".split(" ")


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def article(rng, blocks):
    """Markup of an article and its text."""
    markup, texts = [], []
    for kind in blocks:
        said = sentence(rng, rng.randrange(8, 60))
        words = [html.escape(w, quote=rng.random() < 0.5) for w in said.split(" ")]
        at = rng.randrange(len(words))
        inline = rng.choice(["<b>{}</b>", "<a href='/x?a=1&b=\">\"'>{}</a>", "<span\nclass=x>{}</SPAN>", "{}<!-- <p>no</p> -->", "<em><strong>{}</em></strong>", "{}<script>'<p>no'</script>"])
        words[at] = inline.format(words[at])
        body = rng.choice([" ", "\n  ", "&#32;", " \t"]).join(words)
        if kind == "ul":
            extra = sentence(rng, 9)
            markup.append(f"<ul><li>{body}<li>{html.escape(extra)}</ul>")
            texts += [said, extra]
        elif kind == "table":
            markup.append(f"<table><tr><th>Head<td>{body}</table>")
            texts += ["Head", said]
        elif kind == "open":  # a paragraph that is not closed
            markup.append(f"<p>{body}<br>")
            texts.append(said)
        else:
            markup.append(f"<{kind}>{body}</{kind}>")
            texts.append(said)
    return "".join(markup), " ".join(" ".join(t.split()) for t in texts)


MENU = "<ul>" + "".join(f"<li><a href=/{i}>Menu entry {i}, more</a>" for i in range(12)) + "</ul>"
PROSE = "<p>Some words that are no article, with commas, and more commas, so that they look like one, a little at least.</p>" * 3
LAYOUTS = {
    "article": "<!DOCTYPE html><html><head><title>T &lt;</title><style>p{{}}</style></head><body><nav>{menu}</nav><!-- ad --><div class=ad>{prose}</div><article>{main}</article><footer>{prose}</footer></body></html>",
    "main": "<body><header><h1>Site</h1>{menu}</header><div class='cookie-notice'>{prose}</div><main>{main}</main><aside>{prose}</aside><form><p>Search</p><input></form>",
    "named": "<body><div id=header>{menu}</div><div id=wrap><div class='post-body clearfix has-sidebar'>{main}</div><div class=sidebar>{prose}</div></div><div id=comments>{prose}{prose}{prose}</div><div class=footer>{menu}</div>",
    "bare": "<div>{menu}</div><div>{main}</div><div>{menu}</div>",
    "table": "<table><tr><td>{menu}</td><td>{main}</td></tr></table>",
    "inside": "<body><article>{main}<section class=comments>{prose}{prose}</section><div class='share social'>{menu}</div><div role=alert>{prose}</div><p style='display: none'>hidden</p></article></body>",
    "form": "<body><form id=page><div class=nav>{menu}</div><article>{main}</article><button>Send</button></form></body>",
    "sections": "<body><div class=promo>{prose}</div><main><section>{main}</section><section><p>Last words, few.</p></section></main></body>",
    "comment articles": "<body><article>{main}</article><section class=discussion><article class=comment>{prose}</article></section></body>",
    "unclosed menu": "<body><nav>{menu}<article>{main}</article></body>",
    "unclosed advert": "<body><div class='top ad'>{prose}<article>{main}</article></body>",
}
BLOCKS = ["h1", "p", "p", "ul", "p", "h2", "blockquote", "open", "pre", "p", "table", "p"]


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    rng = random.Random(name)
    for _ in range(20):
        blocks = [b for b in BLOCKS if b != "table" or name != "table"]
        markup, text = article(rng, [*blocks, *rng.choices(["p", "open", "ul"], k=rng.randrange(12))])
        got = main_text(LAYOUTS[name].format(menu=MENU, prose=PROSE, main=markup))
        assert got == text + (" Last words, few." if name == "sections" else "")


def test_short_articles():
    for text in ("x", "One two.", "a, b"):
        assert main_text(LAYOUTS["article"].format(menu=MENU, prose=PROSE, main=f"<h1>H</h1><p>{text}</p>")) == f"H {text}"
    assert main_text(LAYOUTS["article"].format(menu=MENU, prose=PROSE, main="")) == ""


def test_white_space_and_references():
    assert main_text("<article><p>a&nbsp;\n b<b>c</b>d &eacute;&#x41;&amp;amp; &unknown; 1 < 2 <3</p>e<div>f</div></article>") == "a bcd éA&amp; &unknown; 1 < 2 <3 e f"
    assert main_text("plain words") == "plain words"


def test_broken_pages_take_linear_time():
    for piece in ["<", "<!--", "&", "<a '", "<a \"'>", "<p>x", "<div>x", "<p><b>x", "</p>", "<div a", "<ul><li>x", "<script>", "<table><tr><td>x", '<a ">"', "</", "<form>", "<a>x"]:
        start = time.perf_counter()
        main_text(piece * 20_000)
        assert time.perf_counter() - start < 5, piece


def test_rows(spark):
    long = "<article>" + "<p>word, &amp; more</p>" * 100_000 + "</article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>a</p>", None), (3, "u", "<p>a</p>", "x"), (3, "u", "<p>a</p>", "x"), (4, "u", long, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extracted(pages, ["page_id", "url", "text"]).collect()  # the page's own column gives way
    want = [(1, "u", "", 0), (2, None, "", 0), (None, "u", "a", 1), (3, "u", "a", 1), (3, "u", "a", 1), (4, "u", " ".join(["word, & more"] * 100_000), 1_299_999)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert extracted(pages.limit(0), ["page_id"]).collect() == []


def test_given_pages(spark, sf_dir):
    """Their articles are marked, so a plain reading finds them."""
    got = {r.page_id: r for r in op13_html_extraction(spark, sf_dir).collect()}
    for page in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inner = re.search("<article>(.*)</article>", page.html, re.DOTALL)[1]
        text = " ".join(html.unescape(re.sub("</?(p|h1|br)>", " ", re.sub("</?b>", "", inner))).split())
        assert tuple(got.pop(page.page_id)) == (page.page_id, page.url, text, len(text))
    assert not got
