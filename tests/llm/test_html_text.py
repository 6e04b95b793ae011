"""Main text of pages with known articles."""

import random
import time

import pytest
from logweir.llm.html_text import main_text, page_texts

from tests.llm.rows import sentence

LONG = "A paragraph of the article, long enough to be told from the menus around it by its ratio of text to tags."
PAGE = f"""<!DOCTYPE html><html><head><title>Title</title><style>p{{}}</style><script>var a="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1><nav><ul><li><a href=/>Home</a></li><li><a href=/x>More</a></li></ul></nav></header>
<div class="cookie-notice"><p>We use cookies, and a good many words to say so, as every site does these days.</p></div>
<div id="wrap"><main><article><header><h1>Big &amp; title</h1></header><p>{LONG}</p><p>Short.</p><ul><li>one</li><li>two</li></ul>
<div class="share-buttons"><a>Tweet</a></div><p>It&#8217;s <b>bo</b>ld&nbsp;and\n  <i>cut</i>.<br>After   break</p><!-- <p>hidden</p> --><p>{LONG}
<form><label>Mail</label><input><textarea>type</textarea></form><p style="display:none">gone</p></article>
<section id="comments"><p>Nice post, I liked the long text of it and its many words, thank you so much.</p></section></main>
<aside>Side stuff, long enough to be taken for text by its ratio of text to tags, really.</aside></div>
<div class="ad">Buy this thing now, it is so good that this advert needs a long sentence to say it.</div><footer>&copy; us</footer></body></html>"""
TEXT = f"Big & title {LONG} Short. one two It’s bold and cut. After break {LONG}"


def test_article():
    assert main_text(PAGE) == TEXT


def test_article_without_article_tag():
    page = PAGE.replace("<article>", "<div class=post>").replace("</article>", "</div>").replace("<header><h1>Big", "<div><h1>Big").replace("title</h1></header>", "title</h1></div>")
    assert main_text(page) == TEXT


@pytest.mark.parametrize("part", ["table", "ul", "blockquote", "section", "div"])
def test_text_beside_the_largest_part(part):
    page = f"<body><main><p>{LONG}</p><{part}>{f'<p>{LONG}</p>' * 3}</{part}></main></body>"
    assert main_text(page) == " ".join([LONG] * 4)


def test_links_inside_an_article():
    assert main_text(f"<article>{f'<p>{LONG}</p>' * 5}<p><a href=/a>See</a></p><p><a href=/b>a</a></p>{f'<p>{LONG}</p>' * 5}</article>").count("See a") == 1


def test_unclosed_parts():
    assert main_text(f"<nav><a>x</a><article><p><b>{LONG}<br><p>end</article><footer>f") == f"{LONG} end"
    assert main_text(f"<head><title>t<body><p>{LONG}") in (LONG, "")


@pytest.mark.parametrize(
    "html, text",
    [(None, ""), ("", ""), (" \n", ""), ("plain &lt;text&gt; only", "plain <text> only"), ("<p>a<p>b", "a b"), ("<script>x", ""), ("<![bad <p>x", ""),
     ("<p>&#0;&bogus;&amp", "\ufffd&bogus;&"), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("\U0001f600 <b>é</b>", "\U0001f600 é")],
)
def test_odd_pages(html, text):
    assert main_text(html) == text


def test_rows(spark):
    long = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, "<p>x"), (2, "v", None), (3, "w", long)]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "page_id long, url string, html string, text int, n_chars int")
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in page_texts(df).collect()), key=lambda r: r[0])
    assert got[1] == got[2] == (1, "u", TEXT, len(TEXT)) and got[0] == (0, None, "x", 1) and got[3] == (2, "v", "", 0)
    assert got[4][3] == 5000 * (len(LONG) + 1) - 1
    assert page_texts(df.limit(0)).collect() == []


TWO = f"<p>{LONG}</p><p>{LONG}</p>"


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<nav><a>x</a></nav><form id=aspnetForm>{TWO}<input></form><footer>f</footer>", f"{LONG} {LONG}"),
        (f'<div class="content notice">{TWO}</div>', f"{LONG} {LONG}"),
        (f'<div class="form wrapper">{TWO}<div class="comments">{TWO * 3}</div></div>', f"{LONG} {LONG}"),
        (f"<button>Go{TWO}", f"{LONG} {LONG}"),
        (f"<button><div>Go</div></button>{TWO}", f"{LONG} {LONG}"),
        (f"<select><option>a<option>b<div>{TWO}</div>", f"{LONG} {LONG}"),
        (f'<article>{TWO}<p class="share">Share price rose.</p><figure class=related><figcaption>Cap</figcaption></figure>{TWO}</article>', f"{LONG} {LONG} Share price rose. Cap {LONG} {LONG}"),
        (f'<article>{TWO}<div class=related><h3>More</h3><a>One article</a><a>Another article</a></div><p class=ad>Buy</p></article>', f"{LONG} {LONG}"),
        (f"<main>{TWO}<section><h2>3 Comments</h2>{TWO}</section></main>", f"{LONG} {LONG}"),
        (f"<article>{TWO}<section><h2>On comments</h2><p>Text.</p></section></article>", f"{LONG} {LONG} On comments Text."),
        (f'<article>{TWO}</article><article class="comment">{TWO}</article>', f"{LONG} {LONG}"),
        (f"<article>{TWO}<p class=ad>Buy<p>End</article>", f"{LONG} {LONG} End"),
    ],
)
def test_names_that_mislead(html, text):
    assert main_text(f"<!DOCTYPE html><body>{html}</body>") == text


@pytest.mark.parametrize("part", ["<div>x", "<nav>x", "<p class=ad>x", "<article>x", "<svg>x", "<section><h2>Comments</h2>"])
def test_time_grows_with_the_page(part):
    begin = time.process_time()
    main_text(part * 50_000 + "</aside></title></b>" * 20_000)
    assert time.process_time() - begin < 10


def planted(seed: int) -> tuple[str, str]:
    """A page made of an article and boilerplate in random places, and the article's text."""
    rng = random.Random(seed)
    boiler = [
        "<nav><ul><li><a href=/>Home</a></li><li><a href=/b>News of the day</a></li></ul></nav>",
        f'<div class="ad">{sentence(rng, 12)}.</div>',
        f'<div id="cookieNotice"><p>{sentence(rng, 15)}</p><button>OK</button></div>',
        f"<aside><h3>Side</h3><p>{sentence(rng, 20)}</p></aside>",
        "<form action=/s><input name=q><label>Search here</label><select><option>a<option>b</select></form>",
        f'<section class="comments"><p>{sentence(rng, 30)}</p><p>{sentence(rng, 25)}</p></section>',
        f"<section><h2>Comments ({rng.randrange(9)})</h2><p>{sentence(rng, 30)}</p></section>",
        "<script>if (a < b) { write('<p>no</p>') }</script>",
        "<!-- <p>hidden</p> -->",
    ]
    pieces, texts = [], []
    for _ in range(rng.randrange(5, 30)):
        words = sentence(rng, rng.choice([4, 20, 40, 60]))
        kind = rng.randrange(5)
        if kind == 0:
            half = words.split(" ", 2)
            pieces.append(f"<p>{half[0]} <b>{half[1]}</b>\n  &amp;&nbsp;{half[2]}</p>")
            texts.append(f"{half[0]} {half[1]} & {half[2]}")
        else:
            pieces.append([f"<p>{words}", f"<h2>{words}</h2>", f"<ul><li>{words}</ul>", f'<p class="lead related">{words}</p>'][kind - 1])
            texts.append(words)
    for _ in range(rng.randrange(3)):
        pieces.insert(rng.randrange(len(pieces) + 1), rng.choice(boiler))
    body = ["<article>" + "".join(pieces) + "</article>"]
    for x in rng.sample(boiler, rng.randrange(len(boiler))):
        body.insert(rng.randrange(len(body) + 1), x)
    outer = rng.choice(["{}", "<div>{}</div>", "<form id=aspnetForm>{}</form>", '<div class="page sidebar-left">{}</div>', "<main>{}</main>"])
    header, footer = "<header><h1>Site</h1></header>", f"<footer><p>&copy; {sentence(rng, 12)}</p></footer>"
    return f"<html><head><title>t</title><style>p {{}}</style></head><body>{outer.format(header + ''.join(body))}{footer}</body></html>", " ".join(texts)


def test_planted_articles():
    wrong = [seed for seed in range(400) if (page := planted(seed)) and main_text(page[0]) != page[1]]
    assert wrong == []
