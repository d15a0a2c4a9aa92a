"""Main text of pages: planted articles come back whole, everything round them goes."""

import html
import random
import re

import duckdb
import pytest

from plain import SF
from snaplake.llm import queries
from snaplake.llm.html_text import extract_text, main_text, page_blocks

AROUND = [
    '<header class="site"><a href="/">Home</a> the site of all that is new</header>',
    '<nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>',
    '<div id="sidebar-left"><p>This is the text of a sidebar and it has all of the words that a text has.</p></div>',
    '<aside>Most read: the ten things that you have to know of</aside>',
    '<div class="ad">Buy this now, it is the best of the year and all of them say so.</div>',
    '<div class="cookie-notice">We use cookies to make this the best of sites for you and all others.</div>',
    '<form action="/s"><label>Search</label><input name="q"><select><option>all of it</select><button>Go</button></form>',
    '<section class="comments"><article><p>I have read this and it is not the best that I have read from you.</p></article></section>',
    '<script>if (1 < 2) document.write("<p>This is not the text of the page</p>");</script>',
    '<style>p > a { color: red }</style>', '<!-- <p>This is a comment in the source of the page</p> -->',
    '<noscript>This page is at its best with scripts</noscript>',
    '<footer>&copy; 2024 &middot; The site</footer>',
]
TEXTS = [
    "This is the first of the paragraphs and it is long enough to be a text by the rules of the first pass.",
    "Der Hund ist in dem Haus und die Katze ist auch da, das ist so wie es ist.", "Yes.", "Ça & là < où > \"ici\"",
    "La casa es de los dos y no se vende por el momento, que es lo que dicen todos.", "xq zzk qrr", "wort " * 5000, "#" * 300,
]


def planted(rng):
    texts = rng.choices(TEXTS, k=rng.randint(1, 8))
    body = []
    for t in texts:
        shown = html.escape(t)
        if " " in shown and rng.random() < 0.5:
            one, two = shown.split(" ", 1)
            shown = f"<b>{one}</b>\n\t&nbsp;{two}"
        body.append(rng.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<div>{}</div>", "<ul><li>{}</ul>", "<blockquote>{}</blockquote>"]).format(shown))
        if rng.random() < 0.3:
            body.append(rng.choice(AROUND[4:6] + AROUND[8:11]))
    front, back = (rng.sample(AROUND, rng.randint(0, 6)) for _ in range(2))
    page = "".join(["<!DOCTYPE html><html><head><title>A title &amp</title></head><body>", *front, "<article>", *body, "</article>", *back])
    return page, "\n".join(" ".join(t.split()) for t in texts)


def test_planted_articles_come_back():
    rng = random.Random(11)
    for _ in range(400):
        page, text = planted(rng)
        assert main_text(page) == text


def test_pages_without_an_article_element():
    page = ('<body class="has-sidebar"><div class="header"><a href=/>Site</a></div><div id="menu"><a href=1>One</a> <a href=2>Two</a></div>'
            f'<div class="post-body"><h2>The title</h2><p>{TEXTS[0]}</p><p>Short.</p><ul><li>an item<li>more <a href=x>link</a> words</ul>'
            '<div class="share-buttons">Share</div><p>The last &eacute;t&#233; is here for the reader.</div>'
            '<div id="comments"><p>This is a comment that is long enough to look like a text of the article.</div><div>&copy; 2024</div>')
    assert main_text(page) == f"The title\n{TEXTS[0]}\nShort.\nan item\nmore link words\nThe last été is here for the reader."
    page = f'<a href=/>Home</a> <a href=/a>About us</a><h1>A headline</h1><p>{TEXTS[0]}<p>Yes.<p>{TEXTS[1]}<div><a href=1>Previous</a></div>© 2020 all rights'
    assert main_text(page) == f"A headline\n{TEXTS[0]}\nYes.\n{TEXTS[1]}"


def test_short_blocks_take_the_label_of_the_nearest_decided():
    menu = "<div><a href=1>One</a> <a href=2>Two</a></div>"
    page = f"<body>{menu}<div>zq</div>{menu}<p>{TEXTS[0]}</p><div>zk</div><p>{TEXTS[1]}</p>{menu}"
    assert main_text(page) == f"{TEXTS[0]}\nzk\n{TEXTS[1]}"


@pytest.mark.parametrize("page", [
    f"<nav><ul><li><a href=1>One</a><article><p>{TEXTS[0]}</article>",  # a menu that is never closed
    f"<form id=all><main><p>{TEXTS[0]}</p></main></form>", f'<div class="content"><p>{TEXTS[0]}', f"<p>{TEXTS[0]}<script>x = '</p>'",
    f"<main><article><p>{TEXTS[0]}</p><aside>no</aside></article></main>", f"<P CLASS='a > b'>{TEXTS[0]}<!-- open"])
def test_broken_pages(page):
    assert main_text(page) == TEXTS[0]


def test_hostile_input_ends():
    for page in ("<a " * 200_000, '<a "' * 200_000, "<" * 500_000, "&" * 500_000, "<div>" * 20_000 + "text", "<script>" * 100_000, "<!--" * 100_000, "<div>x" * 20_000):
        main_text(page)
    assert page_blocks(None) == [] and main_text("") == ""


def test_query_on_the_given_pages(spark):
    got = {r.page_id: r for r in queries.SPARK["op11_html_text"](spark, SF).collect()}
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, url, page in rows:
        inside = page[page.index("<article>") + 9:page.index("</article>")]
        parts = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", p))).split()) for p in re.split("</?p>|</?h1>", inside)]
        text = "\n".join(p for p in parts if p)
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, text, len(text))


def test_edge_rows(spark):
    rows = [(1, None, None, "x", 1), (1, "u", "", "x", 2), (None, "u", f"<p>{TEXTS[0]}", "x", 3), (2, "u", "<p>" + "the word and " * 100_000, None, 4),
            (2, "u", "<p>" + "the word and " * 100_000, None, 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.n_chars) for r in got.collect()) == [(0, len(TEXTS[0])), (1, 0), (1, 0), (2, 1_299_999), (2, 1_299_999)]
    assert extract_text(pages.limit(0)).count() == 0
