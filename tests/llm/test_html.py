import itertools
import random
import time

import pytest

from lakemart.llm import html as H

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{x}</style><script>if (a < b) "</p>";</script></head><body class="home sidebar-left">
<header id="top"><h1>Site</h1><nav><ul><li><a href="/">Home</a><li><a href="/b">Blog</a></ul></nav></header>
<div id="cookie-banner">We use cookies and other things, which you may read about on many pages. <button>OK</button></div>
<article><header><h1>Title &amp; more</h1></header><p>Short.<p>A long paragraph of the article with many words in it, so that there is no doubt
 that it &lt;is&gt; content &#x2603;.<br>Second line<div class="adSlot"><p>Buy now, an advert that has as many words as a paragraph of the text has.</p></div>
<p>Another long paragraph with <a href=x>a link</a> in the middle of it, and some more words.</p><!-- <p>gone</p> --><ul><li>one<li>two</ul>
<blockquote>quoted</blockquote><section class="comments"><p>Reader says that this was a very good article and that all should read it.</p></section></article>
<aside><h3>Related</h3><a href=1>Other</a></aside><form><label>Your name</label><input></form><footer>&copy; 2020 Site. All rights reserved.</footer></body></html>"""


def test_article_without_the_rest():
    text, _ = H.main_text(PAGE)
    assert text.split("\n\n") == [
        "Title & more", "Short.", "A long paragraph of the article with many words in it, so that there is no doubt that it <is> content ☃. Second line",
        "Another long paragraph with a link in the middle of it, and some more words.", "one", "two", "quoted",
    ]


def test_cut_and_broken_pages_do_not_fail():
    for at in range(0, len(PAGE), 7):
        H.main_text(PAGE[:at])
    for page in ("", None, "<", "a < b", "</p></p>", '<a href="x>y', "<p", "<![CDATA[x]]>", "<script>never closed", "plain text only, with no element at all around any of it, long enough", "<p>" * 3000):
        H.main_text(page)
    assert H.main_text("<article><p>Some text of the page, long enough.</p><p>More te")[0] == "Some text of the page, long enough.\n\nMore te"


PARAGRAPHS = "<p>" + "a word and more text of it " * 12 + "</p><p>" + "other words that follow these " * 12 + "</p>"
AROUND = "<html><body><nav><a href=1>Home</a></nav>%s<div class='comments'><div><p>" + "A reader says this here. " * 10 + "</p></div></div></body></html>"


@pytest.mark.parametrize(
    "frame",
    [
        '<main class="content no-sidebar">%s</main>', '<div class="post-content with-sidebar">%s</div>',
        '<div class="article post category-legal has-comments">%s</div>', '<div class="entry has-share-buttons">%s</div>',
        '<div class="post comments-open">%s</div>', '<div class="layout sidebar-right"><div>%s</div></div>', "<form id=aspnetForm><div>%s</div></form>",
        "<div aria-hidden='false' data-x='true'>%s</div>", '<div class="widget-area"><article class="post notice">%s</article></div>',
    ],
)
def test_names_of_frames_are_not_held_against_the_body(frame):
    assert H.main_text(AROUND % (frame % PARAGRAPHS))[0] == "\n\n".join(p.strip() for p in PARAGRAPHS[3:-4].split("</p><p>"))


def test_names_inside_the_body_are():
    for box in ('<div class="sidebar">%s</div>', '<section id="comments"><article>%s</article></section>', '<div class="newsletter-signup">%s</div>', "<div aria-hidden=true>%s</div>", "<form>%s</form>"):
        long = "<p>" + "something that is not part of it " * 9 + "</p>"
        for page in (f"<main>{PARAGRAPHS}{box % long}</main>", f"<div class=content>{PARAGRAPHS}</div>{box % long}"):
            assert "something" not in H.main_text(page)[0] and "other words" in H.main_text(page)[0]
    # comments longer than the article
    text, _ = H.main_text("<body><div class=content><p>" + "a short article with few words " * 4 + "</p></div><div id=comments>" + PARAGRAPHS * 20 + "</div></body>")
    assert text == ("a short article with few words " * 4).strip()


def test_time_grows_with_the_page():
    page = "<body>" + "".join(f"<div><p>{'word ' * (i * 7 % 23)} x</p><a href=1>link {i}</a></div>" for i in range(50_000)) + "</body>"
    start = time.monotonic()
    assert H.main_text(page)[1] == 100_000
    assert H.main_text("<div>some words " * 20_000)[1] == 20_000
    assert time.monotonic() - start < 60


def test_cut_is_minimal():
    rng = random.Random(8)
    for _ in range(150):
        n = rng.randrange(1, 8)
        scores = [rng.choice([-2.0, -1.0, 0.5, 1.0, 3.0]) for _ in range(n)]
        edges = [(a, b, rng.choice([0.25, 0.5, 1.5])) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(side):
            cut = sum(c for a, b, c in edges if side[a] != side[b])
            return cut + sum(s for s, x in zip(scores, side) if s > 0 and not x) - sum(s for s, x in zip(scores, side) if s < 0 and x)

        best = min(cost(side) for side in itertools.product([True, False], repeat=n))
        assert abs(cost(H.minimum_cut(scores, edges)) - best) < 1e-9


def test_table_of_pages(spark):
    rows = [(1, "u", PAGE, 3), (1, "u", PAGE, 3), (2, None, None, 4), (None, "x", "", 5), (3, "y", "<article><p>" + "word " * 200_000 + "</p></article>", 6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    found = H.extract(pages, keep=["page_id", "url"])
    assert found.columns == ["page_id", "url", "text", "n_chars", "n_blocks"]
    got = sorted((r.page_id or 0, r.n_chars, len(r.text)) for r in found.collect())
    size = len(H.main_text(PAGE)[0])
    assert got == [(0, 0, 0), (1, size, size), (1, size, size), (2, 0, 0), (3, 999_999, 999_999)]
    assert H.extract(pages.limit(0)).count() == 0
