import html
import re

import numpy as np
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import DATA
from tierline.llm import pagetext


def article(page):
    """The blocks of the given pages' one article: they hold headings, paragraphs, bold text and line breaks only."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    body = re.sub(r"</?b>", "", body)
    parts = re.split(r"</?(?:p|h1)>", re.sub("<br>", " ", body))
    return "\n\n".join(t for t in (re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts) if t)


def test_table_matches_its_articles(spark):
    rows = pq.read_table(f"{DATA}/pages.parquet").to_pylist()
    got = {r.page_id: r for r in pagetext.extract(spark.read.parquet(f"{DATA}/pages.parquet")).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["page_id"]].text == article(r["html"])
        assert got[r["page_id"]].n_chars == len(got[r["page_id"]].text) and got[r["page_id"]].url == r["url"]


def test_frames_inside_and_outside():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li>Home</ul></nav>
    <div class="cookie-notice">We use cookies</div><main><article class="post"><header><h1>Real &lt;title&gt;</h1></header>
    <p>One  two<br>three&nbsp;four &amp;amp; <a href="x>y">link</a>ed<p>Next <b>bold</b>ly<script>if (a<b) "</p>"</script>
    <div class="ad-slot">Buy</div><aside>Side</aside><!-- <p>hidden</p> --><form><p>Sign up</p></form><ul><li>a<li>b</ul>
    <section id="comments"><p>Nice<article>reply</article></section><p hidden>no</p><p>5 < 6 &am</article><div>After</div></main>
    <footer>foot</footer></body>"""
    found, marked = pagetext.blocks(page)
    assert marked and found == ["Real <title>", "One two three four &amp; linked", "Next boldly", "a", "b", "5 < 6 &am"]


def test_odd_pages():
    assert pagetext.blocks("") == ([], False)
    assert pagetext.blocks("plain text") == (["plain text"], False)
    assert pagetext.blocks("<article></article>") == ([], True)
    assert pagetext.blocks("<main><p>a</main><p>b") == (["a"], True)
    assert pagetext.blocks("<article><p>cut off <b attr='") == (["cut off"], True)
    assert pagetext.blocks("<script>never closed <p>x") == ([], False)
    assert pagetext.blocks("<p>a</nav><nav>b") == (["a"], False)
    assert pagetext.blocks('<p title="' + "a" * 200_000) [1] is False
    assert pagetext.blocks("<" * 50_000)[0] == ["<" * 50_000]


def brute(streams, least, pages):
    where = {}
    for s in streams:
        for i in range(len(s) - least + 1):
            where.setdefault(tuple(s[i : i + least]), set()).add(tuple(s))
    out = []
    for s in streams:
        marks = np.zeros(len(s), bool)
        for i in range(len(s) - least + 1):
            if len(where[tuple(s[i : i + least])]) >= pages:
                marks[i : i + least] = True
        out.append(marks.tolist())
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=7), st.integers(1, 6), st.integers(1, 3))
def test_repeated_tokens_match_brute_force(streams, least, pages):
    assert [m.tolist() for m in pagetext.repeated_tokens(streams, least, pages)] == brute(streams, least, pages)


def test_a_host_without_marked_articles(spark):
    menu = "<div>Home News Sport Weather Shop About Contact Imprint</div>"
    end = "<div>All rights reserved by the owners of this very site</div>"
    rows = [(i, f"http://h.example/{i}", f"<body>{menu}<p>Page {i} tells its own story number {i} of many</p>{end}") for i in range(6)]
    rows += [(50, "http://other.example/", f"<body>{menu}<p>alone</p>"), (None, None, None), (51, "not a url", ""), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, 3, "t") for r in rows], "page_id long, url string, html string, n_chars int, text string")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in pagetext.extract(df).collect()), key=repr)
    want = [(i, f"Page {i} tells its own story number {i} of many") for i in [0, *range(6)]]
    want += [(50, "Home News Sport Weather Shop About Contact Imprint\n\nalone"), (None, ""), (51, "")]
    assert got == sorted(((i, t, len(t)) for i, t in want), key=repr)
    assert pagetext.extract(df.where("false")).collect() == []


def test_a_notice_on_few_pages_of_a_large_host(spark):
    notice = "This site is run by volunteers and takes no money"
    # single tokens of 8 MB make the host large
    rows = [(i, "http://big.example/", f"<p>{chr(97 + i) * (1 << 23)}</p>") for i in range(12)]
    rows += [(100 + i, f"http://big.example/{i}", f"<div>{notice}</div><p>{i} is the number of this page</p>") for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pagetext.extract(df).where("page_id >= 100").collect()}
    assert got == {100 + i: f"{i} is the number of this page" for i in range(3)}


def test_articles_vote_on_what_repeats(spark):
    end = "All rights reserved by the owners of this very site"
    copied = "One agency report that many of the pages on this host print"
    rows = [(i, f"<p>Start {i}</p><article><p>Page {i} tells its own story</p><p>{copied}</p></article><div>{end}</div>") for i in range(4)]
    # pages without an article: the footer repeats on pages that have one, and the report is an article on most
    rows += [(10, f"<p>A page that marks nothing</p><p>{copied}</p><div>{end}</div>")]
    # what is a footer elsewhere is one in an article too
    rows += [(11, f"<article><p>A wide article</p><div>{end}</div></article>")]
    df = spark.createDataFrame([(i, "http://h.example/", h) for i, h in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pagetext.extract(df).collect()}
    want = {i: f"Page {i} tells its own story\n\n{copied}" for i in range(4)}
    assert got == {**want, 10: f"A page that marks nothing\n\n{copied}", 11: "A wide article"}


def test_frames_whose_end_tag_is_left_out():
    def text(page):
        return pagetext.blocks(page)[0]

    assert text('<article><p class="ad">Buy<p>Real text</p><p>More</p></article><p>out') == ["Real text", "More"]
    assert text('<article><p class="ad"><span>Buy<div>Real text</div></article>') == ["Real text"]
    assert text('<article><div><p class="ad">Buy</div>Real text</article>') == ["Real text"]
    assert text('<article><div class="ad">Buy</article><p>out') == []
    assert text('<ul><li class="share">a<li>b<ul><li>c</ul><li class="share">d</ul><p>e') == ["b", "c", "e"]
    assert text('<ul><li class="share">a<ul><li>inner</ul>still<li>b</ul>') == ["b"]
    assert text('<dl><dt class="ad">a<dd class="ad">b<dt>c<dd>d</dl>') == ["c", "d"]
    assert text('<table><tr class="ad"><td>a<table><tr><td>b</table>c<tr><td>d<td class="share">e<td>f</table>g') == ["d", "f", "g"]
    assert text('<table><thead class="ad"><tr><td>a<tbody><tr><td>b</table>') == ["b"]
    assert text("<html><head><meta charset=x><title>T</title><body><p>a") == ["a"]
    assert text("<head><title>T</title>words") == ["words"]
    assert text('<div class="ad"><b>a</i></p></li><p>b</div>c') == ["c"]
    assert text('<form><table><tr><td>a</form></table>b') == ["b"]
    assert text('<div><article><p>a</p></div><p>b</article>c') == ["a", "b"]


def test_names_of_headings_and_paragraphs_drop_nothing():
    def text(page):
        return pagetext.blocks(page)[0]

    kept = '<article><h2 id="menu">Menu</h2><h3 class="social">Social</h3><p class="notice">Take note</p><p id="share">Share</p>{}</article>'
    assert text(kept.format('<section class="related-work"><p>Others</p></section><div class="widget">W</div>'))  == [
        "Menu", "Social", "Take note", "Share", "Others", "W"
    ]
    dropped = ("adbox", "cookieBanner", "c-share__list", "commentlist", "comment-12", "ad-slot-3", "post-comments", "relatedPosts", "site-footer")
    assert text("<article>" + "".join(f'<div class="x {n}">no</div>' for n in dropped) + "<p>Body</p></article>") == ["Body"]
    names = ("roadmap", "badge", "header", "shared-values", "commentary", "navigational-aids", "administration", "cookie-recipes", "body-text", "")
    assert text("<article>" + "".join(f'<div class="{n}">{n}.</div>' for n in names) + "</article>") == [f"{n}." for n in names]
    assert text("<article><cookie-banner><p>no</p></cookie-banner><p>a <span class='notice'>b</span> <span class='ad'>no</span></p></article>") == ["a b"]


def test_comments_and_teasers_that_are_articles():
    def text(page):
        return pagetext.blocks(page)[0]

    assert text('<article><p>Body</p></article><article class="comment"><p>Nice</p></article>') == ["Body"]
    assert text('<article><p>Body</p><article class="comment-body">Nice<article class="reply">No</article></article><p>End</p></article>') == ["Body", "End"]
    assert text('<article class="teaser">Other</article><article class="post"><p>Body</p></article>') == ["Body"]
    # a column of comment is an article where nothing else is
    assert text('<main><article class="comment"><p>We think</p></article></main>') == ["We think"]
    assert text('<article><p>Body</p><article><p>Part</p></article></article>') == ["Body", "Part"]


def test_what_few_of_a_hosts_pages_share_is_no_boilerplate(spark):
    end = "All rights reserved by the owners of this very site"
    told = "One paragraph of nine words that three articles print"
    rows = [(i, f"<p>Story a{i} b{i} c{i} d{i}</p>{f'<p>{told}</p>' if i < 3 else ''}<div>{end}</div>") for i in range(40)]
    df = spark.createDataFrame([(i, "http://h.example/", h) for i, h in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pagetext.extract(df).collect()}
    assert got == {i: f"Story a{i} b{i} c{i} d{i}" + (f"\n\n{told}" if i < 3 else "") for i in range(40)}


def test_given_pages_without_their_marks_lose_no_article_block(spark):
    rows = pq.read_table(f"{DATA}/pages.parquet").to_pylist()
    bare = [(r["page_id"], r["url"], re.sub(r"</?article>", "", r["html"])) for r in rows]
    got = {r.page_id: r.text for r in pagetext.extract(spark.createDataFrame(bare, "page_id long, url string, html string")).collect()}
    for r in rows:
        own = got[r["page_id"]].split("\n\n")
        assert all(b in own for b in article(r["html"]).split("\n\n") if b)
