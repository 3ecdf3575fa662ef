import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.llm.helpers import with_clashes
from threadsmith.llm.html_density import Dom, densities, extract_main_text, main_text

PAGE = """<html><head><title>x</title><style>p{}</style></head><body><header>Site</header><nav><a href=1>a</a></nav>
<div class="cookie-notice">We use cookies</div><aside>side bar words</aside><div id="content"><article>
<h1>Title &amp; more</h1><p>First   paragraph with <b>bold</b> and <a href=x>a link</a> in it.<p>Second &lt;one&gt;.
<script>var s="</p>";</script><div class="comments"><p>Reader says many many words, more than the article has, again and again</p>
</div><form><input><p>Your mail</p></form></article></div><footer>&copy; me</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE) == "Title & more\nFirst paragraph with bold and a link in it.\nSecond <one>."


def test_page_without_article_takes_dense_subtrees():
    text = "many words of one paragraph that go on and on for a while, "
    page = ("<body><ul>" + "<li><a href=1>link</a>" * 30 + "</ul><div><p>" + text * 3 + "</p><p>" + text * 4 + "</p></div></body>")
    assert main_text(page) == "\n".join(" ".join((text * n).split()) for n in (3, 4))


def test_wrappers_named_after_noise_keep_the_article():
    text = "many words of one paragraph that go on and on for a while, " * 4
    side = '<div class="sidebar"><p>About this site</p></div><div id="comments"><p>' + "reader says, " * 100 + "</p></div>"
    for wrapper in ('class="content-sidebar-wrap"', 'class="page no-sidebar"', 'id="wrapper" class="has-banner"',
                    'class="comments-open"', 'role="banner"'):
        for inner in ("<main><article>{}</article></main>", "<main>{}</main>", "<article>{}</article>",
                      '<div class="content no-sidebar">{}</div>', "{}"):
            body = inner.format(f"<h1>Title</h1><p>{text}</p>")
            page = f"<html><body><div {wrapper}>{body}{side}</div><p>Note</p></body></html>"
            lines = main_text(page).split("\n")
            assert lines[:2] == ["Title", text.strip()], (wrapper, inner)
            assert not any("reader" in x or "About" in x for x in lines), (wrapper, inner)
        page = f"<body><main><div {wrapper}><article><h1>Title</h1><p>{text}</p></article>{side}</div></main></body>"
        assert main_text(page) == "Title\n" + text.strip(), wrapper


def test_parts_named_noise_stay_out():
    text = "many words of one paragraph that go on and on for a while, " * 4
    for part in ('<div class="related"><article><p>card one of few words</p></article></div>',
                 '<div id="comments"><article class="comment-body"><p>' + "reader says, " * 300 + "</p></article></div>",
                 '<div class="cookie-consent"><p>' + "we value cookies, " * 300 + "</p></div>"):
        for inner in ("<article>{}</article>", "<div>{}</div>"):
            page = "<body>" + inner.format(f"<h1>Title</h1><p>{text}</p>") + part + "</body>"
            assert text.strip() in main_text(page)
            assert not any(x in main_text(page) for x in ("card", "reader", "cookies")), (part[:30], inner)


def test_open_head_ends_where_content_starts():
    for start in ("<html><head><title>x</title>", "<head><meta a=b><title>x</title><style>p{}</style><script>1</script>",
                  "<title>x</title>", "<head>", "<html><head><title>x</title><noscript>"):
        assert main_text(start + "<body><p>text</p></body></html>") == "text", start
    assert main_text("<html><head><title>x</title></head><body><p>text</p></body></html>") == "text"
    for content in ("<p>text", "<p>text</p></html>", "<main><p>text</p></main>", "text", "<div>text</div></head>"):
        assert main_text("<head><title>x</title>" + content) == "text", content
    assert main_text("<head><title>x</title><noscript><p>no</p></noscript><link a=b>\n<p>text") == "text"


def test_page_without_article_keeps_headings_and_short_paragraphs():
    text = lambda n: ("words of a paragraph " * n)[:n * 5].strip()
    menu = "<ul>" + "<li><a href=1>link of a menu</a>" * 30 + "</ul>"
    page = (f"<body>{menu}<div><h1><a href=1>Title</a></h1><div><p>{text(100)}</p><p>{text(101)}</p></div><p>{text(40)}</p><h2>Second</h2>"
            f"<section><p>{text(50)}</p><div>{menu}</div><p>Yes.</p></section>in <b>line</b>, <a href=1>see</a> there<h3>Third</h3>"
            f'<ul><li>one of a list<li><a href=1>two</a></ul><p>{text(9)} <a href=1>see</a></p></div><div>{menu}</div><div class="footer">me</div>')
    assert main_text(page).split("\n") == [
        "Title", text(100), text(101), text(40), "Second", text(50), "Yes.", "in line, see there", "Third", "one of a list", "two",
        text(9) + " see"]


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<html></html>") == main_text("<nav>a</nav>") == ""
    assert main_text("plain") == "plain"
    assert main_text("</p></b>open <p>one<p>two") == "open\none\ntwo"
    assert main_text("<p>" * 3000 + "deep" + "<div>" * 3000 + "er") == "deep\ner"
    long = "word " * 200_000
    assert main_text(f"<article><p>{long}</p></article>") == long.strip()


def test_rows_keep_null_and_repeated_ids(spark):
    pages = with_clashes(spark.createDataFrame(
        [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", "")], "page_id long, url string, html string"))
    rows = extract_main_text(pages).orderBy("page_id").collect()
    assert [(r.page_id, r.url, r.n_chars) for r in rows] == [(None, None, 0), (1, "u", 70), (1, "u", 70), (2, "v", 0)]
    assert extract_main_text(pages.limit(0)).columns == ["page_id", "url", "text", "n_chars"]
    assert extract_main_text(pages.limit(0)).count() == 0


def test_given_pages_give_their_documents(spark):
    """Each page's article is a document under a heading; its lines must come back whole."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id"), F.col("text").alias("doc"))
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    found = extract_main_text(pages).withColumn("doc_id", F.regexp_extract("url", r"/(\d+)", 1).cast("long")).join(docs, "doc_id")
    rows = found.collect()
    assert rows
    for r in rows:
        lines = [" ".join(x.split()) for x in r.doc.split("\n")]
        assert r.text.split("\n")[1:] == [x for x in lines if x]


def test_malformed_markup_does_not_end_the_job():
    for odd in ("<![foo[bar]]>", "<![1]>", "<![", "<![CDATA[x]]>", "<!>", "<!x", "<!DOCTYPE [", "<?php", "</", "</>", "<a <b>", "&#xffffffff;", "<!-- -"):
        text = main_text(f"<body><p>before</p>{odd}<p>after</p></body>")
        assert text.startswith("before"), odd
    assert main_text("<article><p>a</p><![if IE]><p>b</p><![endif]></article>") == "a\nb"


def test_random_markup_never_fails():
    rng = random.Random(4)
    bits = ["<", ">", "<!", "<![", "]]>", "[", "]", "<!--", "-->", "--", "<p>", "</p>", "<a href=1>", "</a>", "<div class='ad x'>", "</div>", "<head>", "</head>",
            "<body>", "<article>", "</article>", "<script>", "</script>", "<title>", "</title>", "&", "&amp", "&#", "&#x;", "\"", "'", "=", "/", "text ", "é", "\0",
            "<table><tr><td>", "<li>", "<?", "<svg/>", "<h1 id=notice>", "<textarea>", "<plaintext>", "<br/>", "</html>", "\n"]
    for _ in range(10_000):
        assert isinstance(main_text("".join(rng.choices(bits, k=rng.randint(1, 30)))), str)


def test_article_parts_with_names_of_their_own_stay():
    text = "many words of one paragraph that go on and on for a while, " * 4
    page = (f'<body><div class="site-header">Site</div><article><header><h1>Title</h1></header><p>{text}</p><section id="search-algorithms"><h2 id="notice">'
            f'Search</h2><p class="share-price">It rose.</p></section><div class="share-buttons">Share it</div><p class="notice">We moved</p>'
            '<footer>by me</footer></article><div class="left_nav">x</div></body>')
    assert main_text(page).split("\n") == ["Title", text.strip(), "Search", "It rose."]


def test_groups_with_many_links_are_judged_by_the_threshold():
    text = "many words of one paragraph that go on and on for a while, " * 6
    links = "".join(f"<p>word <a href={k}>see {k}</a> more</p>" for k in range(9))
    page = f"<body><div><div><p>{text}</p><p>{text}</p></div><section>{links}</section><section><p>Short.</p></section></div></body>"
    assert main_text(page).split("\n") == [text.strip(), text.strip(), "Short."]


@pytest.mark.parametrize("seed", range(5))
def test_densities_equal_a_plain_recursion(seed):
    """Composite density and child sums by the formula, over random trees of open elements."""
    rng = random.Random(seed)

    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            return "x" * rng.randint(1, 30)
        tag = rng.choice(["div", "section", "span", "a", "b"])
        return (tag, [tree(depth - 1) for _ in range(rng.randint(0, 4))])

    def markup(t):
        return t if isinstance(t, str) else f"<{t[0]}>{''.join(map(markup, t[1]))}</{t[0]}>"

    def measure(t, link=False):
        """chars, tags, link chars, link tags below (and, for chars, in) t."""
        if isinstance(t, str):
            return len(t), 0, len(t) * link, 0
        inner = [measure(c, link or t[0] == "a") for c in t[1]]
        below = [c for c in t[1] if not isinstance(c, str)]
        return (sum(m[0] for m in inner), sum(m[1] for m in inner) + len(below), sum(m[2] for m in inner),
                sum(m[3] for m in inner) + sum(c[0] == "a" for c in below))

    root = ("body", [tree(5) for _ in range(6)])
    dom = Dom()
    dom.feed(markup(root))
    dom.close()
    density, total, _, _, body = densities(dom)
    all_chars, _, all_links, _ = measure(root)
    share = all_links / max(all_chars, 1)

    def composite(t, link):
        c, n, lc, ln = measure(t, link)
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return c / max(n, 1) * math.log(max(1.0, c / max(lc, 1) * max(n, 1) / max(ln, 1))) / base

    want = []

    def walk(t, link=False):
        if isinstance(t, str):
            return
        inside = link or t[0] == "a"
        want.append((composite(t, inside), sum(composite(c, inside or c[0] == "a") for c in t[1] if not isinstance(c, str))))
        for c in t[1]:
            walk(c, inside)
    walk(root)
    got = list(zip(density[body:], total[body:]))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b)
