import pytest

from folioflow.llm import html_extract as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><div id="cookie-notice"><p>We use cookies, yes, we do, for all of it.</p></div>
<div class="nav-menu"><a href="/a">a</a></div>
<main class="with-sidebar"><div class="content"><header><h1>Title &amp; more</h1></header>
<p>First paragraph, with commas, and enough text to be scored well.</p><div class="advert">Buy now</div>
<p>Second   paragraph<br>goes on &mdash; &#233;.</p><ul><li>item one</li><li>item two</ul>
<form><label>Email</label><input></form><table><tr><td>cell</table></div></main>
<section id="comments"><article class="comment"><p>I disagree, totally, with this, and with that, and with
everything, at length, with commas, a lot, of them, really, so many, of them.</p></article></section>
<aside>side</aside><script>var x = "<p>no</p>";</script><footer>foot</footer></body></html>"""


def test_article_without_the_rest():
    assert h.main_text(PAGE).split("\n\n") == [
        "Title & more", "First paragraph, with commas, and enough text to be scored well.",
        "Second paragraph goes on — é.", "item one", "item two", "cell"]


@pytest.mark.parametrize("html, text", [
    ("", ""), ("<p>just text", "just text"), ("plain &amp; simple", "plain & simple"),
    ("<article><p>One<p>Two</article><footer>x", "One\n\nTwo"),
    ("<article><p><b>bold<br><p>next</article>", "bold\n\nnext"),
    ("<article><p>cut off &am", "cut off &am"), ("<nav><a>only</a></nav>", ""),
    ("<!-- <p>no</p> --><article><p>yes</p></article>", "yes"),
    ("<article><h2>Head</h2><pre> a\n b </pre></article>", "Head\n\na b"),
])
def test_small_pages(html, text):
    assert h.main_text(html) == text


def test_sections_of_an_article_stay_together():
    part = "<section><p>{}, a sentence with a comma, and some more of it to score.</p></section>"
    html = "<body><article>" + "".join(part.format(n) for n in ("One", "Two", "Three")) + "</article><div><p>Else.</p></div></body>"
    assert [b.split(",")[0] for b in h.main_text(html).split("\n\n")] == ["One", "Two", "Three"]


def test_link_lists_lose_to_text():
    links = "".join(f"<li><a href='/{i}'>some link with words, and a comma {i}</a></li>" for i in range(40))
    text = "<div><p>Real text, with a comma, in a paragraph that is long enough to win.</p></div>"
    assert h.main_text(f"<body><div><ul>{links}</ul></div>{text}</body>").startswith("Real text")


def test_deep_and_broken_pages_end():
    assert h.main_text("<div>" * 5000 + "<p>x" * 5000).count("x") == 5000
    assert h.main_text("<a>" * 5000 + "x</b>" * 5000)


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "u"), (None, "", "u"), (2, PAGE, None), (2, PAGE, None)],
                               "page_id bigint, html string, url string")
    found = h.extract(df, "page_id", "html", "url")
    rows = sorted(found.collect(), key=repr)
    assert [(r.doc_id, r.n_chars) for r in rows if not r.text] == [(1, 0), (None, 0)]
    assert sum(r.doc_id == 2 and r.n_chars == len(h.main_text(PAGE)) for r in rows) == 2
    assert h.extract(df.limit(0), "page_id").count() == 0


def test_given_pages(spark):
    """The given pages hold their text in one article element: headings and paragraphs."""
    import html
    import re

    for r in h.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), "page_id").join(
            spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumnRenamed("page_id", "doc_id"), "doc_id").collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("<br>", " ", inner))
        plain = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in plain if b)
