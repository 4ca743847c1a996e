import html
import math
import re

import pytest

import __spark_entry__ as E
from halyard.llm import html_density as H


def test_article_of_every_page(spark, sf):
    """The supplied pages mark their article; its blocks must come out whole and alone."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in E.queries()["op5_html_density"](spark, sf).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"<(?:/?p|/?h1|br)>", article)]
        assert r["text"] == "\n".join(filter(None, blocks)) and r["n_chars"] == len(r["text"])


def test_page_without_landmarks():
    page = """<body class="has-sidebar"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
    <div class="content"><h2>Title here</h2><div><p>First paragraph with a <a href=x>link</a> and much more text to read.</p>
    <p>Second &amp; longer paragraph, with&nbsp;many   words in it.</p></div><div><p>Third paragraph in another part, also long.</p>
    <ul><li>one item<li>two item</ul></div></div><div class="sidebar"><ul><li><a href=a>aaaa</a></ul></div>
    <div class="comments"><p>Nice article!! I liked it a lot, thanks for sharing this with us all.</p></div><footer>foot</footer></body>"""
    assert H.extract(page).split("\n") == [
        "Title here", "First paragraph with a link and much more text to read.", "Second & longer paragraph, with many words in it.",
        "Third paragraph in another part, also long.", "one item", "two item"]


PROSE = "<p>First paragraph with enough words to be read as running text here.</p><p>Second paragraph, also with enough words for it.</p>"
LINES = "First paragraph with enough words to be read as running text here.\nSecond paragraph, also with enough words for it."
MENU = "<div class='menu'><ul><li><a href=a>Home page</a><li><a href=b>About us</a><li><a href=c>Contact</a></ul></div>"


@pytest.mark.parametrize("page, want", [
    (f'<body><div class="page has-sidebar">{MENU}<h1>Title</h1>{PROSE}</div></body>', f"Title\n{LINES}"),
    (f"<body><form action=x>{MENU}<h1>Title</h1>{PROSE}<input name=q></form></body>", f"Title\n{LINES}"),
    (f"<body>{MENU}<form><article><h1>Title</h1>{PROSE}</article><button>Send</button></form></body>", f"Title\n{LINES}"),
    (f'<body><article>{PROSE}<section id="related-work"><h2>Related work</h2><p>Others did it.</p></section></article></body>', f"{LINES}\nRelated work\nOthers did it."),
    (f'<body><div>{PROSE}<h2 id="search-methods">Search methods</h2><p>How we searched for it all.</p></div></body>', f"{LINES}\nSearch methods\nHow we searched for it all."),
    (f'<body><div>{PROSE}<h2 id="header-files">Header files</h2><p>Where they are to be found.</p></div></body>', f"{LINES}\nHeader files\nWhere they are to be found."),
    (f'<body><article><div class="article-header"><h1>Title</h1></div>{PROSE}</article></body>', f"Title\n{LINES}"),
    (f'<body><div>{PROSE}<p class="share-price">The share price rose by a tenth today.</p></div></body>', f"{LINES}\nThe share price rose by a tenth today."),
    (f"<body><main><h1>Title</h1>{PROSE}<ul><li><a href=1>Ten things to see</a><li><a href=2>Another story here</a><li><a href=3>More of this</a></ul></main></body>", f"Title\n{LINES}"),
    (f'<body><article><h1>Title</h1>{PROSE}<div class="ad">Buy this now</div><div class="reader-comments"><p>Nice!</p></div></article></body>', f"Title\n{LINES}"),
])
def test_pages_that_names_and_landmarks_mislead(page, want):
    assert H.extract(page) == want


def test_supplied_pages_without_landmarks(spark, sf):
    """The supplied pages with plain containers instead of article, nav and footer: density finds the same text."""
    lost = extra = total = 0
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        plain = re.sub(r"<(/?)article>", r"<\1div>", r["html"])
        plain = re.sub(r"<nav>", '<div class="nav">', re.sub(r"<footer>", '<div class="site-footer">', plain))
        plain = re.sub(r"</(nav|footer)>", "</div>", plain)
        got, want = H.extract(plain).split("\n"), H.extract(r["html"]).split("\n")
        total += len(want)
        lost += sum(x not in got for x in want)
        extra += sum(x not in want for x in got)
    assert lost <= .01 * total and extra <= .01 * total


def plain_density(node, body):
    """The formula from counts taken by hand over a node's markup."""
    def count(n):
        chars = sum(len("".join(c.split())) for c in n.children if isinstance(c, str))
        parts = [count(c) for c in n.children if isinstance(c, H.Node)]
        c, t = chars + sum(p[0] for p in parts), 1 + sum(p[1] for p in parts)
        if n.tag == "a":
            return c, t, c, 1 + sum(p[3] for p in parts)
        return c, t, sum(p[2] for p in parts), sum(p[3] for p in parts)
    c, t, lc, lt = count(node)
    bc, _, blc, _ = count(body)
    if not c:
        return 0.0
    if not blc:
        return c / t
    base = math.log(c / max(c - lc, 1) * lc + blc / bc * c + math.e)
    return c / t * math.log(c / max(lc, 1) * t / max(lt, 1)) / math.log(base)


def test_densities_equal_the_formula(spark, sf):
    for r in spark.read.parquet(f"{sf}/pages.parquet").limit(40).collect():
        root = H.parse(r["html"])
        for n in H.measure(root):
            below = [plain_density(c, root) for c in n.children if isinstance(c, H.Node) and c.tag not in H.INLINE]
            assert abs(n.density - plain_density(n, root)) < 1e-9
            assert abs(n.sum - (sum(below) if any(below) else n.density)) < 1e-9


def test_density_adjusts_for_links():
    root = H.parse("<div><a href=x>twelve chars</a></div><p>twelve chars</p>")
    link, text = H.measure(root)[1], root.children[1]
    assert link.tag == "div" and link.density < text.density


def test_edges(spark):
    assert H.extract(None) == H.extract("") == H.extract("<!-- open <p>x") == H.extract("<script>x</p>") == ""
    assert H.extract("just text") == "just text" and H.extract("a<br>b") == "a\nb"
    assert H.extract('<p title="a>b">x &lt;y&gt; &#233; &unknown; &amp</p>') == "x <y> é &unknown; &"
    assert H.extract("<div>" * 5000 + "deep") == "deep"
    assert len(H.extract("<p>" + "word " * 200_000)) == 5 * 200_000 - 1
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert empty.select(H.main_text(spark, empty["html"])).count() == 0
    nulls = spark.createDataFrame([(None, None), (1, "<p>a"), (1, "<p>a")], "page_id long, html string")
    assert sorted(r[0] for r in nulls.select(H.main_text(spark, nulls["html"])).collect()) == ["", "a", "a"]
