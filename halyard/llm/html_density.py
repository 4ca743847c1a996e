"""Main-text extraction by composite text density.

A page becomes a small DOM.  Parts that are never the article go first: scripts, styles, controls, menus, page
headers and footers, sidebars, notices, adverts and reader comments, by element, role, or a class or id whose words all
say so (``related-posts``, not ``related-work``).  Names are weak evidence: they never cut headings, paragraphs or what
stands in running text, nor a part that holds an article or main element, the page's first heading or most of a page's
text; a form around any of these is only unwrapped.  For every node that is left

    density = C / T * log_b(C / LC * T / LT),   b = ln(C / (C - LC) * LC + LC_body / C_body * C + e)

with C characters and T tags below it, LC and LT those of links (each at least 1): characters per tag, link
text counting against it.  On a page without link text the density is C / T.  A node's sum is the sum of its
children's densities (its own if it has none; inline elements are no children of their own).  The node of the greatest sum is picked; the smallest density on
the path from the body to it is the threshold; every other subtree at or above the threshold gives its node of
the greatest sum too.  A pick inside an article element stands for that element, which is all article; in a main
element density decides.  Of picks outside articles, blocks of links alone (teasers) go.

The text of the picked nodes: character references decoded, white space inside a block one space, trimmed,
blocks (and what stands between line breaks) joined by a new line in page order.  Null and empty pages, and
pages with nothing left, give the empty text.  Unclosed tags end where HTML ends them; text after an unclosed
comment or script is part of that.  Repeated rows give equal texts; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.llm.common import small_batches

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
BLOCKS = frozenset(("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                    "h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr".split())
CLOSES_P = BLOCKS - frozenset("br td th tr tbody thead tfoot caption body html".split())
# a start tag on the left ends an open element on the right, up to the elements that confine it
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

# Parts that are not the article, whatever they hold but an article or main element.
NOISE_TAGS = frozenset("head nav aside footer button select input label fieldset svg canvas object audio video dialog menu map".split()) | RAW
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar".split())
# Names of parts that are not the article: a class or id counts if all its words stand here, one of them in the first list.
NOISE_WORDS = frozenset(
    ("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
     "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar "
     "header masthead topbar footer footnav copyright sidebar sidebars aside widget widgets related recommended "
     "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription paywall alert "
     "comment comments disqus respond replies reply share sharing social login signup search skip").split())
PLAIN_WORDS = frozenset(
    ("site page top bottom left right main global primary secondary box block wrap wrapper container list links link bar section area item items "
     "post posts article articles story stories content inner outer form thread button buttons icons icon slot unit native col column row group "
     "media bottom sticky mobile desktop user reader the by on of in to").split())
PARTS = frozenset("div section ul ol dl table form iframe figure details center td".split())  # what a name may cut
LINK_BLOCKS = frozenset("div section ul ol dl table p".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LANDMARKS = frozenset(("article", "main"))
HARD, SOFT = 2, 1
MOST = 0.5        # of a page's text, which no name cuts
TEASER = 0.8      # of a block's text in links

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>?", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "parent", "children", "noise", "chars", "tags", "link_chars", "link_tags", "density", "sum", "landmark", "title")

    def __init__(self, tag: str, parent: Node | None, noise: int):
        self.tag, self.parent, self.noise = tag, parent, noise
        self.children: list = []  # nodes and strings in page order
        self.chars = self.link_chars = self.link_tags = 0
        self.tags, self.density, self.sum, self.landmark, self.title = 1, 0.0, 0.0, tag in LANDMARKS, tag == "h1"


def noise_of(tag: str, attributes: str, inside_article: bool) -> int:
    """HARD for parts that are never the article, SOFT for those that a name or a form hints at, else 0."""
    if tag in NOISE_TAGS or tag == "header" and not inside_article:
        return HARD
    level = SOFT if tag == "form" else 0
    if not attributes or tag in ("html", "body", "article", "main", "a"):
        return level
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "role" and value.lower() in NOISE_ROLES or name == "hidden":
            return HARD
        if name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return HARD
        if name in ("class", "id") and tag in PARTS:
            for token in value.split():
                words = [w.lower() for w in NAME_WORD.findall(token)]
                if any(w in NOISE_WORDS for w in words) and all(w in NOISE_WORDS or w in PLAIN_WORDS or w.isdigit() for w in words):
                    level = SOFT
    return level


def parse(page: str) -> Node:
    """The page's tree; every element ends where its end tag, an implied end or its parent's end stands."""
    root = node = Node("html", None, 0)
    depth_in_article, at, end = 0, 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        text = page[at:m.start() if m else end]
        if text:
            node.children.append(html.unescape(text) if "&" in text else text)
        if m is None:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            up = node
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                while True:
                    depth_in_article -= node.tag in LANDMARKS
                    done, node = node is up, node.parent
                    if done:
                        break
            continue
        if tag in ("html", "body"):
            continue  # the root stands for both
        ended, within = ENDS.get(tag, (None, None))
        if tag in CLOSES_P:
            ended, within = (ended or set()) | {"p"}, (within or set()) | {"button", "td", "th", "li", "div", "article", "section"} - {tag}
        if ended:
            up = node
            while up is not root and up.tag not in ended and up.tag not in within:
                up = up.parent
            if up.tag in ended:
                while node is not up:
                    depth_in_article -= node.tag in LANDMARKS
                    node = node.parent
                node = up.parent
        new = Node(tag, node, noise_of(tag, m[3], depth_in_article > 0))
        node.children.append(new)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            node = new
            depth_in_article += tag in LANDMARKS
    return root


def page_order(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append(n)
        stack.extend(c for c in reversed(n.children) if isinstance(c, Node))
    return out


def prune(root: Node) -> None:
    """Take out noise; see the module's text for what stays."""
    order = page_order(root)
    for n in reversed(order):
        if n.parent is not None:
            n.parent.landmark = n.parent.landmark or n.landmark
            n.parent.title = n.parent.title or n.title
    titles = sum(n.tag == "h1" for n in order)
    for n in order:
        n.children = [c for c in n.children if not (isinstance(c, Node) and c.noise == HARD and not (c.landmark and c.tag not in NOISE_TAGS))]
    sizes: dict[int, int] = {}
    order = page_order(root)
    for n in reversed(order):
        sizes[id(n)] = sum(sizes[id(c)] if isinstance(c, Node) else len("".join(c.split())) for c in n.children)
    whole = sizes[id(root)]
    for n in order:
        marked = root.landmark  # where the page says what is article, size proves nothing

        def goes(c) -> bool:
            return c.noise == SOFT and not (c.landmark or c.title and titles == 1 or not marked and sizes[id(c)] > MOST * whole
                                            or c.tag == "form" and sizes[id(c)] > MOST * whole)
        n.children = [c for c in n.children if not (isinstance(c, Node) and goes(c))]


def measure(root: Node) -> list[Node]:
    order = page_order(root)
    for n in reversed(order):
        for c in n.children:
            if isinstance(c, Node):
                n.chars += c.chars
                n.tags += c.tags
                n.link_chars += c.link_chars
                n.link_tags += c.link_tags
            else:
                n.chars += len("".join(c.split()))
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.link_tags + 1
    for n in reversed(order):
        if n.chars:
            n.density = n.chars / n.tags
            if root.link_chars:
                base = math.log(n.chars / max(n.chars - n.link_chars, 1) * n.link_chars + root.link_chars / root.chars * n.chars + math.e)
                n.density *= math.log(n.chars / max(n.link_chars, 1) * n.tags / max(n.link_tags, 1)) / math.log(base)
        below = [c.density for c in n.children if isinstance(c, Node) and c.tag not in INLINE]
        n.sum = sum(below) if any(below) else n.density
    return order


def greatest(order: list[Node]) -> Node:
    """The node of the greatest sum, the outermost of equals; inline elements are text of the block around them."""
    return max((n for n in order if n.tag not in INLINE), key=lambda n: n.sum, default=order[0])


def pick(root: Node) -> set[int]:
    """ids of the nodes whose whole subtrees are the article."""
    best = greatest(measure(root))
    threshold, n = best.density, best
    while n is not None:
        threshold, n = min(threshold, n.density), n.parent
    picked: set[int] = set()

    def add(node: Node) -> None:
        top, n = node, node
        while n is not None:
            if n.tag == "article":
                top = n
            n = n.parent
        picked.add(id(top))
    add(best)
    path, n = set(), best
    while n is not None:
        path.add(id(n))
        n = n.parent
    stack = [root]
    while stack:
        n = stack.pop()
        if id(n) in picked:
            continue
        if id(n) in path:
            stack.extend(c for c in n.children if isinstance(c, Node))
        elif n.chars and n.density >= threshold and n.tag != "a":
            add(greatest(page_order(n)))
    return picked


def teaser(n: Node) -> bool:
    """Whether a block is links alone: at least three, with nearly all of its text."""
    return n.tag in LINK_BLOCKS and n.link_tags >= 3 and n.link_chars >= TEASER * n.chars


def text_of(root: Node, picked: set[int]) -> str:
    """Blocks of the picked subtrees in page order, one a line; link blocks only in articles."""
    lines: list[str] = []
    words: list[str] = []

    def end_block() -> None:
        line = " ".join("".join(words).split())
        if line:
            lines.append(line)
        words.clear()
    stack: list = [(root, 0)]  # 1 inside a pick, 2 inside an article that is picked
    while stack:
        n, inside = stack.pop()
        if n is None:
            end_block()
        elif isinstance(n, str):
            if inside:
                words.append(n)
        else:
            inside = max(inside, id(n) in picked)
            if inside and n.tag == "article":
                inside = 2
            if inside == 1 and teaser(n):
                continue
            if n.tag in BLOCKS:
                end_block()
                stack.append((None, 0))
            stack.extend((c, inside) for c in reversed(n.children))
    end_block()
    return "\n".join(lines)


def extract(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    prune(root)
    return text_of(root, pick(root))


def main_text(spark: SparkSession, page: Column) -> Column:
    """The main text (string) of each whole page."""
    small_batches(spark)

    @F.pandas_udf(T.StringType())
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(p) for p in pages], dtype=object)
    return run(page)
