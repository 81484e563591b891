"""Main text of web pages by tree scoring.

A page becomes a tree of elements.  Every block of text (a paragraph, heading, list item, ...) passes points to its ancestors:
one for being there, one per comma, one per hundred characters up to three; the parent gets them whole, the grandparent half,
further ancestors less.  A container's points are discounted by its share of text inside links.  The best container is the
article, or the ``article`` or ``main`` it lies in; siblings that score well beside it, and headings, lists and paragraphs with few
links, however short, are kept with it.  Elements that are never
article (menus, headers outside it, footers, asides, forms, scripts, and those whose class or id says advert, comments, cookie
notice, ...) are cut out beforehand.  A class that says sidebar, header, widget, ... cuts an element only if it is not around the
article: themes name whole pages so.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from caseloom.llm.bpe import by_size
from caseloom.llm.common import map_batches

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_NEVER = frozenset(
    "script style noscript template iframe object embed svg math canvas audio video head title textarea xmp noembed noframes "
    "nav footer aside form button select option input dialog menu fieldset label".split()
)
_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th caption figcaption div section article main body html center address "
    "ul ol dl table tbody thead tfoot tr figure header hgroup details summary hr br".split()
)
_PARAGRAPHS = frozenset("p pre td th blockquote li dd h1 h2 h3 h4 h5 h6 figcaption".split())
# What closes an open paragraph or item of the same kind (end tags that pages leave out).
_CLOSES_P = frozenset(
    "p div ul ol dl table section article aside nav footer header main form h1 h2 h3 h4 h5 h6 pre blockquote hr figure address "
    "details fieldset menu".split()
)
_ITEM_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_SAME_ITEM = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

# Words of a class or id that say an element is no article.  Those of the first kind do so wherever they stand.  Those of the second
# often name a page's layout too: an element that holds most of the page's article stays.  Of these, the third kind is for
# elements outside an article only; inside one they name a part of it.
_CLUTTER = (
    "ad|ads|advert\\w*|adsense|sponsor\\w*|promo\\w*|breadcrumb\\w*|comments?|commentlist|disqus|respond|replies|cookies?|consent|notice|"
    "notification|popup|newsletter|subscribe|subscription|share|sharing|related|recommend\\w*|pagination|pager|login|signup|outbrain|taboola"
)
_LAYOUT = (
    "nav|navbar|navigation|menu|menubar|sidebar\\w*|side|aside|footer\\w*|banner|alert|modal|overlay|social|widget|search|toolbar|skip"
)
_OUTSIDE = "header|masthead|legal|copyright|disclaimer"
_UNWANTED = re.compile(
    rf"(?:^|[_-])(?:(?P<clutter>{_CLUTTER})|(?P<layout>{_LAYOUT})|(?P<outside>{_OUTSIDE}))(?=$|[_-])", re.I
)
_WITHOUT = re.compile(r"(?:no|not|has|with|without)[_-]", re.I)  # "no-sidebar" and the like speak of the page
_KEPT_BESIDE = frozenset("p pre blockquote ul ol dl table figure hgroup h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_CONTENT = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|text|body)(?=$|[\s_-])", re.I)
# Possessive throughout: a tag that does not end is given up after one look.
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*+>|<\?[^>]*+>", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_END = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in _RAW}
DEEPEST = 512  # elements nested deeper lie side by side, as in browsers
REACH = 32  # ancestors that a block passes points to: the last gets less than a hundred-thousandth
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
MOST_LINKED = 0.25  # share of text in links up to which a part beside the best container reads like prose
_SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "mark", "parent", "children", "score", "dead", "layout", "inside", "depth", "size", "linked", "articles", "prose")

    def __init__(self, tag: str, mark: str, parent: "Node | None", dead: bool):
        self.tag, self.mark, self.parent, self.dead = tag, mark, parent, dead
        self.children: list[Node | str] = []
        self.score = 0.0
        self.size = self.linked = self.articles = self.prose = 0
        self.layout = False  # its class names a part of the page's layout
        self.inside = parent is not None and (parent.inside or tag in ("article", "main"))
        self.depth = parent.depth + 1 if parent is not None else 0


def _kind(mark: str, inside: bool) -> str | None:
    """'clutter', 'layout' or None, from the words of a class and id."""
    kinds = {m.lastgroup for token in mark.split() if not _WITHOUT.match(token) for m in _UNWANTED.finditer(token)}
    if inside:
        kinds.discard("outside")
    return "clutter" if "clutter" in kinds else "layout" if kinds else None


def parse(page: str) -> Node:
    """A tolerant tree: void elements, raw text elements, and end tags that are missing or have no start.

    Every character is looked at a bounded number of times: quotes count until a tag comes whose quotes never close."""
    root = Node("#root", "", None, False)
    node, at, text = root, 0, 0
    end, last = len(page), page.rfind(">")
    opened: Counter[str] = Counter()  # open elements by tag
    flat: Counter[str] = Counter()  # elements too deep to be opened
    pattern = _TAG
    while True:
        at = page.find("<", at)
        if at < 0 or (at > last and not page.startswith("<!--", at)):
            node.children.append(page[text:])
            break
        m = _OTHER.match(page, at) or pattern.match(page, at)
        if m is None and pattern is _TAG and page[at + 1 : at + 2].strip("/").isalpha():
            pattern = _PLAIN_TAG
            m = pattern.match(page, at)
        if m is None:
            at += 1
            continue
        if at > text:
            node.children.append(page[text:at])
        at = text = m.end()
        if m.re is _OTHER:
            continue
        tag = m.group(2)
        tag = tag.lower()
        if m.group(1):
            if flat[tag]:
                flat[tag] -= 1
            elif opened[tag]:
                up = node
                while up.tag != tag:
                    up = up.parent
                node = _closed(node, up, opened)
            continue
        if tag in _CLOSES_P and opened["p"]:
            up = node
            while up.tag not in ("p", "#root", "td", "th", "li", "button", "object", "div", "article", "section", "body"):
                up = up.parent
            if up.tag == "p":
                node = _closed(node, up, opened)
        if tag in _SAME_ITEM:
            up = node
            while up.tag not in _SAME_ITEM[tag] and up.tag not in _ITEM_SCOPE[tag] and up is not root:
                up = up.parent
            if up.tag in _SAME_ITEM[tag]:
                node = _closed(node, up, opened)
        attributes = m.group(3)
        mark, kind, dead = "", None, node.dead or tag in _NEVER
        if attributes and attributes != "/" and not dead:
            found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
            mark = f"{found.get('class', '')} {found.get('id', '')}"
            style = found.get("style", "").replace(" ", "").lower()
            dead = (
                found.get("role", "").lower() in _ROLES
                or found.get("aria-hidden") == "true"
                or "display:none" in style
                or "visibility:hidden" in style
            )
            if tag not in ("html", "body", "article", "main"):
                kind = _kind(mark, node.inside)
        fresh = Node(tag, mark, node, dead or kind == "clutter")
        fresh.layout = kind == "layout"
        node.children.append(fresh)
        if tag in _RAW:
            close = _END[tag].search(page, at)
            at = text = close.end() if close else end
        elif tag not in _VOID and not (attributes and attributes.endswith("/") and tag not in _BLOCKS):
            if fresh.depth < DEEPEST:
                node = fresh
                opened[tag] += 1
            else:
                flat[tag] += 1
    return root


def _closed(node: Node, up: Node, opened: Counter[str]) -> Node:
    """Close all elements from ``node`` up to ``up``; what is open then."""
    while node is not up:
        opened[node.tag] -= 1
        node = node.parent
    opened[up.tag] -= 1
    return up.parent


def _cut_layout(root: Node) -> None:
    """Elements with a layout's class go, but for those around the longest article or main, or if there is none, those that
    hold over half of the page's unlinked text."""
    nodes = _measure(root)
    articles = [n for n in nodes if n.tag in ("article", "main")]
    around = max(articles, key=lambda n: n.prose, default=None)
    kept = set()
    while around is not None:
        kept.add(id(around))
        around = around.parent
    for node in nodes:
        if node.layout and id(node) not in kept and (articles or 2 * node.prose <= root.prose):
            node.dead = True


def _blocks(node: Node) -> list[tuple[Node, str]]:
    """(container, text) of the blocks below a node in page order; white space inside a block is one space."""
    out: list[tuple[Node, str]] = []
    words: list[str] = []
    owner = node

    def flush() -> None:
        text = _SPACES.sub(" ", html.unescape("".join(words))).strip()
        words.clear()
        if text:
            out.append((owner, text))

    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        current, k = stack.pop()
        if k == 0 and current.tag in _BLOCKS:
            flush()
            owner = current
        while k < len(current.children):
            child = current.children[k]
            k += 1
            if isinstance(child, str):
                words.append(child)
            elif not child.dead:
                if child.tag == "br":
                    words.append(" ")
                    continue
                stack.append((current, k))
                stack.append((child, 0))
                break
        else:
            if current.tag in _BLOCKS:
                flush()
                owner = current.parent or node
    flush()
    return out


def _measure(root: Node) -> list[Node]:
    """Text sizes and linked text sizes of all live nodes; returns them, children first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node) and not c.dead]
    for node in reversed(order):
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        below = [c for c in node.children if isinstance(c, Node) and not c.dead]
        node.size = own + sum(c.size for c in below)
        node.linked = node.size if node.tag == "a" else sum(c.linked for c in below)
        node.articles = 1 if node.tag == "article" else sum(c.articles for c in below)
        node.prose = node.size - node.linked
    return order[::-1]


def _link_density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def _article(best: Node) -> Node:
    """The outermost live article or main the best container lies in, if few of its words are links and no other article is
    in it (a list of articles is none); else the container."""
    out, up = best, best
    while up is not None:
        if up.tag in ("article", "main") and _link_density(up) < MOST_LINKED and (up is best or up.articles <= 1):
            out = up
        up = up.parent
    return out


def main_text(page: str | None) -> str:
    """Text of the article: blocks in page order joined by one space; '' if there is none."""
    root = parse(page or "")
    _cut_layout(root)
    nodes = _measure(root)
    blocks = _blocks(root)
    if not blocks:
        return ""
    scored: dict[int, Node] = {}
    for block, text in blocks:
        points = 1 + text.count(",") + min(len(text) // 100, 3)
        weight, up = 1.0, block.parent if block.tag in _PARAGRAPHS else block
        for _ in range(REACH):
            if up is None or up.tag in ("#root", "html"):
                break
            if up.tag not in ("p", "b", "i", "em", "strong", "span", "a"):  # inline elements are no containers
                up.score += points * weight
                scored[id(up)] = up
                weight = weight / 2 if weight > 0.5 else weight / 1.5
            up = up.parent
    for node in scored.values():
        if node.tag in ("article", "main") or _CONTENT.search(node.mark):
            node.score += 25
        node.score *= 1 - _link_density(node)
    best = max((n for n in nodes if id(n) in scored), key=lambda n: n.score, default=root)
    best = _article(best)
    chosen = [best]
    if best.parent is not None:
        least = max(10.0, best.score * 0.2)
        chosen = []
        for sibling in best.parent.children:
            if isinstance(sibling, str) or sibling.dead:
                continue
            prose = sibling.tag in _KEPT_BESIDE and _link_density(sibling) < MOST_LINKED
            if sibling is best or (id(sibling) in scored and sibling.score >= least) or prose:
                chosen.append(sibling)
    return " ".join(text for part in chosen for _, text in _blocks(part))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; NULL and empty pages give '' and 0.

    Rows are read one by one, so NULL ids and urls (kept), repeated rows and further columns (left out) change nothing; an
    empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 2):
                texts = [main_text(page.as_py()) for page in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
