"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Every paragraph passes points for its length and its commas to its
ancestors, fully to the parent and less the further up; each container's points are discounted by the share
of its text that is link text. The best container, or the article that holds it, is kept together with those
of its siblings that score well or read like prose; menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments inside are left out.

Defined cases: a null or empty page, or one without text, gives an empty text; unclosed, crossed and stray tags
are read as browsers do for the common cases; a page cut off in mid-tag loses that tag only; repeated rows and
null ids are extracted one by one. A sibling of the best container with under a fifth of its points is left out unless it
is a paragraph, heading or quote. A form, header, label or fieldset around most of the page's prose is kept.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg annotation annotation-xml select object audio video canvas".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead tr ul".split()
)
#: Elements whose start ends an open paragraph.
_ENDS_P = _BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "option", "legend", "body", "html"}
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_DROPPED = frozenset("head nav footer aside button input menu dialog".split())
#: Elements that are dropped like the above unless they hold the page's article or most of its prose.
_WRAPPERS = frozenset("form header label fieldset".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
#: Words in class or id that mark what isn't the article.
_HINTS = frozenset(
    "ad ads advert advertisement advertising adverts adsense banner sponsor sponsored promo promotion nav navbar"
    " navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent gdpr notice"
    " popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended"
    " comment comments disqus discussion reply replies respond pagination pager widget toolbar search form".split()
)
#: Hints that name sections of articles as well; these are kept if they read like prose.
_WEAK = frozenset("discussion related form search share sharing social promotion login signup banner header footer".split())
#: With these at the start or the end, a name tells of another element: with-sidebar, comments-open.
_STATES = (frozenset("with has no without".split()), frozenset("open closed enabled disabled".split()))
#: Elements whose class or id is no hint.
_UNHINTED = frozenset("body html main p span h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p pre td blockquote li dd h2 h3 h4 div section article".split())


class _Node:
    __slots__ = ("tag", "parent", "children", "dropped", "article", "chars", "link_chars", "points", "hints")

    def __init__(self, tag: str, parent: "_Node | None", dropped: bool, article: bool):
        self.tag, self.parent, self.dropped, self.article = tag, parent, dropped, article
        self.children: list = []
        self.chars = self.link_chars = 0
        self.points = 0.0
        self.hints: frozenset[str] = frozenset()


def _unwanted(tag: str, attributes: str) -> bool:
    if tag in _DROPPED:
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "role" and value.lower() in _ROLES:
            return True
        elif name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return bool(re.search(r"(?:^|\s)hidden(?:\s|/?>|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)))


def _hints(tag: str, attributes: str) -> frozenset[str]:
    """The hint words in class and id."""
    found: set[str] = {f"<{tag}>"} if tag in _WRAPPERS else set()
    if tag in _UNHINTED or "=" not in attributes:
        return frozenset(found)
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            names = [[w.lower() for w in _NAMES.findall(x)] for x in (a or b or c).split()]
            if any("article" in words for words in names):
                continue
            for words in names:
                if words and words[0] not in _STATES[0] and words[-1] not in _STATES[1]:
                    found |= _HINTS.intersection(words)
    return frozenset(found)


def _drop_hinted(root: _Node, by_name: bool = True) -> None:
    """Drops hinted elements, unless they hold the page's article or, with weak hints only, read like prose.

    A form, header, label or fieldset stays if it is around paragraphs that are most of the page's prose, and in no
    article. Without ``by_name`` the words in class and id are no hints.
    """
    order = _score(root)
    articles: set[int] = set()  # elements around an article
    paragraphs: set[int] = set()  # and around a paragraph
    for node in reversed(order):
        if node.parent is not None:
            if node.article or id(node) in articles:
                articles.add(id(node.parent))
            if node.tag == "p" or id(node) in paragraphs:
                paragraphs.add(id(node.parent))
    page = max(1, root.chars - root.link_chars)
    within: set[int] = set()  # elements inside an article
    for node in order:
        up = node.parent
        if up is not None and (up.article or id(up) in within):
            within.add(id(node))
        if up is not None and up.dropped:
            node.dropped = True
        elif node.hints and not node.dropped:
            prose, density = node.chars - node.link_chars, node.link_chars / node.chars if node.chars else 1.0
            holds = id(node) in articles or node.article
            if node.tag in _WRAPPERS:
                most = prose >= 0.5 * page and density < 0.25 and id(node) in paragraphs and id(node) not in within
                node.dropped = not (holds or most)
            elif by_name:
                node.dropped = not (holds or prose >= 0.9 * page or node.hints <= _WEAK and prose >= 100 and density < 0.25)
    for node in order:
        node.chars = node.link_chars = 0
        node.points = 0.0


def parse(page: str) -> _Node:
    """The element tree; text is kept as strings among the children."""
    root = node = _Node("#root", None, False, False)
    at, n = 0, len(page)
    opened: Counter[str] = Counter()  # tags of the open elements; an end tag without one is passed over at once

    def leave(up: _Node) -> _Node:
        """Close all elements down to ``up`` and it too."""
        at = node
        while at is not up:
            opened[at.tag] -= 1
            at = at.parent
        opened[up.tag] -= 1
        return up.parent

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            node.children.append(page[at:])
            break
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if not opened[tag]:
                continue
            up = node
            while up.tag not in (tag, "#root"):
                if tag not in _BLOCK and up.tag in _BLOCK:  # an inline end tag doesn't close blocks
                    break
                up = up.parent
            if up.tag == tag:
                node = leave(up)
            continue
        if tag in _RAW:
            if not m[3].endswith("/>") or tag not in ("svg", "math"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag in _ENDS_P and opened["p"]:
            up = node
            while up.tag not in ("p", "#root", "button", "td", "th", "table") and (up.tag not in _BLOCK or up.tag == "p"):
                up = up.parent
            if up.tag == "p":
                node = leave(up)
        if tag in _ENDS:
            closed, scope = _ENDS[tag]
            up, found = node, None
            while any(map(opened.__getitem__, closed)) and up.tag not in scope and up.tag != "#root":
                if up.tag in closed:
                    found = up
                up = up.parent
            if found is not None:
                node = leave(found)
        if tag in ("html", "body"):
            continue
        child = _Node(tag, node, node.dropped or _unwanted(tag, m[3]), tag in ("article", "main") or "main" in m[3] and bool(re.search(r"role\s*=\s*[\"']?main", m[3])))
        if not child.dropped:
            child.hints = _hints(tag, m[3])
        node.children.append(child)
        if tag not in _VOID and not (m[3].endswith("/>") and tag not in _BLOCK):
            node = child
            opened[tag] += 1
    return root


def _score(root: _Node) -> list[_Node]:
    """Character counts of every element, and points of the containers; returns the elements in page order."""
    order: list[_Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, _Node)]
    own: dict[int, list[str]] = {}
    for node in order:
        if node.dropped:
            continue
        pieces = [c for c in node.children if isinstance(c, str)]
        node.chars = sum(len(c.strip()) for c in pieces)
        node.link_chars = node.chars if node.tag == "a" else 0
    for node in reversed(order):
        if node.dropped:
            continue
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars if node.tag != "a" else node.chars
        commas = sum(c.count(",") for c in node.children if isinstance(c, str))
        own[id(node)] = [commas]
        if node.tag not in _BLOCK and node.parent is not None:
            continue
    block: dict[int, _Node] = {}  # the block that each element's text belongs to
    for node in order:  # commas of inline descendants belong to their paragraph
        inline = node.parent is not None and node.tag not in _BLOCK
        block[id(node)] = block[id(node.parent)] if inline else node
        if inline and not node.dropped:
            own[id(block[id(node)])][0] += own[id(node)][0]
    for node in order:
        if node.dropped or node.tag not in _PARAGRAPHS or node.parent is None:
            continue
        if any(isinstance(c, _Node) and c.tag in _BLOCK and not c.dropped and c.chars for c in node.children):
            if node.tag not in ("p", "blockquote", "td", "li", "dd"):
                continue
        prose = node.chars - node.link_chars
        if prose < 1:
            continue
        points = (1 + own[id(node)][0] + min(prose / 100, 3)) * (prose / node.chars)
        up, level = node.parent, 0
        while up is not None and level < 6:
            up.points += points / (1, 2, 4, 8, 16, 32)[level]
            up, level = up.parent, level + 1
    for node in order:
        if node.chars:
            node.points *= 1 - node.link_chars / node.chars
    return order


def _blocks(nodes: list[_Node]) -> list[str]:
    """The text blocks of the kept elements, in page order."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        if text:
            out.append(text)
        held.clear()

    for top in nodes:
        stack: list = [top]
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                held.append(x)
            elif x.tag == "br":
                held.append(" ")
            elif not x.dropped:
                if x.tag in _BLOCK or x is top:
                    flush()
                    stack.append(None)
                stack += reversed(x.children)
    flush()
    return out


def extract(page: str | None) -> str:
    """The main text of one page; without regard to hints if they leave nothing."""
    if not page:
        return ""
    for by_name in (True, False):
        root = parse(page)
        _drop_hinted(root, by_name)
        text = _main_text(root)
        if text:
            return text
    return ""


def _main_text(root: _Node) -> str:
    order = _score(root)
    scored = [n for n in order if n.points > 0 and not n.dropped]
    if not scored:
        return "\n".join(_blocks([root]))
    best = max(scored, key=lambda n: n.points)
    up = best
    while up is not None and not up.article:
        up = up.parent
    if up is not None:
        best = up
    if best.parent is None:
        return "\n".join(_blocks([best]))
    limit = max(1.0, 0.2 * best.points)
    kept = []
    for node in best.parent.children:
        if not isinstance(node, _Node) or node.dropped:
            continue
        density = node.link_chars / node.chars if node.chars else 1.0
        prose = node.tag in ("p", "h1", "h2", "pre", "blockquote") and node.chars and density < 0.25
        if node is best or node.points >= limit or (prose and not best.article):
            kept.append(node)
    return "\n".join(_blocks(kept))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(x.as_py()) for x in batch.column("html")]
        yield pa.record_batch(
            {
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "text": pa.array(texts, pa.string()),
                "n_chars": np.array([len(x) for x in texts], np.int64),
            }
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
