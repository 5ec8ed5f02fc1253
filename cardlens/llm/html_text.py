"""Main text of web pages by composite text density.

Every block element of a page has its characters, its tags, and how many of either are links.
Composite density is characters per tag, lowered by the share of links. The subtree whose
children's densities add up to the most holds the article; the least density on the path from
it to the body is the threshold by which the siblings of that path belong to it too. Class and
id names lower a density, an article element raises it; only elements that can't hold an article
are left out before. All text of what was selected is returned, block by block, so that short
paragraphs stay.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import fresh

# Fixed values of HTML: which elements have no end tag, hold raw text, or flow within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes noscript iframe noembed".split())
#: All other elements, unknown and custom ones too, flow within a line.
BLOCK = frozenset(
    """address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html
    legend li main menu menuitem nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul""".split()
)
#: An open element of the value is closed by a start tag of the key's group.
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}, "body": {"head"},
}
_SCOPES = frozenset("table ul ol dl body html article section div main td th blockquote".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: Elements that never belong to an article.
BOILERPLATE = frozenset("head nav aside script style noscript template iframe svg canvas object button select input textarea dialog menu title noframes noembed audio video map".split())
#: These only outside an article; its own header may hold its title.
_EDGES = frozenset(("header", "footer"))
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Parts of a class or id that say what a block is ...
_SAYS = frozenset(
    """ad ads advert adverts advertisement advertising adbox adsense banner banners sponsor sponsored sponsors promo promos promotion cookie cookies consent gdpr notice notices
    popup modal overlay nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar widget widgets footer header masthead comment comments commentlist disqus reply replies respond
    share sharing social related recommend recommended recommendations newsletter subscribe signup login pagination pager skip toolbar copyright""".split()
)
#: ... and parts that may stand beside them. A name with any other part says something else.
_BESIDE = frozenset(
    """site page main left right top bottom side bar box boxes block blocks list container wrapper wrap inner outer area section item items link links btn button buttons unit slot panel
    message policy form content body text title post article entry global primary secondary mobile desktop google icons media count author thread holder row col column the and""".split()
)
#: One such part makes a class a reader's comment, whatever is inside.
_READERS = frozenset("comment comments commentlist reply replies respond disqus".split())
#: Elements of running text.
_PROSE = frozenset("p pre blockquote ul ol dl".split())
_CONTENT = frozenset("article post entry story content main body text page".split())
# A tag as HTML5 reads it: an unquoted value ends at white space or ">", a stray quote is part of
# a name, and a quote that is never closed counts as part of an unquoted value.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]++)"""
_ATTRIBUTE = re.compile(r"""[\s/]*+(=?[^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
_ATTRIBUTES = rf"(?:[\s/]*+=?[^\s/>=]++(?:\s*+=\s*+{_VALUE}?)?+|[\s/=]++)*+"
_TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(?:>|$)", re.S)
#: Weights of densities: blocks named as something else, and article elements.
NAMED, ARTICLE = 0.2, 2.0
_BREAK = "\n"


class Node:
    """A block element; ``parts`` holds its own text in order, and its block children."""

    __slots__ = ("tag", "parent", "parts", "skip", "named", "chars", "tags", "link_chars", "link_tags", "density")

    def __init__(self, tag: str, parent: Node | None, skip: bool, named: int = 0):
        #: skip: left out whatever it weighs; named: its name says that it is no article, which
        #: lowers its density
        self.tag, self.parent, self.skip, self.named = tag, parent, skip, named
        self.parts: list[str | tuple[str, bool] | Node] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0


def _attributes(raw: str) -> dict[str, str]:
    """Names in lower case and decoded values; of repeated names the first counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return out


def _self_closed(raw: str) -> bool:
    """Whether a tag ends in a slash of its own, not in one of an unquoted value."""
    if not raw.endswith("/"):
        return False
    last = None
    for last in _ATTRIBUTE.finditer(raw):
        pass
    return last is None or last[4] is None or last.end() < len(raw)


def _says(names: str) -> tuple[int, bool]:
    """Whether class or id names call a block boilerplate (1; 2 if readers wrote it) and whether it is
    surely reader comments, whatever is inside: names that speak of content as well are not that sure."""
    boilerplate = readers = content = doubtful = False
    for name in names.lower().split():
        parts = [x for x in re.split(r"[-_\d]+", name) if x]
        if parts and all(x in _SAYS or x in _BESIDE for x in parts) and any(x in _SAYS for x in parts):
            boilerplate = True
            of_readers = any(x in _READERS for x in parts)
            doubtful |= of_readers
            readers |= of_readers and not any(x in _CONTENT for x in parts)
        elif parts and all(x in _CONTENT for x in parts):
            content = True
    return (2 if doubtful else 1) if boilerplate and (doubtful or not content) else 0, readers


def _judge(tag: str, raw: str, in_article: bool) -> tuple[bool, int]:
    """(skip, named) of an element; see ``_says`` for the kinds of names."""
    if tag in BOILERPLATE or tag == "footer" or tag == "header" and not in_article:
        return True, 0
    attributes = _attributes(raw) if raw and not raw.isspace() else {}
    role = attributes.get("role", "").strip().lower()
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return tag not in ("html", "body"), 0
    boilerplate, readers = _says(f"{attributes.get('class', '')} {attributes.get('id', '')}")
    if tag in ("html", "body", "main"):
        return False, 0
    if readers:
        return True, 0
    if tag == "article":
        return False, 0
    return role in _ROLES and role != "form", boilerplate or int(tag == "form" or role == "form")


def parse(page: str) -> Node:
    """The tree of block elements. Unclosed and misplaced tags are closed as browsers do."""
    root = Node("html", None, False)
    node, at, links, inline_skip = root, 0, 0, []
    #: open elements, blocks and inline ones, as (tag, node or None)
    stack: list[tuple[str, Node | None]] = [("html", root)]
    articles = 0

    def text(s: str) -> None:
        if s and not inline_skip:
            node.parts.append((html.unescape(s), links > 0))

    def close(n: int) -> None:
        """Close the open elements from the n-th on."""
        nonlocal node, links, articles
        while len(stack) > n:
            tag, block = stack.pop()
            if block is not None:
                node = block.parent or root
                articles -= tag == "article"
            elif tag == "a":
                links -= 1
            if inline_skip and inline_skip[-1] > len(stack):
                inline_skip.pop()

    while True:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            return root
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, end = m[2].lower(), bool(m[1])
        if end:
            if tag == "p" and not any(t == "p" for t, _ in stack):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][0] in ("table", "td", "th") and tag not in BLOCK:
                    break
            continue
        if tag in ("html", "body") and tag in (t for t, _ in stack):
            continue
        if tag in _CLOSES_P or tag in _CLOSED_BY:
            closed = _CLOSED_BY.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                t = stack[i][0]
                if t in closed or t == "p" and tag in _CLOSES_P:
                    close(i)
                    if t == "p":
                        break
                elif t in _SCOPES or tag[0] == "h" and t == tag:
                    break
        if tag in ("br", "hr"):
            if not inline_skip:
                node.parts.append(_BREAK)
            continue
        if tag in VOID or tag not in ("p", "div") and _self_closed(m[3]):
            continue
        skip, named = _judge(tag, m[3], articles > 0)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|$)", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if tag not in BLOCK:
            stack.append((tag, None))
            links += tag == "a"
            node.tags += 1
            node.link_tags += tag == "a"
            if skip or named:
                inline_skip.append(len(stack))
            continue
        child = Node(tag, node, skip or bool(inline_skip), named)
        articles += tag == "article"
        node.parts.append(child)
        node = child
        stack.append((tag, child))


def _measure(root: Node) -> list[Node]:
    """Fill in characters, tags and links of every kept node; the nodes in document order."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(reversed([x for x in node.parts if isinstance(x, Node) and not x.skip]))
    for node in reversed(order):
        for x in node.parts:
            if isinstance(x, tuple):
                n = len("".join(x[0].split()))
                node.chars += n
                node.link_chars += n if x[1] else 0
            elif isinstance(x, Node) and not x.skip:
                node.chars += x.chars
                node.tags += 1 + x.tags
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags
    body = root
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in order:
        plain = node.chars - node.link_chars
        if node.chars:
            base = math.log(node.chars / max(plain, 1) * node.link_chars + share * node.chars + math.e)
            weight = math.log(max(node.chars / max(node.link_chars, 1) * max(node.tags, 1) / max(node.link_tags, 1), 1.0) + 1e-9) / base
            node.density = node.chars / max(node.tags, 1) * (max(weight, 0.0) if node.link_chars else 1 + math.log1p(node.chars) / base)
            node.density *= NAMED if node.named else 1.0
    return order


def _blocks(node: Node, kept: set[int], out: list[str]) -> None:
    """Append the text blocks of ``node``: runs of its own text between breaks and blocks. Named
    blocks inside are left out unless they are among ``kept``."""
    todo: list[Node | str] = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if x := " ".join(x.split()):
                out.append(x)
            continue
        pieces: list[Node | str] = []
        run: list[str] = []
        for part in x.parts:
            if isinstance(part, tuple):
                run.append(part[0])
            else:
                pieces.append("".join(run))
                run = []
                if isinstance(part, Node) and not part.skip and (not part.named or id(part) in kept):
                    pieces.append(part)
        pieces.append("".join(run))
        todo.extend(reversed(pieces))


def density_sums(order: list[Node]) -> dict[int, float]:
    """Of each node its unlinked characters outside child blocks and its children's densities.
    What is inside a named block counts by its weight, what is inside an article doubly."""
    sums, weight = {}, {}
    for node in order:  # parents come first
        inner = node.parent is not None and node.parent.tag == "article"
        weight[id(node)] = (NAMED if node.named else ARTICLE if node.tag == "article" and not inner else 1.0) * (weight[id(node.parent)] if node.parent else 1.0)
        own = sum(len("".join(x[0].split())) for x in node.parts if isinstance(x, tuple) and not x[1])
        sums[id(node)] = weight[id(node)] * (own + sum(x.density for x in node.parts if isinstance(x, Node) and not x.skip))
    return sums


def _outermost_named(heart: Node) -> list[Node]:
    """Blocks in ``heart`` whose names speak of boilerplate, though not of readers, and that lie in no other named one."""
    out, todo = [], [heart]
    while todo:
        for x in todo.pop().parts:
            if isinstance(x, Node) and not x.skip:
                if not x.named:
                    todo.append(x)
                elif x.named == 1 and x.tag != "form":
                    out.append(x)
    return out


def main_text(page: str | None) -> str:
    """The article of a page: its blocks, white space made single, joined by newlines.

    The subtree with the greatest density sum (ties: the first in document order) is the heart. The path from it leads to the
    body, or to the article element (where there is none, the main element) that it lies in, which is then
    taken whole: what was found to hold the densest subtree needs no threshold for its short blocks. Elsewhere the siblings of
    the path belong to the text if their density reaches the least one on the path, and so do
    headings beside it and, below the body, prose beside it that isn't mostly links. A named block (menu, advert, form ...)
    is left out, wherever it is, unless the path leads through it, it holds over half of the heart's characters, or all such
    blocks that readers didn't write do so together: names that would take most of an article say something else.
    """
    root = parse(page or "")
    order = _measure(root)
    if not root.chars:
        return ""
    sums = density_sums(order)
    best = max(order, key=lambda n: sums[id(n)])
    path = [best]
    while path[-1].parent is not None and path[-1].tag != "body":
        path.append(path[-1].parent)
    top = max((i for i, n in enumerate(path) if n.tag == "article"), default=None)
    if top is None:
        top = max((i for i, n in enumerate(path) if n.tag == "main"), default=None)
    threshold = min(n.density for n in path)
    heart = best if top is None else path[top]
    kept = {id(n) for n in order if n.named and 2 * n.chars > heart.chars}.union(map(id, path))
    outer = _outermost_named(heart)
    if 2 * sum(n.chars for n in outer) > heart.chars:
        kept.update(map(id, outer))
    chosen = {id(best)}
    if top is not None:
        chosen = {id(heart)}
        beside = heart.parent.parts if heart.parent else []
        if heart.tag == "article":
            chosen.update(id(x) for x in beside if isinstance(x, Node) and not x.skip and x.tag == "article" and x.density >= threshold)
    else:
        for lower, upper in zip(path, path[1:]):
            for x in upper.parts:
                if isinstance(x, Node) and x is not lower and not x.skip and not x.named and x.density > 0 and (x.density >= threshold or x.tag[0] == "h" and x.tag[1:].isdigit() and not x.link_chars or upper.tag != "body" and x.tag in _PROSE and 2 * x.link_chars < x.chars):
                    chosen.add(id(x))
    out: list[str] = []
    for node in order:
        if id(node) in chosen:
            _blocks(node, kept, out)
    return "\n".join(out)


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` (empty if the page has none) and ``n_chars`` in place of the html
    column. Null html counts as empty. Rows stay as they are otherwise, repeated rows and empty
    tables included; a text or n_chars column of the input is replaced, any other stays. A page of
    any length is parsed whole, in memory that grows with it alone."""
    kept = [c for c in pages.columns if c.lower() not in (html_col.lower(), "text", "n_chars")]
    page = fresh(pages, "_html")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(kept))]
            out = [batch.column(i) for i in range(len(kept))] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(out, [*kept, "text", "n_chars"])

    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept)
    return pages.select(*[F.col(f"`{c}`") for c in kept], F.col(html_col).alias(page)).mapInArrow(run, f"{fields}{', ' if kept else ''}text string, n_chars long")
