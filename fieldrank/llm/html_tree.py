"""A page as a tree of elements, and the text blocks of a part of it."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Names of elements and words of the web.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table "
    "ul".split()
)
# What an opening tag ends, and the elements at which the search for it stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"tr", "td", "th", "tbody"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
_HOLDS_P = frozenset("table td th caption button object article section main aside".split())

_SKIPPED_TAGS = frozenset(
    "head nav footer aside form button select datalist dialog menu svg math canvas audio video object "
    "map".split()
)
_SKIPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
    "toolbar".split()
)
_SKIPPED_WORDS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars widget widgets ad ads "
    "adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors "
    "promo promos promotion banner banners cookie cookies consent gdpr notice notices popup popups "
    "modal overlay newsletter subscribe subscription signup share sharing social related recommended "
    "recommendations comment comments commentlist disqus replies respond footer masthead pagination "
    "pager toolbar skip login alert alerts disclaimer".split()
)
# Parts of names written in one word, such as "topnav" or "cookiebar".
_SKIPPED_PARTS = re.compile(
    r"sidebar|navbar|advert|newsletter|breadcrumb|cookie|comments|footer|sponsor|popup|masthead"
    r"|nav$|^nav|^ad(?:box|slot|unit|banner)|^comment(?!ar)"
)
_HEADER_WORDS = frozenset(["header", "topbar", "head"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    names: str = ""
    role: str = ""
    children: list[int] = field(default_factory=list)
    # Texts and children in page order: a text, or the number of a child.
    content: list[str | int] = field(default_factory=list)


def parse(page: str) -> list[Node]:
    """The elements of a page in page order; number 0 is the page itself.

    Missing end tags are supplied as browsers do for paragraphs, list items and
    table parts; an end tag without a start is left out.
    """
    nodes = [Node("", -1, 0)]
    open_, at = _Open(nodes), 0
    while True:
        found = _TOKEN.search(page, at)
        text = page[at:found.start() if found else len(page)]
        if text:
            nodes[open_.stack[-1]].content.append(text)
        if not found:
            return nodes
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            open_.close(tag)
            continue
        open_.supply_ends(tag)
        attributes = found[3] or found[6] or ""
        number = len(nodes)
        node = Node(tag, open_.stack[-1], nodes[open_.stack[-1]].depth + 1)
        if "=" in attributes:
            values = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _NAMES.finditer(attributes)}
            node.names = f"{values.get('class', '')} {values.get('id', '')}".strip()
            node.role = values.get("role", "")
        nodes.append(node)
        nodes[open_.stack[-1]].children.append(number)
        nodes[open_.stack[-1]].content.append(number)
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in _VOID:
            open_.push(number)


class _Open:
    """The elements that are open, and how many of each name."""

    def __init__(self, nodes: list[Node]):
        self.nodes, self.stack, self.counts = nodes, [0], Counter()

    def push(self, number: int) -> None:
        self.stack.append(number)
        self.counts[self.nodes[number].tag] += 1

    def _cut(self, depth: int) -> None:
        self.counts.subtract(self.nodes[number].tag for number in self.stack[depth:])
        del self.stack[depth:]

    def close(self, tag: str) -> None:
        """End the innermost element of this name; an inline one only within its block."""
        if not self.counts[tag]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            held = self.nodes[self.stack[depth]].tag
            if held == tag:
                self._cut(depth)
                return
            if tag in _INLINE and held not in _INLINE:
                return

    def supply_ends(self, tag: str) -> None:
        """End what the opening of an element ends."""
        if tag in _ENDS_P:
            self._end({"p"}, _HOLDS_P)
        if tag in _ENDS:
            self._end(*_ENDS[tag])

    def _end(self, ended, stops) -> None:
        waiting, cut = sum(self.counts[tag] for tag in ended), None
        for depth in range(len(self.stack) - 1, 0, -1):
            held = self.nodes[self.stack[depth]].tag
            if not waiting or held in stops:
                break
            if held in ended:
                waiting, cut = waiting - 1, depth
        if cut is not None:
            self._cut(cut)


def plain(text: str) -> str:
    """Character references decoded, white space turned into single spaces."""
    return " ".join(html.unescape(text).split())


def own_text(node: Node) -> str:
    return plain(" ".join(part for part in node.content if isinstance(part, str)))


def is_skipped(nodes: list[Node], number: int, in_article: bool) -> bool:
    """Whether an element is no part of an article by its tag, role or name."""
    node = nodes[number]
    if node.tag in _SKIPPED_TAGS or node.tag in _RAW or node.role in _SKIPPED_ROLES:
        return True
    if node.tag in ("html", "body", "main", "article"):
        words = set(_WORD.findall(node.names))
        return node.tag == "article" and bool(words & {"comment", "comments", "related", "ad", "promo"})
    words = set(_WORD.findall(node.names)) if node.names else ()
    if words and (words & _SKIPPED_WORDS or any(map(_SKIPPED_PARTS.search, words))):
        return True
    if node.tag == "header" or (words and words & _HEADER_WORDS and node.tag not in _HEADINGS):
        return not (in_article and _has_heading(nodes, number))
    return False


def _has_heading(nodes: list[Node], number: int) -> bool:
    waiting = [number]
    while waiting:
        node = nodes[waiting.pop()]
        if node.tag in _HEADINGS:
            return True
        waiting += node.children
    return False


def blocks(nodes: list[Node], root: int, dropped: set[int]) -> list[str]:
    """The text blocks below ``root`` in page order.

    ``dropped`` are elements whose own text is left out.
    """
    out, now = [], []

    def flush():
        text = plain("".join(now))
        if text:
            out.append(text)
        now.clear()

    in_article = root != 0
    # Walks (element, place in its content) without recursion; pages nest deeply.
    walk = [(root, 0)]
    while walk:
        number, place = walk.pop()
        node = nodes[number]
        if place == len(node.content):
            if node.tag not in _INLINE:
                flush()
            continue
        walk.append((number, place + 1))
        part = node.content[place]
        if isinstance(part, str):
            if number not in dropped:
                now.append(part)
        elif is_skipped(nodes, part, in_article):
            if nodes[part].tag not in _INLINE:
                flush()
        else:
            if nodes[part].tag not in _INLINE:
                flush()
            walk.append((part, 0))
    flush()
    return out


def parts(nodes: list[Node]) -> list[int]:
    """Where text of the article stands, in page order: each outermost ``main`` or
    ``article`` and the headings beside them; the page where there is neither."""
    found, headings, waiting = [], [], [(0, False)]
    while waiting:
        number, in_header = waiting.pop()
        node = nodes[number]
        if number and is_skipped(nodes, number, False):
            if node.tag != "header":
                continue
            in_header = True
        if {node.tag, node.role} & {"main", "article"}:
            found.append(number)
        elif node.tag in _HEADINGS and not in_header:
            headings.append(number)
        else:
            waiting += [(child, in_header) for child in node.children]
    return sorted(found + headings) if found else [0]


def article_text(nodes: list[Node], dropped: set[int]) -> str:
    """The blocks of all parts of the article, joined by spaces."""
    return " ".join(block for root in parts(nodes) for block in blocks(nodes, root, dropped))


def article_elements(nodes: list[Node]) -> set[int]:
    """The elements whose own text is part of the article."""
    found: set[int] = set()
    for root in parts(nodes):
        waiting = [root]
        while waiting:
            number = waiting.pop()
            found.add(number)
            waiting += [c for c in nodes[number].children if not is_skipped(nodes, c, root != 0)]
    return found
