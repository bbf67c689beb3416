"""A page's text blocks with the elements they lie in.

Made for this use alone: tags, implied ends, comments and raw-text elements are read;
nothing is rendered. An element's *style* is its tag with class, id and role, digits as
``0``; its key is a hash of its parent's key and its style, so a deep page costs no more
than a flat one. Inline tags neither break a block nor count, but text in those that are
called adverts, share links and the like is left out. Everything takes time in proportion
to the page, well-formed or not: no tag is looked at twice.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from html import unescape

from xxhash import xxh64_intdigest

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")
#: Names and roles of an element are read from so many characters of its tag at most.
TAG_CHARS = 4_096
#: Elements that lie deeper are read as ended at once: their text belongs to the one above.
MAX_DEPTH = 128

# HTML's own element lists.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
#: A start tag of the first kind ends an open element of the second.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                   "hgroup hr main menu nav ol p pre section table ul".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "tbody": ("td", "th", "tr", "thead", "tbody"), "tfoot": ("td", "th", "tr", "tbody")}
STOPS = frozenset("table ul ol dl select div section article main body html td th".split())

#: Elements that are no part of an article, by tag, role, and class or id.
FURNITURE = frozenset("head nav footer aside form script style noscript template iframe object embed applet svg canvas button select "
                      "textarea dialog menu title audio video map datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_NAMES = re.compile(
    r"""^(?:(?:site|page|main|top|bottom|left|right|global|primary|secondary|post|entry|article|user|reader|the|sticky|js|wp)[-_]*)*
        (?:ads?|adverts?|advertisements?|advertising|adsense|banners?|sponsor(?:ed|s)?|promos?|promotions?|nav|navbar|navigation|menus?|
           breadcrumbs?|sidebars?|header|masthead|footer|foot|cookies?|consent|gdpr|notices?|popups?|modals?|overlay|newsletter|
           subscribe|subscription|signup|login|search|share|sharing|social|related|recommended|comments?|respond|replies|disqus|
           discussion|widgets?|pagination|pager|toolbar|tagcloud|copyright)
        (?:[-_]*(?:bar|box|wrap|wrapper|container|list|area|section|block|inner|content|panel|links?|widget|items?|form|top|bottom|left|
           right|unit|slot|banner|notice|consent|thread|menu|nav|text|message|body|0)s?)*$""", re.X | re.I)
#: Longer names are none of these.
_LONGEST_NAME = 60


@dataclass
class Node:
    """``key`` is that of the style path, ``main`` the article or main element it lies in (a
    node, 0 for none) and ``shape`` a running hash of its children's styles."""
    key: int
    parent: int
    tag: str
    furniture: bool   # it or one above it
    main: int
    shape: int = 0


def hash64(text: str, seed: int = 0) -> int:
    return xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


def _is_name(names: str) -> bool:
    return any(len(n) <= _LONGEST_NAME and _NAMES.match(n) for n in names.split())


def is_furniture(tag: str, names: str, role: str, in_article: bool) -> bool:
    if tag in FURNITURE or role in ROLES or tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "main", "article") and "comment" not in names.lower():
        return False
    return _is_name(names)


def _named(rest: str) -> tuple[str, str]:
    """Class and id, digits as 0, and role of a tag's attributes."""
    if not rest:
        return "", ""
    found: dict[str, str] = {}
    for a, b, c, d in _ATTRIBUTE.findall(rest[:TAG_CHARS]):
        found.setdefault(a.lower(), b or c or d)   # the first counts
    return _DIGITS.sub("0", f"{found.get('class', '')} {found.get('id', '')}").strip(), found.get("role", "").lower()


class _Marks:
    """Where the next of a character is; each is searched once for the whole page."""

    def __init__(self, html: str):
        self.html, self.at = html, {}

    def find(self, mark: str, start: int) -> int:
        """The place of the first ``mark`` from ``start`` on, the page's length if there is none."""
        if mark not in self.at:
            self.at[mark] = [m.start() for m in re.finditer(mark, self.html)]
        known = self.at[mark]
        k = bisect_left(known, start)
        return known[k] if k < len(known) else len(self.html)


def tags(html: str):
    """``(start, end, closing, name, attributes)`` of tags, comments and declarations (these
    without a name), in order; ``send`` goes on from another place. A tag ends at the first
    ``>`` outside quotation marks or, if these don't pair up, at the first ``>`` of all;
    without one there is no tag. Opening marks from which nothing pairs up are remembered."""
    at, marks, size = 0, _Marks(html), len(html)
    doomed: set[int] = set()
    while True:
        at = html.find("<", at)
        if at < 0 or at + 1 >= size:
            return
        c = html[at + 1]
        if html.startswith("<!--", at):
            stop = html.find("-->", at + 2)   # "<!-->" is a whole comment
            item = at, size if stop < 0 else max(stop + 3, at + 5), False, "", ""
        elif c in "!?":
            stop = marks.find(">", at)
            if stop >= size:
                return
            item = at, stop + 1, False, "", ""
        else:
            closing = c == "/"
            name = _NAME.match(html, at + 1 + closing, at + 1 + closing + TAG_CHARS)
            if name is None:
                at += 1
                continue
            here, opened = name.end(), []
            plain = marks.find(">", here)
            if plain >= size:
                return   # no tag ends any more
            while True:
                stop = marks.find(">", here)
                first = min(marks.find('"', here), marks.find("'", here))
                if first > stop:
                    break
                opened.append(first)
                other = marks.find(html[first], first + 1) if first < size and first not in doomed else size
                if stop >= size or other >= size:
                    doomed.update(opened)
                    stop = plain
                    break
                here = other + 1
            item = at, stop + 1, closing, name[0].lower(), html[name.end() : stop]
        sent = yield item
        at = item[1]
        if sent is not None:
            at = sent
            yield None   # the answer to send()


def parse(html: str, host: str = "") -> tuple[list[Node], list[tuple[int, str]]]:
    """``(nodes, blocks)``: block elements in page order, and ``(node, text)`` of text blocks
    with references decoded and white space as single spaces; empty ones are left out."""
    nodes = [Node(hash64(host), -1, "", False, 0)]
    stack: list[int] = [0]
    open_ = {"": 1}                   # open elements by tag
    hidden: list[str] = []            # open inline elements from the first that is left out
    blocks: list[tuple[int, str]] = []
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                blocks.append((stack[-1], text))
            pieces.clear()

    def cut(k: int) -> None:
        for i in stack[k:]:
            open_[nodes[i].tag] -= 1
        del stack[k:]

    def close(names: tuple[str, ...], stops: frozenset[str]) -> None:
        if not any(open_.get(n) for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[k]].tag
            if tag in names:
                cut(k)
                return
            if tag in stops:
                return

    read, last = tags(html), 0
    raw_ends: dict[str, tuple[re.Pattern, list[bool]]] = {}
    for start, end, closing, tag, rest in read:
        skip = None
        if start > last and not hidden:
            pieces.append(html[last:start])
        last = end
        if not tag:
            pass   # a comment or declaration is no white space
        elif tag in INLINE and not (hidden and not closing):
            if closing:
                if tag in hidden:
                    del hidden[len(hidden) - 1 - hidden[::-1].index(tag):]
            elif rest:
                names, role = _named(rest)
                if (names and _is_name(names)) or role in ROLES:
                    hidden.append(tag)
        elif tag in INLINE:
            if tag != "wbr" and len(hidden) < 64:
                hidden.append(tag)
        elif closing:
            hidden.clear()
            flush()
            close((tag,), frozenset())
        elif tag in RAW:
            flush()
            if tag not in raw_ends:
                raw_ends[tag] = re.compile(rf"</{tag}\b[^<>]*>", re.I), [True]
            pattern, more = raw_ends[tag]
            stop = pattern.search(html, end) if more[0] else None
            more[0] = stop is not None
            last = skip = stop.end() if stop else len(html)
        else:
            hidden.clear()   # a block ends what an author left open
            flush()
            if tag not in VOID:
                if tag in ENDS_P:
                    close(("p",), STOPS)
                if tag in ENDS:
                    close(ENDS[tag], STOPS - set(ENDS[tag]))
                names, role = _named(rest)
                up = nodes[stack[-1]]
                style = f"{tag}.{names}.{role}" if names or role else tag
                up.shape = hash64(style, up.shape)
                key = hash64(style, up.key)
                is_main = tag in ("article", "main") or role == "main"
                nodes.append(Node(key, stack[-1], tag, up.furniture or is_furniture(tag, names, role, up.main > 0 and nodes[up.main].tag == "article"),
                                  len(nodes) if is_main else up.main))
                if len(stack) < MAX_DEPTH and (not rest.endswith("/") or tag in ("p", "div", "article", "section")):
                    stack.append(len(nodes) - 1)
                    open_[tag] = open_.get(tag, 0) + 1
        if skip is not None:
            read.send(skip)
    if last < len(html) and not hidden:
        pieces.append(html[last:])
    flush()
    return nodes, blocks
