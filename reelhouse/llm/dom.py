"""Leaf blocks of a page: runs of text between block-level tags, with what is known about them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

#: Fixed values of HTML: elements by how they are read.
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rp "
    "rt s samp small span strike strong sub sup svg time tt u var wbr img input br button select".split()
)
#: An opening tag of the key closes an open element of the value inside the same parent.
CLOSES = {
    "p": {"p"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
CLOSES |= {
    t: {"p"}
    for t in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol pre section table ul figure".split()
}
_STOPS = frozenset("ul ol table dl div article section body td select object template".split())
#: Opening tags that end an open drawing (svg), and elements of a drawing that are not drawn.
_LEAVES = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var "
    "article aside footer form header main nav section".split()
)
_UNDRAWN = frozenset("title desc metadata style script".split())
#: Elements whose presence among the ancestors is a feature.
MARKED = frozenset(
    "nav header footer aside form article main section table ul ol li td th dl figure figcaption "
    "blockquote pre button label select option fieldset address details dialog menu body "
    "svg canvas object template".split()
)
#: Word parts of class, id and role values, and the group that each stands for.
NAMES = {
    "ad": "advert ads ad adv advertisement advertising banner promo sponsor sponsored promoted",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar tabs pagination pager",
    "head": "header masthead top branding logo",
    "foot": "footer bottom copyright colophon legal imprint",
    "side": "sidebar side aside rail widget widgets",
    "comment": "comment comments reply replies respond discussion disqus thread reader readers",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay banner2 message dialog "
    "newsletter subscribe subscription signup paywall",
    "share": "share sharing social follow",
    "related": "related recommended more popular trending teaser teasers latest also",
    "form": "form search login register contact signin",
    "meta": "meta byline author date tags tag category categories",
    "main": "article content post entry story body text main maincontent news blog prose page",
}
_GROUP = {word: group for group, words in NAMES.items() for word in words.split()}
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)",
    re.S,
)
#: As in `_TAG`, with groups that are never set.
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|(?!)(.)(.)", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=>]|$)|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.I)
_PARTS = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Block:
    text: str
    linked: int  # characters inside links
    tag: str  # innermost block-level element
    marks: frozenset[str]  # features of the ancestors
    parent: int  # number of the element that holds the block's element


def _marks(tag: str, attributes: str) -> frozenset[str]:
    found = {f"in:{tag}"} if tag in MARKED else set()
    if len(attributes) > 1:
        for m in _NAMED.finditer(attributes[:-1]):
            value = (m[2] or m[3] or m[4] or "").lower()
            found.update(f"name:{_GROUP[p]}" for p in _PARTS.findall(value) if p in _GROUP)
        if _HIDDEN.search(attributes):
            found.add("hidden")
    return frozenset(found)


class _Open:
    """The open elements, innermost last, and where the kinds that are asked for stand.

    Every question is answered without a walk over the elements, so a page of a million open or
    unmatched tags takes time in proportion to its length.
    """

    def __init__(self):
        # (tag, marks of it and its ancestors, number, number of the parent)
        self.elements: list[tuple[str, frozenset[str], int, int]] = [("", frozenset(), 0, 0)]
        self.places: dict[str, list[int]] = {}
        self.blocks, self.stops = [0], [0]

    def push(self, element: tuple[str, frozenset[str], int, int]) -> None:
        tag, place = element[0], len(self.elements)
        self.elements.append(element)
        self.places.setdefault(tag, []).append(place)
        if tag not in INLINE:
            self.blocks.append(place)
        if tag in _STOPS:
            self.stops.append(place)

    def cut(self, place: int) -> None:
        """Close the element at a place and all inside it."""
        while len(self.elements) > place:
            tag = self.elements.pop()[0]
            self.places[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
            if tag in _STOPS:
                self.stops.pop()

    def last(self, tag: str) -> int:
        """Where the innermost element of a tag is, 0 if there is none."""
        return (self.places.get(tag) or (0,))[-1]

    def close(self, tag: str) -> None:
        """What a closing tag does; one of an inline element reaches no further than its block."""
        place = self.last(tag)
        if place and (tag not in INLINE or place > self.blocks[-1]):
            self.cut(place)

    def make_room(self, tags: set[str]) -> None:
        """What an opening tag does that closes others, inside the nearest element that stops it."""
        place = max(map(self.last, tags))
        if place and place >= self.stops[-1]:
            self.cut(place)

    def top(self) -> tuple[str, frozenset[str], int, int]:
        return self.elements[-1]

    def holder(self) -> tuple[str, frozenset[str], int, int]:
        """The innermost element that is no inline one."""
        return self.elements[self.blocks[-1]]


def _past(page: str, tag: str, at: int) -> int:
    """Behind the next closing tag; the end of the page if there is none."""
    begun = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
    ended = page.find(">", begun.end()) if begun else -1
    return ended + 1 if ended >= 0 else len(page)


def _next_tag(page: str, at: int, last: int) -> re.Match | None:
    """The next tag or comment; behind the last ">" there are unclosed comments only."""
    return _TAG.search(page, at) if at <= last else _COMMENT.search(page, at)


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of a page in page order; white space inside a block is one space."""
    blocks: list[Block] = []
    stack = _Open()
    parts: list[str] = []
    linked, links, number, at, size, last = 0, 0, 0, 0, len(page), page.rfind(">")
    unclosed: set[str] = set()  # undrawn elements that no later tag closes

    def finish() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                holder = stack.holder()
                blocks.append(Block(text, min(linked, len(text)), holder[0], stack.top()[1], holder[3]))
        linked = 0

    while at < size:
        m = _next_tag(page, at, last)
        piece = page[at : m.start() if m else size]
        if piece:
            if "&" in piece:
                piece = unescape(piece)
            parts.append(piece)
            if links:
                linked += len(piece)
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if stack.top()[0] == "svg":
            # shapes and their text are part of the block around the drawing
            if tag == "text":
                parts.append(" ")
            if m[1]:
                if not stack.last(tag):
                    if tag == "a":
                        links = 0
                    continue
            elif tag in _LEAVES:
                while stack.top()[0] == "svg":
                    stack.cut(len(stack.elements) - 1)
            elif m[3].endswith("/>"):
                continue
            elif tag in _UNDRAWN:
                if tag not in unclosed:
                    end = re.compile(f"</{tag}[^>]*>|(?=</svg)", re.I).search(page, at)
                    if end:
                        at = end.end()
                    else:
                        unclosed.add(tag)
                continue
            elif tag not in ("svg", "foreignobject"):
                if tag == "a":
                    links = 1
                continue
        elif tag == "svg" and not m[1] and m[3].endswith("/>"):
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            finish()
        if m[1]:
            if tag == "a":
                links = 0
            stack.close(tag)
            continue
        if tag in RAW:
            at = _past(page, tag, at)
            continue
        if tag in VOID:
            continue
        closes = CLOSES.get(tag)
        if closes:
            stack.make_room(closes)
        if tag == "a":
            links = 1
        number += 1
        above = stack.top()
        own = _marks(tag, m[3])
        stack.push((tag, above[1] | own if own else above[1], number, above[2]))
    finish()
    return blocks
