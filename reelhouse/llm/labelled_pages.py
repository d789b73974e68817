"""Labelled pages to train the extractor on: each block of a page is main text or not.

Pages are put together at random, from a fixed seed, out of the parts that web pages have. A part
is written as HTML with its blocks marked, so the labels come with the page. Words are made up,
so that the field learns structure and shape and not a language.
"""

from __future__ import annotations

import random

MAIN, OTHER = 1, 0
_SYLLABLES = "ba co de fi go hu la me ni or pa que ri so tu un ver wel xi yo zen thr st é ö".split()
#: What articles speak of as well.
_MENTIONED = ("cookies", "subscribe", "newsletter", "advertisement", "sponsored", "comments", "reply")
#: How many pages are made to train on.
PAGES = 500


class _Writer:
    """HTML with the labels of its blocks, in order."""

    def __init__(self, rnd: random.Random):
        self.rnd, self.html, self.labels = rnd, [], []

    def word(self) -> str:
        return "".join(self.rnd.choices(_SYLLABLES, k=self.rnd.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rnd.randint(low, high)))

    def sentence(self, low=3, high=18) -> str:
        text = self.words(low, high).capitalize()
        if self.rnd.random() < 0.4:
            text = text.replace(" ", ", ", 1)
        return text + self.rnd.choices(".!?", (10, 1, 1))[0]

    def prose(self, most: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.rnd.randint(1, most)))

    def raw(self, html: str) -> None:
        self.html.append(html)

    def block(self, tag: str, text: str, label: int, attributes: str = "") -> None:
        end = "" if tag in ("p", "li") and self.rnd.random() < 0.15 else f"</{tag}>"
        self.html.append(f"<{tag}{attributes}>{text}{end}")
        self.labels.append(label)

    def named(self, *names: str) -> str:
        """A class or id, or none at all."""
        if self.rnd.random() < 0.25:
            return ""
        return f' {self.rnd.choice(("class", "id"))}="{self.rnd.choice(names)}"'


def _links(w: _Writer, low: int, high: int) -> None:
    listed = w.rnd.random() < 0.7
    if listed:
        w.raw("<ul>")
    for _ in range(w.rnd.randint(low, high)):
        link = f'<a href="/{w.word()}">{w.words(1, 3)}</a>'
        w.block("li" if listed else "div", link, OTHER)
    if listed:
        w.raw("</ul>")


def _menu(w: _Writer) -> None:
    tag = w.rnd.choice(("nav", "nav", "div", "header"))
    name = w.named("menu", "navbar", "top-nav", "breadcrumb") if tag != "div" else ' class="nav-menu"'
    w.raw(f"<{tag}{name}>")
    _links(w, 2, 8)
    w.raw(f"</{tag}>")


def _header(w: _Writer) -> None:
    tag = w.rnd.choice(("header", "header", "div"))
    w.raw(f"<{tag}{w.named('header', 'masthead', 'site-header') or (' id=header' if tag == 'div' else '')}>")
    w.block(w.rnd.choice(("h1", "div", "p", "h2")), w.words(1, 4), OTHER)
    if w.rnd.random() < 0.5:
        w.block("p", w.sentence(2, 8), OTHER)
    w.raw(f"</{tag}>")


def _advert(w: _Writer) -> None:
    tag = w.rnd.choice(("div", "aside", "section"))
    w.raw(f'<{tag} class="{w.rnd.choice(("ad", "ads", "advert", "sponsored", "promo-box", "ad-slot"))}">')
    text = w.rnd.choice((w.sentence(2, 14), w.prose(2), f'<a href="/x">{w.words(2, 8)}</a>'))
    if w.rnd.random() < 0.5:
        w.block("p", text, OTHER)
    else:
        w.raw(text)
        w.labels.append(OTHER)
    w.raw(f"</{tag}>")


def _notice(w: _Writer) -> None:
    name = w.rnd.choice(("cookie-notice", "consent", "notice", "popup", "alert-bar", "newsletter", "gdpr"))
    late = w.rnd.random() < 0.35  # a long one that says what it is at its end
    says = w.rnd.choice(("We use cookies", "Subscribe", "We use cookies, subscribe to our newsletter"))
    bare = late and w.rnd.random() < 0.5
    w.raw("<div>" if bare else f'<div {w.rnd.choice(("class", "id"))}="{name}">')
    if late:
        text = f"{w.prose(7)} {w.prose(9)} {says} {w.sentence()}"
    else:
        text = w.rnd.choice((w.prose(3), f"{says}. {w.sentence()}"))
    w.block("p", text, OTHER)
    if w.rnd.random() < 0.5:
        w.block("div", f"<button>{w.words(1, 2)}</button>", OTHER)
    w.raw("</div>")


def _sidebar(w: _Writer) -> None:
    tag = w.rnd.choice(("aside", "aside", "div"))
    w.raw(f"<{tag}{' class=sidebar' if tag == 'div' else w.named('sidebar', 'widget', 'related', 'side')}>")
    if w.rnd.random() < 0.7:
        w.block(w.rnd.choice(("h2", "h3", "h4")), w.words(1, 4), OTHER)
    if w.rnd.random() < 0.5:
        _links(w, 1, 6)
    else:
        for _ in range(w.rnd.randint(1, 3)):
            w.block("p", w.prose(3), OTHER)
    w.raw(f"</{tag}>")


def _related(w: _Writer) -> None:
    tag = w.rnd.choice(("section", "div", "aside"))
    w.raw(f'<{tag} class="{w.rnd.choice(("related", "more-stories", "recommended", "popular"))}">')
    if w.rnd.random() < 0.8:
        w.block(w.rnd.choice(("h2", "h3")), w.words(1, 4), OTHER)
    _links(w, 1, 5)
    w.raw(f"</{tag}>")


def _share(w: _Writer) -> None:
    w.raw(f'<div class="{w.rnd.choice(("share", "social", "share-buttons"))}">')
    _links(w, 1, 4)
    w.raw("</div>")


def _form(w: _Writer) -> None:
    w.raw(f'<form action="/{w.word()}">')
    for _ in range(w.rnd.randint(1, 3)):
        label = f"<label>{w.words(1, 4)}</label><input name=a>"
        w.block(w.rnd.choice(("p", "div")), label, OTHER)
    if w.rnd.random() < 0.5:
        w.block("p", w.prose(2), OTHER)
    w.block("div", f"<button>{w.words(1, 2)}</button>", OTHER)
    w.raw("</form>")


def _comments(w: _Writer) -> None:
    tag = w.rnd.choice(("section", "div", "div", "ol"))
    w.raw(f'<{tag} {w.rnd.choice(("class", "id"))}="{w.rnd.choice(("comments", "comment-list", "replies", "discussion", "reader-comments"))}">')
    if tag != "ol" and w.rnd.random() < 0.6:
        w.block(w.rnd.choice(("h2", "h3")), w.rnd.choice(("Comments", w.words(1, 3))), OTHER)
    for _ in range(w.rnd.randint(1, 5)):
        item = "li" if tag == "ol" else w.rnd.choice(("div", "article"))
        w.raw(f"<{item}{w.named('comment', 'reply')}>")
        if w.rnd.random() < 0.5:
            w.block("div", w.words(1, 3), OTHER)
        w.block("p", w.prose(4), OTHER)
        w.raw(f"</{item}>")
    w.raw(f"</{tag}>")


def _footer(w: _Writer) -> None:
    tag = w.rnd.choice(("footer", "footer", "footer", "div"))
    w.raw(f"<{tag}{' id=footer' if tag == 'div' else w.named('footer', 'site-footer')}>")
    kind = w.rnd.random()
    if kind < 0.4:
        w.raw(f"&copy; {w.word()}.example.com &middot; {w.prose(2)}")
        w.labels.append(OTHER)
    elif kind < 0.7:
        w.block("p", f"&copy; {w.words(1, 5)}", OTHER)
    else:
        _links(w, 1, 5)
        w.block("p", w.prose(2), OTHER)
    w.raw(f"</{tag}>")


def _article(w: _Writer) -> None:
    tag = w.rnd.choice(("article", "article", "main", "div", "section", "div"))
    names = ("content", "post", "entry-content", "article-body", "story", "main-text")
    name = f' class="{w.rnd.choice(names)}"' if tag in ("div", "section") and w.rnd.random() < 0.8 else ""
    w.raw(f"<{tag}{name}>")
    spoken_of = 0.7 if w.rnd.random() < 0.12 else 0.02
    if w.rnd.random() < 0.8:
        head = w.words(2, 12)
        w.block(w.rnd.choice(("h1", "h1", "h2")), head, MAIN)
    for _ in range(w.rnd.randint(1, 9)):
        kind = w.rnd.random()
        if kind < 0.62:
            text = w.prose(7)
            if w.rnd.random() < spoken_of:
                said = (f"{w.words(1, 4)} {x}" for x in w.rnd.sample(_MENTIONED, w.rnd.randint(1, 3)))
                text = f"{text} {' '.join(said)} {w.sentence()}"
            if w.rnd.random() < 0.25:
                text = text.replace(" ", f' <a href="/{w.word()}">{w.word()}</a> ', 1)
            if w.rnd.random() < 0.2:
                text = "<b>" + text + w.rnd.choice(("</b>", "", "<br>"))
            if w.rnd.random() < 0.15:
                text = text.replace(" ", "<br>", 1)
            w.block("p", text, MAIN)
        elif kind < 0.70:
            w.block("p", w.sentence(1, 5), MAIN)
        elif kind < 0.77:
            w.block(w.rnd.choice(("h2", "h3")), w.words(1, 8), MAIN)
        elif kind < 0.83:
            listed = w.rnd.choice(("ul", "ol"))
            w.raw(f"<{listed}>")
            for _ in range(w.rnd.randint(1, 4)):
                w.block("li", w.rnd.choice((w.sentence(), w.words(1, 6))), MAIN)
            w.raw(f"</{listed}>")
        elif kind < 0.86:
            w.block("blockquote", w.prose(2), MAIN)
        elif kind < 0.88:
            w.block("pre", w.words(3, 12), MAIN)
        elif kind < 0.97:
            w.rnd.choice((_advert, _sidebar, _notice, _related, _share))(w)
        else:
            w.raw("<table><tr>")
            for _ in range(w.rnd.randint(2, 4)):
                w.block("td", w.words(1, 4), MAIN)
            w.raw("</tr></table>")
    if w.rnd.random() < 0.08:
        w.rnd.choice((_form, _comments, _footer))(w)
    w.raw(f"</{tag}>")


def page(rnd: random.Random) -> tuple[str, list[int]]:
    """One page and the label of each of its blocks."""
    w = _Writer(rnd)
    if rnd.random() < 0.06:  # a bare page: one text, with or without a wrapper
        tag = rnd.choice(("article", "article", "main", "body"))
        w.raw(f"<{tag}>")
        for _ in range(rnd.randint(1, 2)):
            w.block("p", w.prose(9), MAIN)
        return "".join(w.html), w.labels
    title = w.words(1, 8)
    w.raw(f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style></head><body>")
    before = [_header, _menu, _advert, _notice, _sidebar, _form]
    after = [_comments, _sidebar, _advert, _form, _notice, _menu, _related, _share]
    wrap = rnd.random() < 0.3
    for part in before:
        if rnd.random() < (0.6 if part is _menu else 0.3):
            part(w)
    if wrap:
        w.raw(f"<div{rnd.choice(('', ' id=wrapper', ' class=container', ' id=page'))}>")
    if rnd.random() < 0.97:
        _article(w)
    for part in rnd.sample(after, len(after)):
        if rnd.random() < (0.4 if part is _comments else 0.2):
            part(w)
    if wrap:
        w.raw("</div>")
    if rnd.random() < 0.8:
        _footer(w)
    w.raw("</body></html>" if rnd.random() < 0.9 else "")
    return "".join(w.html), w.labels


def pages(n: int = PAGES, seed: int = 7) -> list[tuple[str, list[int]]]:
    rnd = random.Random(seed)
    return [page(rnd) for _ in range(n)]
