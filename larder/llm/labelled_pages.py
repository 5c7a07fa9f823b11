"""Labelled training pages: markup of many layouts in which each block's label is known.

The texts are random words; a model can learn from them where the main text
stands and what it looks like, not what it is about.
"""

from __future__ import annotations

import random
from html import escape

MAIN, OTHER = 1, 0

_LETTERS = "etaoinshrdlucmfgypwbvkéüñàö"
_ENDS = ("", "", "s", ".", ".", ",", "!")
_SYMBOLS = ("***", "$$$", "%%%", "&&&", "|", "#", "<", ">")

_WRAPS = (
    ('<article>', '</article>'), ('<article class="post">', '</article>'), ('<main><article>', '</article></main>'),
    ('<main>', '</main>'), ('<div id="content"><article>', '</article></div>'), ('<main><section>', '</section></main>'),
    ('<div class="article-body">', '</div>'), ('<div id="main" class="content">', '</div>'),
)


def _words(rng: random.Random, least: int, most: int, noise: float = 0.0) -> str:
    def word() -> str:
        if rng.random() < noise:
            return rng.choice(_SYMBOLS)
        return "".join(rng.choice(_LETTERS) for _ in range(rng.randint(1, 9))) + rng.choice(_ENDS)

    text = " ".join(word() for _ in range(rng.randint(least, most)))
    return text[:1].upper() + text[1:] + rng.choice((".", ".", ""))


class _Page:
    def __init__(self, rng: random.Random):
        self.rng, self.html, self.labels = rng, [], []

    def raw(self, markup: str) -> None:
        self.html.append(markup)

    def block(self, start: str, text: str, end: str, label: int) -> None:
        self.html.append(f"{start}{escape(text)}{end}")
        self.labels.append(label)

    def links(self, start: str, end: str, most: int = 8) -> None:
        self.raw(start + "<ul>")
        for _ in range(self.rng.randint(2, most)):
            self.block('<li><a href="/x">', _words(self.rng, 1, 3), "</a></li>", OTHER)
        self.raw("</ul>" + end)

    def boxes(self, least: int, most: int) -> None:
        """Adverts, notices, forms and asides."""
        kinds = (
            ('<div class="ad">', "</div>"), ('<div class="banner advert"><p>', "</p></div>"), ('<aside><p>', "</p></aside>"),
            ('<div class="cookie-notice"><p>', "</p></div>"), ('<div class="sidebar"><p>', "</p></div>"),
            ('<form action="/s"><label>', "</label></form>"), ('<div class="notice">', "</div>"), ('<div class="promo">', "</div>"),
            ('<form><p>', "</p></form>"), ('<aside class="related"><h3>', "</h3></aside>"), ('<div id="newsletter"><p>', "</p></div>"),
        )
        for _ in range(self.rng.randint(least, most)):
            start, end = self.rng.choice(kinds)
            self.block(start, _words(self.rng, 2, 40), end, OTHER)

    def article(self) -> None:
        rng = self.rng
        start, end = rng.choice(_WRAPS)
        noise = 0.4 if rng.random() < 0.15 else 0.0
        self.raw(start)
        if rng.random() < 0.9:
            before, after = ("<header>", "</header>") if rng.random() < 0.1 else ("", "")
            self.block(before + "<h1>", _words(rng, 1, 14), "</h1>" + after, MAIN)
        for _ in range(rng.randint(1, 14)):
            kind = rng.random()
            text = _words(rng, 1, 6, noise) if rng.random() < 0.3 else _words(rng, 5, 90, noise)
            if kind < 0.75:
                self.block(rng.choice(("<p>", "<p><b>", '<p class="text">')), text, rng.choice(("</p>", "<br>", "</p>")), MAIN)
            elif kind < 0.83:
                self.block("<h2>", _words(rng, 1, 8), "</h2>", MAIN)
            elif kind < 0.9:
                self.block("<blockquote>", text, "</blockquote>", MAIN)
            elif kind < 0.96:
                self.block("<ul><li>", text, "</li></ul>", MAIN)
            else:
                self.boxes(1, 1)
        self.raw(end)

    def comments(self) -> None:
        start = self.rng.choice(('<section class="comments">', '<div id="comments">', '<div class="comment-list">'))
        self.raw(start)
        for _ in range(self.rng.randint(1, 6)):
            self.block('<div class="comment"><p>', _words(self.rng, 2, 60), "</p></div>", OTHER)
        self.raw("</section>" if start.startswith("<section") else "</div>")


def labelled_page(rng: random.Random) -> tuple[str, list[int]]:
    """Markup of one page and the labels of its blocks in page order."""
    page = _Page(rng)
    page.raw("<!DOCTYPE html><html><head><title>" + escape(_words(rng, 2, 8)) + "</title><style>p{margin:0}</style></head><body>")
    if rng.random() < 0.5:
        page.raw("<header>")
        page.block("<div>", _words(rng, 1, 6), "</div>", OTHER)
        page.raw("</header>")
    if rng.random() < 0.85:
        page.links("<nav>", "</nav>")
    elif rng.random() < 0.5:
        page.links('<div class="menu">', "</div>")
    page.boxes(0, 2)
    page.article()
    page.boxes(0, 2)
    if rng.random() < 0.3:
        page.comments()
    if rng.random() < 0.9:
        page.raw("<footer>")
        page.block("", "© " + _words(rng, 2, 14), "", OTHER)
        page.raw("</footer>")
    page.raw("</body></html>" if rng.random() < 0.9 else "")
    return "".join(page.html), page.labels


def labelled_pages(count: int, seed: int) -> list[tuple[str, list[int]]]:
    rng = random.Random(seed)
    return [labelled_page(rng) for _ in range(count)]
