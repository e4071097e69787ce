"""Labelled pages to train on: made from pieces of known kind, a bounded number.

A page is a list of (html, is main text) blocks inside wrappers. Wrappers and
names vary as they do between sites; the words are drawn at random.
"""

from __future__ import annotations

import random

SYLLABLES = "an be ca der el fi go hu in jo ka lu mer no os pra que ri sta tu un ver wa zen".split()

# What pages wrap each kind of text in.
MAIN = ["article", "main", 'div class="content"', 'div class="post"', 'div class="article body"', 'div id="main"',
        'section class="entry content"', 'div itemprop="articleBody"', 'div class="story text"', 'div role="main"']
MENU = ["nav", 'div class="menu"', 'ul class="navigation"', 'div class="breadcrumb"', 'div class="navbar"', 'div id="nav"',
        'div class="toc"', 'div class="pagination"']
HEAD = ["header", 'div class="header"', 'div id="masthead"', 'div class="top banner"', 'div id="site header"']
FOOT = ["footer", 'div class="footer"', 'div id="footer"', 'div class="bottom copyright"', 'div class="site footer"']
SIDE = ["aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div class="related"', 'div class="recommended"',
        'div class="share social"', 'section class="popular"', 'div class="tags"']
AD = ['div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="advertisement"', 'div class="sponsored"', 'div class="promo"',
      'div class="banner ad"', 'div id="ad"', 'section class="sponsor"', 'div class="newsletter subscribe"']
NOTICE = ['div class="cookie notice"', 'div id="cookie"', 'div class="consent"', 'div class="notice"', 'div class="alert"',
          'div class="popup modal"', 'div class="gdpr banner"', 'div class="disclaimer"', 'div class="paywall"', 'div role="alert"']
FORM = ["form", 'form class="search"', 'form class="login"', 'form id="signup"', 'form class="comment form"']
TALK = ['div class="comments"', 'section class="comments"', 'div id="comments"', 'section id="discussion"', 'div class="comment list"',
        'ol class="commentlist"', 'div class="replies"', 'div class="responses"', 'section class="reviews"']


def _words(rng: random.Random, n: int) -> str:
    out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    for i in range(8, n, rng.randint(7, 13)):
        out[i] += rng.choice([",", "."])
    return " ".join(out).capitalize() + rng.choice([".", ".", "", "?"])


def _wrap(tag: str, inner: list[tuple[str, int]]) -> list[tuple[str, int]]:
    return [(f"<{tag}>", -1), *inner, (f"</{tag.split()[0]}>", -1)]


def _texts(rng: random.Random, label: int, least: int, most: int, count: int, tags: list[str]) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = []
    for _ in range(count):
        out += _wrap(rng.choice(tags), [(_words(rng, rng.randint(least, most)), label)])
    return out


def _links(rng: random.Random) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = []
    tag = rng.choice(["li", "li", "div", "p"])
    for _ in range(rng.randint(2, 8)):
        out += _wrap(tag, [(f'<a href="/x">{_words(rng, rng.randint(1, 5))}</a>', 0)])
    return _wrap("ul", out) if tag == "li" else out


def _main(rng: random.Random) -> list[tuple[str, int]]:
    inner = _texts(rng, 1, 3, 12, 1, ["h1"]) if rng.random() < 0.85 else []
    for _ in range(rng.randint(1, 9)):
        kind = rng.random()
        if kind < 0.7:
            inner += _texts(rng, 1, 1, 120, 1, ["p"])
        elif kind < 0.78:
            inner += _texts(rng, 1, 2, 8, 1, ["h2", "h3"])
        elif kind < 0.86:
            inner += _wrap(rng.choice(["ul", "ol"]), _texts(rng, 1, 2, 25, rng.randint(2, 5), ["li"]))
        elif kind < 0.92:
            inner += _wrap("blockquote", _texts(rng, 1, 5, 40, 1, ["p"]))
        elif kind < 0.96:
            inner += _wrap("table", _wrap("tr", _texts(rng, 1, 1, 6, 3, ["td"])))
        else:
            inner += _wrap(rng.choice(["figure", "pre", "div"]), _texts(rng, 1, 3, 15, 1, ["figcaption", "p", "div"]))
        if rng.random() < 0.1:  # something else in the middle of the article
            inner += _other(rng, rng.choice([AD, AD, SIDE, NOTICE, FORM]))
    if rng.random() < 0.15:
        inner += _other(rng, TALK)
    return _wrap(rng.choice(MAIN), inner)


def _other(rng: random.Random, kind: list[str]) -> list[tuple[str, int]]:
    if kind is MENU:
        inner = _links(rng)
    elif kind is TALK:
        inner = _texts(rng, 0, 1, 4, 1, ["h2", "h3"]) if rng.random() < 0.5 else []
        for _ in range(rng.randint(1, 6)):
            inner += _wrap(rng.choice(["div", "article", "li", 'div class="comment"']), _texts(rng, 0, 1, 4, 1, ["div", "h4", "p"]) + _texts(rng, 0, 3, 60, 1, ["p"]))
    elif kind is FORM:
        inner = _texts(rng, 0, 1, 12, rng.randint(1, 3), ["p", "div", "legend", "h3"])
    elif kind is SIDE and rng.random() < 0.6:
        inner = _texts(rng, 0, 1, 5, 1, ["h2", "h3"]) + _links(rng)
    elif kind is FOOT and rng.random() < 0.6:
        inner = [("&copy; " + _words(rng, rng.randint(3, 20)), 0)]
    else:
        inner = _texts(rng, 0, 2, 40, rng.randint(1, 3), ["p", "div", "h3"])
        if rng.random() < 0.5:
            inner = [(_words(rng, rng.randint(2, 40)), 0)]
    return _wrap(rng.choice(kind), inner)


def labelled_pages(count: int, seed: int = 3) -> list[tuple[str, list[int]]]:
    """(html, label of each non-empty leaf block)."""
    rng, out = random.Random(seed), []
    for _ in range(count):
        parts: list[tuple[str, int]] = []
        for kind, chance in ((NOTICE, 0.3), (HEAD, 0.4), (MENU, 0.8), (AD, 0.6), (FORM, 0.2), (SIDE, 0.3)):
            if rng.random() < chance:
                parts += _other(rng, kind)
        parts += _main(rng)
        for kind, chance in ((AD, 0.2), (TALK, 0.4), (SIDE, 0.4), (FORM, 0.15), (NOTICE, 0.1), (FOOT, 0.8)):
            if rng.random() < chance:
                parts += _other(rng, kind)
        if rng.random() < 0.3:
            parts = _wrap(rng.choice(["div", 'div id="page"', 'div class="container"', "section"]), parts)
        page = "<html><head><title>x</title></head><body>" + "".join(p for p, _ in parts) + "</body></html>"
        out.append((page, [label for _, label in parts if label >= 0]))
    return out
